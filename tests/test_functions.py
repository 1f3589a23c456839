import pytest
from pyspark.sql import functions as F

from muster import functions as fn
from muster.operators.validate import age_segment, segment_message


def each(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in frame.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_clean_trims_the_six_ascii_characters_only(spark):
    cells = [" 255712345678\t", "255712345678\r\n", "\x0b255712345678\x00", None, "a b ", "x\u00a0", "x\u0085"]
    got = each(spark, cells, fn.clean_msisdn)
    assert got == ["255712345678"] * 3 + ["", "a b", "x\u00a0", "x\u0085"]


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        (" 255712345678\t", True),
        ("255712345678\r\n", True),
        ("\x0b255712345678\x00", True),
        ("255712345678\u0085", False),
        ("255712345678\u2028", False),
        ("255712345678\u00a0", False),
        ("25571234567\u0668", False),
        ("+255712345678", False),
        ("2557123456789", False),
        ("25571234567", False),
        ("254712345678", False),
        ("", False),
        (None, False),
    ],
)
def test_valid_msisdn(spark, cell, expected):
    assert each(spark, [cell], lambda c: fn.is_msisdn(fn.clean_msisdn(c))) == [expected]


def test_age_of_35_or_more(spark):
    older = ["35", "35.7", "3.5e1", " 40", "40 ", "+40", "1e1000", "\t36", "36\r", "35.", "\x0b40"]
    younger = ["34.999", ".5", "5.", "", "abc", "0x28", "40d", "40f", "NaN", "Infinity", "1_000", "４０", None, "-40", "4 0"]
    assert each(spark, older, age_segment) == ["o35"] * len(older)
    assert each(spark, younger, age_segment) == ["u35"] * len(younger)
    assert each(spark, ["35", None], lambda c: segment_message(c, "a", "b")) == ["a", "b"]


def test_numeric_strings(spark):
    numeric = ["35", "-1", "+.5", "5.", "1e5", "1E-5", " 1", "1 ", "\n1"]
    other = ["", " ", "+", ".", "e5", "1e", "1 2", "0x1A", "1,5", None, "40d"]
    assert each(spark, numeric, fn.is_numeric_string) == [True] * len(numeric)
    assert each(spark, other, fn.is_numeric_string) == [False] * len(other)
    assert each(spark, ["35.7", " -1 ", "x"], fn.numeric_value) == [35.7, -1.0, None]


def test_file_types_and_their_precedence(spark):
    names = ["p02_base_sms.csv", "x921465_ivr.csv", "A_IVR_SMS.CSV", "a_sms.csv", "plain.csv", "/p02/plain.csv", "SMS"]
    assert each(spark, names, fn.file_type) == ["p02", "p02", "ivr", "sms", None, None, "sms"]


def test_extension_and_base_name(spark):
    paths = ["a.CSV", "x.b.csv", ".csv", "a.csv.bak", "csv", "/d.csv/e", "file:/d/a b.csv"]
    assert each(spark, paths, fn.has_csv_extension) == [True, True, True, False, False, False, True]
    assert each(spark, paths, fn.base_name)[-2:] == ["e", "a b.csv"]
    assert each(spark, ["a.tar.gz", "none"], fn.extension) == ["gz", ""]


def test_plain_path(spark):
    uris = ["file:/tmp/a%20b+c%2520.csv", "file:///tmp/x.csv", "s3a://bucket/k%5B1%5D.csv"]
    assert each(spark, uris, fn.plain_path) == ["file:/tmp/a b+c%20.csv", "file:/tmp/x.csv", "s3a://bucket/k[1].csv"]


def test_form_encoding(spark):
    got = each(spark, ["a b*c~d-e_f.g", "é", "1&2=3%", "", None, "\n"], fn.form_encode)
    assert got == ["a+b%2Ac%7Ed-e_f.g", "%C3%A9", "1%262%3D3%25", "", None, "%0A"]


def test_requests(spark):
    sms = each(spark, ["255712345678"], lambda c: fn.sms_query(F.lit("CARE LINE"), c, F.lit("a&b")))
    assert sms == ["from=CARE+LINE&to=255712345678&text=a%26b&dlr-mask=31"]
    voice = each(spark, ["255712345678"], lambda c: fn.voice_query(c, 9))
    assert voice == ["msisdn=255712345678&account=9&MaxRetries=3&RetryTime=1&WaitTime=1"]


def test_strip_quotes(spark):
    assert each(spark, ['"a,b",""c""', "x", ""], fn.strip_quotes) == ["a,b,c", "x", ""]


def test_durations_wrap_after_a_day(spark):
    got = each(spark, [0, 59, 3_600, 86_399, 86_400, 100_000], fn.hms, "long")
    assert got == ["00:00:00", "00:00:59", "01:00:00", "23:59:59", "00:00:00", "03:46:40"]


def test_local_time_is_three_hours_ahead_whatever_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            frame = spark.sql("select timestamp_ntz'2024-03-10 22:30:00' ts")
            assert frame.select(fn.local_time(F.col("ts")).alias("t")).first().t == "2024-03-11 01:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_rates(spark):
    exact = spark.createDataFrame([(1, 300), (2, 300), (5, 0), (10**12, 10**11)], "n long, d long")
    got = [r.x for r in exact.select(fn.rate_hundredths(F.col("n"), F.col("d")).alias("x")).collect()]
    assert got == [33, 67, 0, 100_000]


def test_rate_per_hour_does_not_overflow(spark):
    frame = spark.createDataFrame([(10**12, 360_000)], "n long, d long")
    got = frame.select(fn.rate_hundredths(F.col("n"), F.col("d"), 3_600).alias("x")).first().x
    assert got == 10**14
