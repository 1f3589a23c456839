import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from muster.operators import slicing
from muster.operators.slicing import slice_list
from muster.plans import load
from muster.sinks import writers
from muster.sources.lists import csv_reader, scan_first_column
from muster.sources.text import scan_text


def test_csv_round_trip(spark, tmp_path):
    rows = [(" x ", 'q"r', "", "a,b"), ("é\r", "\\", '\\"', "end")]
    frame = spark.createDataFrame(rows, "A string, B string, C string, D string")
    writers.write_csv(frame, str(tmp_path / "out"))
    got = csv_reader(spark).schema(frame.schema).csv(str(tmp_path / "out")).collect()
    assert sorted((r.A, r.B, r.C or "", r.D) for r in got) == sorted(rows)


def test_quotes_are_removed_from_raw_text(spark, put, tmp_path):
    source = put("in.csv", '"MSISDN","N"\n"255000000001","a,b"\r\nx\n')
    writers.write_without_quotes(scan_text(spark, source), str(tmp_path / "out"))
    text = "".join(open(p, newline="").read() for p in sorted(glob.glob(str(tmp_path / "out/part-*"))))
    assert text == "MSISDN,N\n255000000001,a,b\r\nx\n"


def test_order_of_lines_is_kept_over_parts(spark, put, tmp_path, split_size):
    lines = [f'"{i}"' for i in range(5_000)]
    source = put("in.txt", "\n".join(lines) + "\n")
    split_size(4_000)
    writers.write_without_quotes(scan_text(spark, source), str(tmp_path / "out"))
    parts = sorted(glob.glob(str(tmp_path / "out/part-*")))
    assert len(parts) > 3
    assert "".join(open(p).read() for p in parts) == "".join(f"{i}\n" for i in range(5_000))


def test_table_append_counts_what_it_writes(spark, put, tmp_path):
    path = put("load.csv", "255000000000\n 255000000001 \nanything\n\t\n,x\n")
    rows = load.campaign_rows(scan_first_column(spark, path), "2024-05-16 08:30:00")
    target = str(tmp_path / "table")
    assert writers.append_table(rows, target) == 2
    assert writers.append_table(rows, target) == 2
    stored = spark.read.parquet(target)
    assert sorted(r.msisdn for r in stored.collect()) == ["255000000001"] * 2 + ["anything"] * 2
    assert {(r.status, str(r.created_at), r.updated_at, r.deleted_at) for r in stored.collect()} == {
        ("0", "2024-05-16 08:30:00", None, None)
    }
    assert dict(stored.dtypes)["updated_at"] == "timestamp_ntz"


@pytest.mark.parametrize("size", [200, 10_000_000])
def test_slice(spark, put, split_size, size):
    split_size(size)
    path = put("in.csv", "N,MSISDN,T\r\n" + "".join(f"{i},m{i},t\r\n" for i in range(100)))
    got = slice_list(spark, [path], 20, 30).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(i, str(i), f"m{i}", "t") for i in range(20, 50)]
    assert slice_list(spark, [path], 95, 30).count() == 5
    assert slice_list(spark, [path], 100, 30).count() == 0


def test_slice_over_ordered_files_and_odd_headers(spark, put):
    paths = [put(f"{n}.csv", "MSISDN,MSISDN,\n" + "".join(f"{n}{i},x,\n" for i in range(10))) for n in "ba"]
    got = slice_list(spark, paths, 8, 4).orderBy("pos").collect()
    assert [r.MSISDN for r in got] == ["b8", "b9", "a0", "a1"]
    assert got[0].__fields__ == ["pos", "MSISDN", "MSISDN_1", "_c2"]


def test_slice_reads_only_the_files_in_range(spark, put):
    paths = [put(f"{n}.csv", "MSISDN\n" + "".join(f"{n}{i}\n" for i in range(10))) for n in "cabd"]
    rows = slice_list(spark, [*paths, "/no/such.csv"], 12, 10)
    assert [(r.pos, r.MSISDN) for r in rows.orderBy("pos").collect()] == [
        (pos, f"{'cabd'[pos // 10]}{pos % 10}") for pos in range(12, 22)
    ]
    assert {path.rsplit("/", 1)[1] for path in rows.inputFiles() if path.endswith(".csv")} == {"a.csv", "b.csv"}


def test_slice_needs_the_key_column(spark, put):
    with pytest.raises(ValueError, match="no MSISDN column"):
        slice_list(spark, [put("x.csv", "A,B\n1,2\n")])
    with pytest.raises(ValueError, match="missing"):
        slice_list(spark, ["/no/such.csv"])


def test_slice_written_back_as_csv(spark, put, tmp_path):
    path = put("in.csv", 'MSISDN,NAME\n1,"a ""b"" c"\n2,\n3,"x,y"\n')
    writers.write_csv(slice_list(spark, [path], 0, 3).orderBy("pos").drop("pos"), str(tmp_path / "out"))
    text = "".join(open(p).read() for p in glob.glob(str(tmp_path / "out/part-*.csv")))
    assert text == 'MSISDN,NAME\n1,"a ""b"" c"\n2,\n3,"x,y"\n'


def test_outbox_has_one_folder_per_list(spark, tmp_path):
    rows = spark.createDataFrame([("a b.csv", 1), ("007", 2), ("007", 3)], "file_name string, n long")
    out = str(tmp_path / "o")
    assert writers.write_outbox(rows, out) == 3
    assert sorted(tuple(r) for r in writers.read_outbox(spark, out).collect()) == [("007", 2), ("007", 3), ("a b.csv", 1)]
    assert len(glob.glob(f"{out}/list_id=*")) == 2
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        writers.write_outbox(rows, out)
    assert writers.write_outbox(rows.filter(F.col("n") > 1), out, mode="overwrite") == 2
    assert spark.read.parquet(out).count() == 2


def test_slice_keeps_cells_beyond_the_header(spark, put):
    path = put("in.csv", 'MSISDN,AGE\na,30,extra\nb\n"c,d",5\ne,6,"x,""y""",z\n')
    got = slice_list(spark, [path], 0, 4).orderBy("pos").collect()
    assert got[0].__fields__ == ["pos", "MSISDN", "AGE", "_c2", "_c3"]
    assert [tuple(r)[1:] for r in got] == [
        ("a", "30", "extra", None),
        ("b", None, None, None),
        ("c,d", "5", None, None),
        ("e", "6", 'x,"y"', "z"),
    ]


def test_slice_of_files_with_another_order_of_columns(spark, put):
    one, two = put("1.csv", "MSISDN,AGE\na,1\n"), put("2.csv", "AGE,MSISDN\r\n2,b\r\n3,c,more\r\n")
    got = slice_list(spark, [one, two], 0, 9).orderBy("pos").collect()
    assert [(r.MSISDN, r.AGE, r._c2) for r in got] == [("a", "1", None), ("b", "2", None), ("c\r"[:1], "3", "more")]
    other = put("3.csv", "NAME,MSISDN\nbob,d\n")
    with pytest.raises(ValueError, match="other columns"):
        slice_list(spark, [one, other], 0, 9)


def test_slice_stops_counting_behind_its_range(spark, put, monkeypatch):
    paths = [put(f"{n}.csv", "MSISDN\n" + "".join(f"{n}{i}\n" for i in range(10))) for n in range(9)]
    counted = []
    original = slicing.count_splits

    def watched(rows, *extra):
        counted.extend(rows.inputFiles())
        return original(rows, *extra)

    monkeypatch.setattr(slicing, "count_splits", watched)
    got = slice_list(spark, paths, 12, 10, group_bytes=60)
    assert [r.MSISDN for r in got.orderBy("pos").collect()] == [f"{p // 10}{p % 10}" for p in range(12, 22)]
    assert len(counted) <= 5
