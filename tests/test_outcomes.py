import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from muster.operators import lookup, outcomes, position
from muster.plans import dispatch
from muster.sources import lists
from tests import reference_loop

START = datetime(2024, 1, 1)


def issued(spark, rows):
    layout = "file_name string, pos long, msisdn string, transport_errno int, ts timestamp_ntz"
    return dispatch.plan_batches(spark.createDataFrame(rows, layout), 20, 6)


def some_rows(seed=1):
    rand = random.Random(seed)
    rows = []
    for name, count in (("hot.csv", 400), ("b.csv", 20), ("c.csv", 1)):
        for pos in range(count):
            rows.append((name, pos, f"25500000000{rand.randrange(5)}", rand.choice([0, 0, 28, 7]), START + timedelta(seconds=pos)))
    rand.shuffle(rows)
    return rows


def test_totals_equal_keeping_one_result_per_number_and_batch(spark):
    rows = some_rows()
    got = {r.file_name: (r.issued, r.counted, r.sent, r.failed) for r in outcomes.file_totals(issued(spark, rows)).collect()}
    for name in ("hot.csv", "b.csv", "c.csv"):
        ordered = sorted((r for r in rows if r[0] == name), key=lambda r: r[1])
        batches = [((r[1] // 20, r[1] % 20 // 6), r[2], r[3]) for r in ordered]
        assert got[name] == reference_loop.totals(batches)


def test_last_outcome_wins_within_a_batch_only(spark):
    rows = [("f", 0, "a", 28, START), ("f", 1, "a", 0, START), ("f", 5, "a", 7, START), ("f", 6, "a", 0, START)]
    got = outcomes.batch_last_outcomes(issued(spark, rows)).collect()
    assert {(r.batch_no, r.transport_errno, r.issued) for r in got} == {(0, 7, 3), (1, 0, 1)}
    distinct = outcomes.batch_distinct(issued(spark, rows)).collect()
    assert {(r.batch_no, r.issued, r.counted) for r in distinct} == {(0, 3, 1), (1, 1, 1)}


def test_rollup_has_one_row_per_file_and_one_for_all(spark):
    frame = issued(spark, some_rows())
    got = outcomes.totals_rollup(outcomes.file_totals(frame, ts="ts")).collect()
    grand = [r for r in got if r.level == 1]
    files = [r for r in got if r.level == 0]
    assert len(grand) == 1 and grand[0].file_name is None and len(files) == 3
    for column in ("issued", "counted", "sent", "failed"):
        assert grand[0][column] == sum(r[column] for r in files)
    assert grand[0].duration_x100 == 39_900
    assert grand[0].rate_x100 == (grand[0].sent * 200 + 399) // (2 * 399)
    assert next(r for r in files if r.file_name == "c.csv").rate_x100 == 0


def test_span_wraps_after_a_day(spark):
    rows = [("f", 0, "a", 0, START), ("f", 1, "b", 0, START + timedelta(days=1, seconds=61, microseconds=5))]
    got = outcomes.run_span(issued(spark, rows)).first()
    assert (got.started, got.ended) == ("2024-01-01 03:00:00", "2024-01-02 03:01:01")
    assert (got.duration_x100, got.duration) == (8_646_100, "00:01:01")


def test_durations_are_rounded_to_a_hundredth_before_use(spark):
    for micros, hundredths, shown in ((59_994_999, 5_999, "00:00:59"), (59_995_000, 6_000, "00:01:00"), (4_999, 0, "00:00:00")):
        rows = [("f", 0, "a", 0, START), ("f", 1, "b", 0, START + timedelta(microseconds=micros))]
        got = outcomes.run_span(issued(spark, rows)).first()
        assert (got.duration_x100, got.duration) == (hundredths, shown)


def test_rate_guards(spark):
    rows = [("one", 0, "a", 0, START), ("two", 0, "a", 0, START), ("two", 1, "b", 28, START + timedelta(seconds=4))]
    frame = issued(spark, rows)
    totals = outcomes.outcome_counts(frame, ts="ts")
    plain = {r.file_name: r.rate_x100 for r in outcomes.add_rate(totals).collect()}
    assert plain == {"one": 0, "two": 25}
    floored = {r.file_name: r.rate_x100 for r in outcomes.add_rate(totals, floor_seconds=1).collect()}
    assert floored == {"one": 100, "two": 25}
    hourly = {r.file_name: r.rate_x100 for r in outcomes.add_rate(totals, unit_seconds=3_600).collect()}
    assert hourly == {"one": 0, "two": 90_000}


def test_counts_by_error_code(spark):
    rows = [("f", i, "a", errno, START) for i, errno in enumerate([0, 28, 0, 7])]
    got = outcomes.outcome_counts(issued(spark, rows)).first()
    assert (got.sent, got.failed) == (2, 2)


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_batches_are_dealt_out_once(spark, tmp_path):
    path = str(tmp_path / "issued")
    issued(spark, some_rows()).write.parquet(path)
    assert plan_text(outcomes.batch_distinct(spark.read.parquet(path))).count("Exchange hashpartitioning") == 1


def test_totals_read_the_outcomes_once(spark, tmp_path):
    path = str(tmp_path / "issued")
    issued(spark, some_rows()).write.parquet(path)
    plan = plan_text(outcomes.totals_rollup(outcomes.file_totals(spark.read.parquet(path), ts="ts")))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def counted(spark, plan):
    results = plan.withColumn("transport_errno", F.lit(0))
    got = outcomes.file_totals(results).agg(F.sum("issued"), F.sum("counted")).first()
    return tuple(got)


def test_lists_are_told_apart_by_more_than_their_base_name(spark, put):
    numbers = lambda start, n: "MSISDN\n" + "".join(f"2550000{start + i:05d}\n" for i in range(n))
    x, y = put("x/list.csv", numbers(0, 20)), put("y/list.csv", numbers(0, 30))
    assert counted(spark, dispatch.plan_campaign(spark, [x, y], "m", "s")) == (50, 50)
    assert counted(spark, dispatch.plan_campaign(spark, [x, x], "m", "s")) == (40, 40)
    three = spark.createDataFrame([(c, "list.csv", "m", "s") for c in "abc"], "campaign string, file_name string, message string, sender string")
    assert counted(spark, dispatch.plan_campaigns(spark, [x], three)) == (60, 60)


def test_list_positions_of_a_list_in_several_campaigns(spark, put):
    x, y = put("x.csv", "MSISDN\n" + "255000000001\n" * 20), put("y.csv", "MSISDN\n" + "255000000002\n" * 5)
    scan = lists.scan_lists(spark, [x, y])
    rows = [(c, "x.csv", "m", "s") for c in "abc"] + [("d", "y.csv", "m", "s")]
    campaigns = spark.createDataFrame(rows, "campaign string, file_name string, message string, sender string")
    bound = lookup.bind_campaigns(scan.files, campaigns)
    numbered = position.number_by_split(scan.rows, scan.files, bound=bound)
    first = numbered.groupBy("campaign").agg(F.min("list_pos").alias("first"), F.count("*").alias("n")).collect()
    assert {(r.campaign, r.first, r.n) for r in first} == {("a", 0, 20), ("b", 0, 20), ("c", 0, 20), ("d", 20, 5)}
