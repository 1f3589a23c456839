import glob
import random

import pytest
from pyspark.sql import functions as F

from muster.operators import position
from muster.operators.position import count_and_reject, count_splits, number_by_key
from muster.operators.validate import flag_rows, valid_rows
from muster.plans import dispatch, load
from muster.sinks import writers
from muster.sources.lists import scan_first_column, scan_lists
from muster.streaming.folder import plan_arrivals
from tests.reference_loop import clean, valid


def messy(put, name, count, seed):
    rand = random.Random(seed)
    cells = [rand.choice([f"255{rand.randrange(10**9):09d}", "bad", "", " x"]) for _ in range(count)]
    return put(name, "MSISDN,N\n" + "".join(f"{cell},{i}\n" for i, cell in enumerate(cells))), cells


@pytest.mark.parametrize("size", [300, 5_000, 10_000_000])
def test_one_pass_counts_and_rejects(spark, put, split_size, size):
    split_size(size)
    paths, cells = zip(*[messy(put, f"{k}.csv", n, k) for k, n in enumerate((900, 30, 0, 2_000))])
    scan = scan_lists(spark, paths, optional=())
    splits, rejected = count_and_reject(flag_rows(scan.rows))
    want = count_splits(valid_rows(scan.rows))
    columns = ["_split", *position.SPLIT_COLUMNS, "_first", "_size"]
    assert sorted(map(tuple, splits.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    bad = sorted(cell for one in cells for cell in one if not valid(clean(cell)))
    assert sorted(r.msisdn_raw for r in rejected.collect()) == bad


def test_a_plan_gives_its_rejects_without_another_scan(spark, put):
    path, cells = messy(put, "a_sms.csv", 500, 1)
    kept = []
    plan = dispatch.plan_campaign(spark, [path], "m", "s", on_rejects=kept.append)
    assert [r.msisdn for r in plan.orderBy("pos").collect()] == [clean(c) for c in cells if valid(clean(c))]
    assert "Scan csv" not in kept[0]._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, kept[0].collect())) == sorted(map(tuple, dispatch.list_rejects(spark, [path]).collect()))
    assert {r.file_path for r in kept[0].collect()} == {f"file:{path}"}
    campaigns = spark.createDataFrame([(c, "a_sms.csv", "m", "s") for c in "xy"], "campaign string, file_name string, message string, sender string")
    again = []
    dispatch.plan_campaigns(spark, [path], campaigns, on_rejects=again.append)
    assert again[0].count() == kept[0].count()


def test_lists_without_rejects_or_rows(spark, put):
    kept = []
    paths = [put("a.csv", "MSISDN\n255000000001\n"), put("b.csv", "MSISDN\n")]
    assert dispatch.plan_campaign(spark, paths, "m", "s", on_rejects=kept.append).count() == 1
    assert kept[0].count() == 0
    assert dispatch.plan_campaign(spark, [], "m", "s", on_rejects=kept.append).count() == kept[1].count() == 0


def test_a_replayed_batch_replaces_its_rejects(spark, put, tmp_path):
    put("in/a_sms.csv", "MSISDN\nbad\n255000000001\nworse\n")
    out = str(tmp_path / "out")
    for _ in range(2):
        plan_arrivals(spark, str(tmp_path / "in"), out, str(tmp_path / "ck"), {"sms": "S"}, "from").awaitTermination()
        for name in ("commits/0", "commits/.0.crc"):
            (tmp_path / "ck" / name).unlink(missing_ok=True)
    rejects = spark.read.parquet(f"{out}/rejects")
    assert sorted(r.msisdn_raw for r in rejects.collect()) == ["bad", "worse"]
    assert {"run", "batch_id"} <= set(rejects.columns)


def test_a_load_run_again_leaves_one_copy(spark, put, tmp_path):
    path = put("load.csv", "X\n255000000000\n255000000001\n\n")
    rows = load.campaign_rows(scan_first_column(spark, path), "2024-05-16 08:30:00")
    target = str(tmp_path / "table")
    for load_id, kept in (("1", rows.limit(1)), ("01", rows), ("1", rows), ("1", rows)):
        assert writers.append_load(kept, target, load_id) == kept.count()
    stored = writers.read_loads(spark, target)
    assert sorted((r.load_id, r.msisdn) for r in stored.collect()) == [(i, f"25500000000{k}") for i in ("01", "1") for k in (0, 1)]
    with pytest.raises(ValueError):
        writers.append_load(rows, target, "../x")


def test_one_output_per_input_with_lines_in_order(spark, put, tmp_path, split_size):
    split_size(1_000)
    texts = {f"{name}.txt": "".join(f'"{name}{i}"\r\n' for i in range(n)) for name, n in (("b", 700), ("a b", 3), ("c", 250), ("d", 0))}
    paths = [put(name, text) for name, text in texts.items()]
    out = str(tmp_path / "out")
    assert writers.write_files_without_quotes(spark, [*paths, paths[0]], out) == 953
    inputs = spark.read.parquet(f"{out}/inputs").orderBy("file_ordinal").collect()
    assert [r.file_path for r in inputs] == [f"file:{p}" for p in (*paths, paths[0])]
    for row in inputs:
        parts = sorted(glob.glob(f"{out}/lines/list_id={row.list_id}/part-*"))
        assert "".join(open(p, newline="").read() for p in parts) == texts[row.file_path.rsplit("/", 1)[1]].replace('"', "")
        assert len(parts) > 3 or row.file_path.endswith(("a b.txt", "d.txt", "c.txt"))


def test_positions_by_key_use_no_python(spark):
    frame = spark.range(1_000).select(F.lit("f").alias("file_name"), (F.col("id") * 3 - 700).alias("row_key"))
    plan = number_by_key(frame, ranges=50)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@pytest.mark.parametrize("bounds", [[], [5], [1, 2, 3], list(range(-40, 60, 7)), [-(2**62), 0, 2**53, 2**53 + 1, 2**62]])
def test_ranges_of_keys(spark, bounds):
    keys = sorted({b + d for b in bounds for d in (-1, 0, 1)} | {0, -(2**63), 2**63 - 1})
    frame = spark.createDataFrame([(k,) for k in [*keys, None]], "k long")
    got = {r.k: r.place for r in frame.select("k", position._range_of(bounds)(F.col("k")).alias("place")).collect()}
    assert got == {**{k: sum(b < k for b in bounds) for k in keys}, None: None}
