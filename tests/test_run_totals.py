import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from muster.operators import outcomes
from muster.plans import dispatch, run_totals
from muster.streaming.folder import plan_arrivals
from tests import reference_loop

START = datetime(2024, 1, 1)
LAYOUT = "file_name string, pos long, msisdn string, transport_errno int, ts timestamp_ntz"


def results(spark, name, count, seed=1):
    rand = random.Random(seed)
    rows = [(name, i, f"2550000000{rand.randrange(20):02d}", rand.choice([0, 0, 28]), START + timedelta(seconds=i)) for i in range(count)]
    return rows, dispatch.plan_batches(spark.createDataFrame(rows, LAYOUT), 20, 6)


def grand(spark, totals):
    rolled = outcomes.totals_rollup(run_totals.read_totals(spark, totals)).filter("level > 0").collect()
    return {r.run: (r.issued, r.counted, r.sent, r.failed) for r in rolled}


def test_two_runs_of_equal_lists_are_both_counted(spark, tmp_path):
    out, totals = str(tmp_path / "outcomes"), str(tmp_path / "totals")
    rows, frame = results(spark, "list.csv", 30)
    want = reference_loop.totals([((r[1] // 20, r[1] % 20 // 6), r[2], r[3]) for r in rows])
    run_totals.write_outcomes(frame, out, "007")
    assert run_totals.update_totals(spark, out, totals) == ["run=007/batch_id=0"]
    assert grand(spark, totals) == {"007": want, None: want}
    run_totals.write_outcomes(frame, out, "7")
    assert run_totals.update_totals(spark, out, totals) == ["run=7/batch_id=0"]
    twice = tuple(2 * n for n in want)
    assert grand(spark, totals) == {"007": want, "7": want, None: twice}
    assert twice[0] == 60
    per_list = run_totals.read_totals(spark, totals)
    again = outcomes.merged(per_list, ["file_name"]).collect()
    assert [(r.file_name, r.issued) for r in again] == [("list.csv", 60)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    out, totals = str(tmp_path / "outcomes"), str(tmp_path / "totals")
    _, frame = results(spark, "list.csv", 40)
    for batch_id in (0, 1):
        run_totals.write_outcomes(frame, out, "a", batch_id)
    run_totals.update_totals(spark, out, totals)
    before = grand(spark, totals)
    assert run_totals.update_totals(spark, out, totals) == []
    run_totals.write_outcomes(frame, out, "a", 1)
    assert run_totals.update_totals(spark, out, totals) == ["run=a/batch_id=1"]
    assert grand(spark, totals) == before
    # A replay that has fewer rows, or none, replaces what was there.
    run_totals.write_outcomes(frame.filter("pos < 10"), out, "a", 1)
    run_totals.update_totals(spark, out, totals)
    assert grand(spark, totals)["a"][0] == 50
    run_totals.write_outcomes(frame.filter("pos < 0"), out, "a", 1)
    assert run_totals.update_totals(spark, out, totals) == ["run=a/batch_id=1"]
    assert grand(spark, totals)["a"][0] == 40
    assert run_totals.update_totals(spark, out, totals) == []


def test_an_update_that_stopped_half_way_is_made_up_for(spark, tmp_path, monkeypatch):
    out, totals = str(tmp_path / "outcomes"), str(tmp_path / "totals")
    _, frame = results(spark, "list.csv", 40)
    run_totals.write_outcomes(frame, out, "a")

    def stopped(*args, **options):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(run_totals, "attach", stopped)
        with pytest.raises(RuntimeError):
            run_totals.update_totals(spark, out, totals)
    assert run_totals.update_totals(spark, out, totals) == ["run=a/batch_id=0"]
    assert grand(spark, totals)["a"][0] == 40


def test_only_new_parts_are_read(spark, tmp_path):
    out, totals = str(tmp_path / "outcomes"), str(tmp_path / "totals")
    _, frame = results(spark, "list.csv", 40)
    for batch_id in range(3):
        run_totals.write_outcomes(frame, out, "old", batch_id)
    run_totals.update_totals(spark, out, totals)
    run_totals.write_outcomes(frame, out, "new")
    parts = [row["part"] for row in run_totals.changed_parts(spark, out, totals).collect()]
    assert parts == ["run=new/batch_id=0"]
    made = outcomes.file_totals(run_totals.new_outcomes(spark, out, parts), ts="ts")
    assert all("/run=new/" in path for path in made.inputFiles())
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "InMemoryFileIndex(1 paths)" in plan
    assert {(r.run, r.batch_id) for r in made.collect()} == {("new", 0)}


def test_listing_opens_no_outcomes(spark, tmp_path):
    out = str(tmp_path / "outcomes")
    run_totals.write_outcomes(results(spark, "list.csv", 5)[1], out, "a")
    plan = run_totals.changed_parts(spark, out, str(tmp_path / "none"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_no_outcomes_and_odd_names(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_totals.read_totals(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        run_totals.write_outcomes(results(spark, "x", 1)[1], str(tmp_path), "a/b")


def test_merged_runs_are_refused(spark):
    _, frame = results(spark, "list.csv", 30)
    with pytest.raises(Exception, match="position twice"):
        outcomes.file_totals(frame.unionByName(frame)).collect()
    # Also where each run has only some of the positions.
    parts = frame.filter("pos % 2 = 0").unionByName(frame.filter("pos % 3 = 0"))
    with pytest.raises(Exception, match="position twice"):
        outcomes.file_totals(parts).collect()
    apart = frame.filter("pos % 2 = 0").unionByName(frame.filter("pos % 2 = 1"))
    assert outcomes.file_totals(apart).first().issued == 30
    wide = frame.withColumn("batch_no", F.lit(0).cast("long")).withColumn("chunk_no", F.lit(1).cast("long"))
    wide = wide.unionByName(wide.withColumn("pos", F.col("pos") + 200))
    assert outcomes.file_totals(wide).first().issued == 60
    with pytest.raises(Exception, match="position twice"):
        outcomes.file_totals(wide.unionByName(wide).unionByName(wide).unionByName(wide)).collect()


def test_plans_of_two_checkpoints(spark, put, tmp_path):
    """One list of 30 numbers that two checkpoints have planned, with outcomes for both."""
    put("in/a_sms.csv", "MSISDN\n" + "".join(f"2550000000{i:02d}\n" for i in range(30)))
    out = str(tmp_path / "out")
    for checkpoint in ("one", "two"):
        messages = {"sms": "S", "ivr": "I", "p02": "P"}
        plan_arrivals(spark, str(tmp_path / "in"), out, str(tmp_path / checkpoint), messages, "from").awaitTermination()
    plan = spark.read.parquet(f"{out}/plan").withColumns({"transport_errno": F.lit(0), "ts": F.lit(START)})
    totals = outcomes.file_totals(plan, ts="ts")
    assert totals.count() == 2 and totals.agg(F.sum("issued"), F.sum("counted")).first()[:] == (60, 60)
    answered = str(tmp_path / "answered")
    plan.write.partitionBy("run", "batch_id").parquet(answered)
    assert len(run_totals.update_totals(spark, answered, str(tmp_path / "totals"))) == 2
    assert grand(spark, str(tmp_path / "totals"))[None] == (60, 60, 60, 0)
