import os
import time

import pytest
from pyspark.sql import functions as F

from muster.streaming.folder import plan_arrivals

MESSAGES = {"sms": "S", "ivr": "I", "p02": "P"}


@pytest.fixture
def run(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def once(files_per_batch=10, checkpoint="ck"):
        out = str(tmp_path / "out")
        checkpoint = str(tmp_path / checkpoint)
        query = plan_arrivals(
            spark, str(tmp_path / "in"), out, checkpoint, MESSAGES, "from", files_per_batch, chunk=3, batch=2
        )
        query.awaitTermination()
        rows = spark.read.parquet(f"{out}/plan").orderBy("file_name", "pos").collect()
        return [(r.file_name, r.msisdn[-2:], r.pos, r.chunk_no, r.message) for r in rows]

    return once


def test_each_list_is_planned_once(spark, put, tmp_path, run):
    put("in/a_sms.csv", "MSISDN,AGE\n255000000001,4\nbad,\n255000000002,5\n")
    put("in/b_ivr.CSV", "AGE,MSISDN\n4,255000000011\n")
    put("in/nokey_sms.csv", "X\n255000000091\n")
    put("in/plain.csv", "MSISDN\n255000000092\n")
    put("in/z_sms.txt", "MSISDN\n255000000093\n")
    put("in/sub/x_sms.csv", "MSISDN\n255000000094\n")
    first = [("a_sms.csv", "01", 0, 1, "S"), ("a_sms.csv", "02", 1, 1, "S"), ("b_ivr.CSV", "11", 0, 1, "I")]
    assert run() == first
    assert run() == first
    month_ago = time.time() - 30 * 86_400
    os.utime(put("in/c_p02.csv", "MSISDN\n255000000021\n"), (month_ago, month_ago))
    assert run() == [*first, ("c_p02.csv", "21", 0, 1, "P")]
    status = spark.read.parquet(str(tmp_path / "out/status")).collect()
    assert {(r.file_name, r.status) for r in status} == {
        ("a_sms.csv", "ok"),
        ("b_ivr.CSV", "ok"),
        ("c_p02.csv", "ok"),
        ("nokey_sms.csv", "no_key_column"),
        ("plain.csv", "unsupported_type"),
    }


def test_many_micro_batches_and_a_replay(spark, put, tmp_path, run):
    for i in range(5):
        put(f"in/{i}_sms.csv", "MSISDN\n" + "".join(f"2550000000{i}{j}\n" for j in range(4)))
    once = run(files_per_batch=2)
    assert len(once) == 20
    assert {r[2:4] for r in once} == {(0, 1), (1, 1), (2, 1), (3, 2)}
    assert spark.read.parquet(str(tmp_path / "out/plan")).agg(F.count_distinct("batch_id")).first()[0] == 3
    # A replay overwrites its own batch and nothing else.
    os.remove(tmp_path / "ck/commits/2")
    for crc in (tmp_path / "ck/commits").glob(".2.*"):
        os.remove(crc)
    assert run(files_per_batch=2) == once


def test_another_checkpoint_leaves_earlier_plans_alone(spark, put, tmp_path, run):
    put("in/a_sms.csv", "MSISDN\n255000000001\n")
    assert [r[0] for r in run()] == ["a_sms.csv"]
    os.rename(tmp_path / "in/a_sms.csv", tmp_path / "gone")
    put("in/b_sms.csv", "MSISDN\n255000000002\n")
    assert [r[0] for r in run(checkpoint="another")] == ["a_sms.csv", "b_sms.csv"]


def test_any_spelling_of_the_folder(spark, put, tmp_path):
    put("in/a_sms.csv", 'NAME,MSISDN\n"a\nb",255000000001\n')
    for i, spelling in enumerate(("/in//", "//in", "/./in/", "/x/../in", "/in")):
        out = str(tmp_path / f"out{i}")
        query = plan_arrivals(spark, f"file:{tmp_path}{spelling}", out, f"{out}-ck", MESSAGES, "s", multi_line=True)
        query.awaitTermination()
        assert [r.msisdn for r in spark.read.parquet(f"{out}/plan").collect()] == ["255000000001"]
