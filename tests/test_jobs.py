import json
import os

import pytest
from pyspark.errors import AnalysisException

from muster.__main__ import main
from muster.session import shared_folder


def run(capsys, *args):
    main(list(args))
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_jobs_end_to_end(spark, put, tmp_path, capsys):
    out = lambda name: str(tmp_path / name)
    source = put("raw.csv", '"MSISDN","AGE"\n' + "".join(f'"255{i:09d}","{i}"\n' for i in range(60)) + "bad,\n")
    assert run(capsys, "strip-quotes", source, "--out", out("clean")) == {"written": 62}
    assert run(capsys, "slice", source, "--start", "10", "--limit", "20", "--out", out("cut")) == {"written": 20}
    assert run(capsys, "load", source, "--out", out("table")) == {"inserted": 61}
    blank = put("blank.csv", "X,Y\n1,a\n ,b\n2,c\n")
    assert run(capsys, "load", blank, "--out", out("table2"), "--rejects", out("lost")) == {"inserted": 2, "rejected": 1}
    gone = out("gone.csv")
    got = run(capsys, "campaign", source, gone, "--message", "m", "--sender", "s", "--out", out("sms"))
    assert got == {"files": {"ok": 1, "missing": 1}, "planned": 60}
    assert run(capsys, "rejects", source, "--out", out("bad")) == {"rejected": 1}
    assert spark.read.option("header", True).csv(out("bad")).first().asDict() == {
        "file_path": f"file:{source}",
        "file_name": "raw.csv",
        "msisdn_raw": "bad",
        "reason": "invalid_msisdn",
    }
    results = spark.read.parquet(out("sms")).selectExpr(
        "*", "cast(pos % 4 as int) transport_errno", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,pos) ts"
    )
    results.write.parquet(out("outcomes"))
    totals = run(capsys, "totals", "--outcomes", out("outcomes"), "--out", out("totals"))
    assert totals == {"issued": 60, "counted": 60, "sent": 15, "failed": 45}
    args = ("--older", "o", "--younger", "y", "--sender", "s", "--out", out("seg"))
    assert run(capsys, "segmented", source, *args)["planned"] == 60
    older = spark.read.parquet(out("seg")).filter("message = 'o'").count()
    assert older == 25
    assert run(capsys, "calls", source, "--account", "1", "--out", out("calls"))["planned"] == 60


def test_folder_jobs(spark, put, tmp_path, capsys):
    put("in/a_sms.csv", "MSISDN\n255000000001\n")
    put("in/other.csv", "MSISDN\n255000000002\n")
    args = ("--folder", str(tmp_path / "in"), "--messages", '{"sms": "m"}', "--sender", "s")
    got = run(capsys, "folder", *args, "--out", str(tmp_path / "o"))
    assert got == {"files": {"ok": 1, "unsupported_type": 1}, "planned": 1}
    stream = (*args, "--out", str(tmp_path / "s"), "--checkpoint", str(tmp_path / "ck"))
    assert run(capsys, "arrivals", *stream) == {"batches": 1}
    assert spark.read.parquet(str(tmp_path / "s/plan")).count() == 1


def test_typed_and_campaign_jobs(spark, put, tmp_path, capsys):
    a, b = put("a_sms.txt", "MSISDN\n255000000001\n"), put("other.csv", 'N,MSISDN\n"x\ny",255000000002\n')
    out = lambda name: str(tmp_path / name)
    got = run(capsys, "typed", a, b, "--messages", '{"sms": "m"}', "--sender", "s", "--out", out("t"))
    assert got == {"files": {"ok": 1, "unsupported_type": 1}, "planned": 1}
    table = put("campaigns.csv", "campaign,file_name,message,sender\nc1,other.csv,m1,s\nc2,other.csv,m2,s\n")
    got = run(capsys, "campaigns", a, b, "--campaigns", table, "--multi-line", "--out", out("c"))
    assert got == {"files": {"ok": 2}, "planned": 2}
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        run(capsys, "campaigns", a, b, "--campaigns", table, "--out", out("c"))


def test_jobs_leave_no_tables_behind(spark, put, tmp_path, capsys):
    source = put("a.csv", "MSISDN\n255000000001\n")
    before = set(os.listdir(shared_folder(spark)))
    args = ("campaign", source, "--message", "m", "--sender", "s", "--out", str(tmp_path / "o"))
    assert run(capsys, *args)["planned"] == 1
    assert set(os.listdir(shared_folder(spark))) == before
