import os

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from muster.operators.position import number_by_split
from muster.plans import dispatch
from muster.sources import headers, lists, remote
from muster.sources.headers import probe_files
from muster.sources.text import scan_text

A, B, C, D = (f"2557000000{i:02d}" for i in range(1, 5))


def read(spark, paths, **options):
    scan = lists.scan_lists(spark, paths, **options)
    rows = number_by_split(scan.rows, scan.files).orderBy("file_ordinal", "pos").collect()
    return [(r.file_ordinal, r.pos, r.msisdn_raw, r.age_raw) for r in rows]


def statuses(spark, paths, **options):
    return [r.status for r in lists.file_status(spark, paths, **options).orderBy("file_ordinal").collect()]


def test_each_list_is_read_by_its_own_header(spark, put):
    one = put("one.csv", f"MSISDN,AGE\n{A},40\n")
    two = put("two.csv", f"AGE,NAME,MSISDN\n20,x,{B}\n")
    none = put("none.csv", f"MSISDN\n{C}\n")
    assert read(spark, [two, none, one]) == [(1, 0, B, "20"), (2, 0, C, None), (3, 0, A, "40")]


def test_header_match_is_exact_and_first(spark, put):
    paths = [
        put("lower.csv", f"msisdn\n{A}\n"),
        put("blank.csv", f" MSISDN\n{A}\n"),
        put("twice.csv", f"MSISDN,MSISDN\n{A},{B}\n"),
        put("both.csv", f"msisdn,MSISDN\n{A},{B}\n"),
        put("quoted.csv", f'"MSISDN","A ""b"""\n{A},1\n'),
    ]
    probed = probe_files(spark, paths).orderBy("file_ordinal").collect()
    assert [r.status for r in probed] == ["no_key_column", "no_key_column", "ok", "ok", "ok"]
    assert [r.key_index for r in probed] == [None, None, 0, 1, 0]
    assert probed[4].header == ["MSISDN", 'A "b"']
    assert [r[2] for r in read(spark, paths)] == [A, B, A]


def test_file_states(spark, put, tmp_path):
    os.mkdir(tmp_path / "folder_sms.csv")
    paths = [
        str(tmp_path / "gone_sms.csv"),
        put("empty_sms.csv", ""),
        put("nokey_sms.csv", "A,B\n1,2\n"),
        put("header_sms.csv", "MSISDN\n"),
        put("plain.csv", f"MSISDN\n{A}\n"),
        str(tmp_path / "folder_sms.csv"),
        put("blank_sms.csv", f"\nMSISDN\n{A}\n"),
    ]
    expected = ["missing", "empty", "no_key_column", "ok", "ok", "unopenable", "no_key_column"]
    assert statuses(spark, paths) == expected
    assert statuses(spark, paths, by_type=True) == [*expected[:4], "unsupported_type", *expected[5:]]
    assert [(r[0], r[2]) for r in read(spark, paths)] == [(5, A)]


def test_no_readable_file_gives_no_rows(spark, put, tmp_path):
    assert read(spark, [str(tmp_path / "gone.csv"), put("empty.csv", "")]) == []
    assert read(spark, []) == []
    assert read(spark, [put("header.csv", "MSISDN,AGE\n")]) == []


def test_byte_order_mark_line_ends_and_blank_lines(spark, put):
    bom = put("bom.csv", b"\xef\xbb\xbfMSISDN,AGE\r\n" + f"{A},40\r\n\r\n{B},\r\n{C}".encode())
    assert read(spark, [bom]) == [(1, 0, A, "40\r"), (1, 1, B, "\r"), (1, 2, C, None)]
    assert probe_files(spark, [bom]).first().crlf


def test_short_long_and_quoted_rows(spark, put):
    path = put("rows.csv", f'X,MSISDN,AGE\n1\n1,{A},2,extra\n"a, ""b""","{B}",""\n')
    assert read(spark, [path]) == [(1, 0, None, None), (1, 1, A, "2"), (1, 2, B, None)]


def test_quoted_line_breaks_need_multi_line(spark, put):
    path = put("lines.csv", f'NAME,MSISDN\n"a\nb",{A}\nc,{B}\n')
    assert [r[2] for r in read(spark, [path], multi_line=True)] == [A, B]


def test_odd_file_names(spark, put):
    names = ["a b.csv", "c[1]{x}.csv", "d%20+e.csv", "é*?.csv", "f#g.csv"]
    paths = [put(name, f"MSISDN\n{i:012d}\n") for i, name in enumerate(names)]
    assert [r[2] for r in read(spark, paths)] == [f"{i:012d}" for i in range(len(names))]
    scan = lists.scan_lists(spark, paths)
    named = number_by_split(scan.rows, scan.files).orderBy("file_ordinal").collect()
    assert [r.file_name for r in named] == names


def test_a_list_named_twice_is_read_twice(spark, put):
    one, two = put("1.csv", f"MSISDN\n{A}\n{B}\n"), put("2.csv", f"MSISDN\n{C}\n")
    assert [(r[0], r[1], r[2]) for r in read(spark, [one, two, one])] == [
        (1, 0, A),
        (1, 1, B),
        (2, 0, C),
        (3, 0, A),
        (3, 1, B),
    ]


def test_discovery(spark, put, tmp_path):
    for name in ["b_sms.csv", "a_IVR.CSV", "p02.Csv", "z_sms.txt", "plain.csv", "sub/c_sms.csv", "k=v/d_sms.csv"]:
        put(name, "MSISDN\n")
    put("zero_sms.csv", "")
    os.mkdir(tmp_path / "dir_sms.csv")
    put("dir_sms.csv/inner_sms.csv", "MSISDN\n")
    found = lists.discover_files(spark, str(tmp_path)).orderBy("file_ordinal").collect()
    assert [(r.file_ordinal, r.file_name, r.file_type) for r in found] == [
        (1, "a_IVR.CSV", "ivr"),
        (2, "b_sms.csv", "sms"),
        (3, "p02.Csv", "p02"),
        (4, "zero_sms.csv", "sms"),
    ]
    only = lists.discover_files(spark, str(tmp_path), ["ivr"]).collect()
    assert [r.file_name for r in only] == ["a_IVR.CSV"]


def test_discovery_without_files_or_folder(spark, tmp_path):
    assert lists.discover_files(spark, str(tmp_path)).collect() == []
    assert lists.discover_files(spark, str(tmp_path / "none")).collect() == []


def test_first_column_whatever_its_name(spark, put):
    path = put("load.csv", f'anything,MSISDN\n{A},x\n"{B}",y\n,z\n')
    got = lists.scan_first_column(spark, path).select(F.coalesce("cell", F.lit(""))).collect()
    assert [r[0] for r in got] == [A, B, ""]


def test_text_keeps_carriage_returns(spark, put):
    assert [r.line for r in scan_text(spark, put("t.txt", "a\r\nb\n\n c")).collect()] == ["a\r", "b", "", " c"]


def test_many_lists_in_one_probe(spark, put):
    paths = [put(f"{i:04d}.csv", f"MSISDN\n{A}\n") for i in range(300)]
    assert probe_files(spark, paths).filter("status = 'ok'").count() == 300
    assert len(read(spark, paths)) == 300


def test_any_spelling_of_a_path(spark, put, tmp_path, monkeypatch):
    put("x/list_sms.csv", f"MSISDN\n{A}\n{B}\n")
    (tmp_path / "y").mkdir()
    monkeypatch.chdir(tmp_path)
    full = str(tmp_path)
    spellings = [f"{full}//x/list_sms.csv", f"file:{full}/x/../x/./list_sms.csv", f"file://{full}/x//list_sms.csv", f"{full}/y/../x/list_sms.csv"]
    for spelling in spellings:
        plan = dispatch.plan_campaign(spark, [spelling], "m", "s")
        assert [(r.msisdn, r.file_path) for r in plan.orderBy("pos").collect()] == [
            (n, f"file:{full}/x/list_sms.csv") for n in (A, B)
        ], spelling
    for folder in (f"{full}/x/", f"{full}//x", f"file:{full}/./x", f"{full}/y/../x//"):
        assert [r.file_name for r in lists.discover_files(spark, folder).collect()] == ["list_sms.csv"], folder


def test_full_spelling():
    home = "hdfs://name:9000/user/me"
    assert remote.qualify("a//b/../c.csv", home) == "hdfs://name:9000/user/me/a/c.csv"
    assert remote.qualify("/a/./b/", home) == "hdfs://name:9000/a/b"
    assert remote.qualify("s3a://bucket//k/../x", home) == "s3a://bucket/x"
    assert remote.qualify("file:///a//b", home) == remote.qualify("/a/b", "file:/w") == "file:/a/b"
    assert remote.qualify("viewfs://store", home) == "viewfs://store/"
    assert remote.qualify("c.csv", "file:/w") == "file:/w/c.csv"


def test_relative_paths_start_from_the_home_of_the_file_system(spark):
    home = remote.home_folder(spark)
    assert home.startswith("file:/") and remote.qualify("x", home) == f"{home}/x"


def test_brackets_in_a_name_are_no_pattern(spark, put):
    named, other = put("c[1].csv", f"MSISDN\n{A}\n"), put("c1.csv", f"MSISDN\n{B}\n")
    assert [r.cell for r in lists.scan_first_column(spark, named).collect()] == [A]
    assert [r.line for r in scan_text(spark, named).collect()] == ["MSISDN", A]
    assert [r.msisdn for r in dispatch.plan_campaign(spark, [named], "m", "s").collect()] == [A]
    assert sorted(r.cell for r in lists.scan_first_column(spark, other.replace("c1", "c*"), patterns=True).collect()) == [A, B]


def test_a_read_that_fails_fails_the_job(spark, put, monkeypatch):
    path = put("a.csv", f"MSISDN\n{A}\n")

    def locate_slow():
        def locate(path):
            class Slow:
                def get_file_info(self, inner):
                    raise OSError("SlowDown: reduce your request rate")

            return Slow(), path

        return locate

    monkeypatch.setattr(headers, "task_filesystem", locate_slow)
    with pytest.raises(PythonException, match="SlowDown"):
        dispatch.plan_campaign(spark, [path], "m", "s")


def test_a_first_line_without_end_fails_the_job(spark, put, monkeypatch):
    monkeypatch.setattr(headers, "HEADER_BYTES", 100)
    with pytest.raises(PythonException, match="over 100 bytes"):
        probe_files(spark, [put("a.csv", "x" * 500)]).collect()


def test_refused_files_have_a_status(spark, put, monkeypatch):
    path = put("a.csv", f"MSISDN\n{A}\n")

    def refusing():
        def locate(path):
            class Refusing:
                def get_file_info(self, inner):
                    raise PermissionError(inner)

            return Refusing(), path

        return locate

    monkeypatch.setattr(headers, "task_filesystem", refusing)
    assert statuses(spark, [path]) == ["unopenable"]


def test_quoted_line_breaks_in_plans_and_rejects(spark, put):
    path = put("q_sms.csv", f'NAME,MSISDN\n"a\nb",{A}\n"c\n\nd",{B}\nx,bad\n')
    plan = dispatch.plan_campaign(spark, [path], "m", "s", multi_line=True)
    assert [(r.pos, r.msisdn) for r in plan.orderBy("pos").collect()] == [(0, A), (1, B)]
    assert [r.msisdn_raw for r in dispatch.list_rejects(spark, [path], multi_line=True).collect()] == ["bad"]
    typed = dispatch.plan_typed_paths(spark, [path], {"sms": "m"}, "s", multi_line=True)
    calls = dispatch.plan_call_list(spark, [path], 1, multi_line=True)
    assert typed.count() == calls.count() == 2
