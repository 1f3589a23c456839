import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from muster.operators import slicing
from muster.operators.slicing import slice_list
from muster.plans import dispatch
from muster.sinks import writers
from muster.sources import lists, records


def bytes_read(spark):
    """Bytes that Spark's own readers in this process have read from local files."""
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")


@pytest.fixture
def ranges_read(monkeypatch):
    """Lengths of the byte ranges that tasks were given to read."""
    read = []
    for name in ("measure_ranges", "read_ranges"):

        def watched(spark, path, ranges, *options, original=getattr(records, name)):
            read.extend(length for _, length in ranges)
            return original(spark, path, ranges, *options)

        monkeypatch.setattr(records, name, watched)
    return read


def part_text(out):
    return "".join(open(path, newline="").read() for path in sorted(glob.glob(f"{out}/part-*.csv")))


def big_list(put, name, rows, cell="x" * 40):
    return put(name, "MSISDN,NOTE\n" + "".join(f"{i:012d},{cell}\n" for i in range(rows)))


@pytest.mark.parametrize("multi_line", [False, True])
def test_a_slice_of_a_large_file_reads_little_of_it(spark, put, split_size, ranges_read, multi_line):
    path = big_list(put, "big.csv", 400_000)
    size = os.path.getsize(path)
    split_size(1 << 20)
    assert size > 20 << 20
    before = bytes_read(spark)
    rows = slice_list(spark, [path], 10_000, 20_000, multi_line, group_bytes=1 << 20)
    got = rows.agg(F.min("pos"), F.max("pos"), F.count("*"), F.min("MSISDN"), F.max("MSISDN")).first()
    read = bytes_read(spark) - before + sum(ranges_read)
    assert tuple(got) == (10_000, 29_999, 20_000, f"{10_000:012d}", f"{29_999:012d}")
    slice_bytes = 30_000 * 54
    # The slice and what is before it are counted, the splits hit are read again, and counting may go a step too far.
    assert read < 4 * slice_bytes + (4 << 20) < size / 2


@pytest.mark.parametrize("length", [1, 10, 999, 5_000])
def test_a_range_reads_no_more_than_its_lines(put, monkeypatch, length):
    """All ranges together give each line once, and each reads a portion beyond its end at most."""
    lines = [f"é{i}" * (i % 9) for i in range(700)]
    path = put("lines.txt", "\n".join(lines) + "\n")
    taken = []

    class Watched:
        def __init__(self, file):
            self.file, self.seek = file, file.seek

        def read(self, n):
            data = self.file.read(n)
            taken.append(len(data))
            return data

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self.file.close()

    class Opener:
        def open_input_file(self, inner):
            return Watched(open(inner, "rb"))

    monkeypatch.setattr(records, "task_filesystem", lambda: lambda path: (Opener(), path))
    monkeypatch.setattr(records, "CHUNK_BYTES", 64)
    got = []
    for begin, size in records.byte_ranges(os.path.getsize(path), length):
        taken.clear()
        got += [line for _, part in records._range_lines(path, begin, size) for line in part.to_pylist()]
        assert sum(taken) <= size + 2 * 64 + 1
    assert got == lines


def test_the_end_of_a_large_file(spark, put, split_size):
    split_size(10_000)
    path = big_list(put, "big.csv", 5_000, "y")
    tail = slice_list(spark, [path], 4_990, 100, group_bytes=1_000).orderBy("pos").collect()
    assert [(r.pos, r.MSISDN) for r in tail] == [(i, f"{i:012d}") for i in range(4_990, 5_000)]
    assert slice_list(spark, [path], 5_000, 10, group_bytes=1_000).collect() == []
    assert slice_list(spark, [path], 5_000, 10, group_bytes=1_000).columns == ["pos", "MSISDN", "NOTE"]


@pytest.mark.parametrize("seed", range(4))
def test_large_and_small_files_equal_reading_in_order(spark, put, split_size, seed):
    draw = random.Random(seed)
    multi_line, split = seed % 2 == 1, draw.choice([60, 300, 2_000])
    split_size(split)
    paths, want = [], []
    for k in range(6):
        swapped, end = draw.random() < 0.5, "\r\n" if draw.random() < 0.4 else "\n"
        text = ("N,MSISDN" if swapped and k else "MSISDN,N") + end
        for i in range(draw.choice([0, 1, 5, 60, 200])):
            note = draw.choice(["", "a b", "é"]) if not multi_line else draw.choice(['"a\nb"', '"x ""y"", z"', "plain", '"\n\n"'])
            plain = note[1:-1].replace('""', '"') if note.startswith('"') else note
            key, more = f"{k}-{i}", ["more"] if draw.random() < 0.05 else []
            text += ",".join(([note, key] if swapped and k else [key, note]) + more) + end
            want.append((len(want), key, plain, *(more or [None])))
        paths.append(put(f"{k}.csv", text))
    for _ in range(2):
        start, limit = draw.randrange(len(want) + 5), draw.choice([1, 7, 100, 10_000])
        cut = slice_list(spark, paths, start, limit, multi_line, group_bytes=draw.choice([1, 500, 1 << 20]))
        got = [(r[0], r[1], r[2] or "", r[3] if len(r) > 3 else None) for r in cut.orderBy("pos").collect()]
        assert got == want[start : start + limit], (split, start, limit)


def test_cells_beyond_the_header_of_a_large_file(spark, put, split_size):
    split_size(100)
    lines = [f'{i},"a, ""b"""' + (",more" if i == 30 else "") + (',"x\ny",z' if i == 60 else "") for i in range(90)]
    path = put("big.csv", "MSISDN,N\n" + "\n".join(lines) + "\n")
    cut = lambda *range_: slice_list(spark, [path], *range_, multi_line=True, group_bytes=10)
    assert cut(31, 20).columns == ["pos", "MSISDN", "N"]
    assert cut(20, 20).columns == ["pos", "MSISDN", "N", "_c2"]
    wide = cut(55, 10).orderBy("pos").collect()
    assert wide[5][1:] == ("60", 'a, "b"', "x\ny", "z") and wide[4][1:] == ("59", 'a, "b"', None, None)


def test_a_slice_is_written_in_order(spark, put, tmp_path, split_size):
    split_size(100_000)
    small, large = big_list(put, "a.csv", 300, "s"), big_list(put, "b.csv", 40_000, "l")
    rows = slice_list(spark, [large, small], 39_000, 1_200)
    out = str(tmp_path / "out")
    assert writers.write_csv_in_order(rows, out, rows_per_part=100) == 1_200
    parts = sorted(glob.glob(f"{out}/part-*.csv"))
    assert len(parts) == 12
    want = [f"{i:012d},l" for i in range(39_000, 40_000)] + [f"{i:012d},s" for i in range(200)]
    assert [line for line in part_text(out).splitlines() if line != "MSISDN,NOTE"] == want
    assert part_text(out).startswith("MSISDN,NOTE\n")


def test_ordered_writing_of_odd_positions(spark, tmp_path):
    rows = spark.createDataFrame([(5, "a"), (5, "b"), (1_000, "d"), (7, "c")], "pos long, x string").repartition(4)
    assert writers.write_csv_in_order(rows, str(tmp_path / "gaps"), rows_per_part=10) == 4
    lines = [line for line in part_text(tmp_path / "gaps").splitlines() if line != "x"]
    assert lines[2:] == ["c", "d"] and sorted(lines[:2]) == ["a", "b"]
    assert writers.write_csv_in_order(rows.filter("pos < 0"), str(tmp_path / "none")) == 0
    plan = rows.repartitionById(3, F.col("pos").cast("int"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_quoted_files_are_read_by_many_tasks(spark, put, split_size):
    split_size(2_000)
    text = "NAME,MSISDN\n" + "".join(f'"name\n""{i}"", line",255{i:09d}\n' for i in range(2_000))
    path = put("q.csv", text)
    scan = lists.scan_lists(spark, [path], optional=(), multi_line=True)
    assert scan.rows.select("split_start").distinct().count() > 20
    plan = dispatch.plan_lists(spark, [path], multi_line=True).orderBy("pos").collect()
    assert [(r.pos, r.msisdn) for r in plan] == [(i, f"255{i:09d}") for i in range(2_000)]


QUOTED = 'NAME,MSISDN\n"a\n\n""b"", c\n",1\n \nx"y,2\n"\n",3\n,4\n"é ""\n""",5\n'
QUOTED_CELLS = [("a\n\n\"b\", c\n", "1"), ('x"y', "2"), ("\n", "3"), (None, "4"), ('é "\n"', "5")]


def test_a_cut_at_every_byte_of_quoted_cells(put):
    path = f"file:{put('q.csv', QUOTED)}"
    whole = [row["line"] for batch in records._read(records._range_lines(path, 0, 1000), records.Layout()) for row in batch.to_pylist()]
    assert len(whole) == 5
    for size in range(1, len(QUOTED.encode()) + 2):
        ranges = records.byte_ranges(len(QUOTED.encode()), size)
        measured = [row for at in ranges for b in records._measured(records._range_lines(path, *at), True) for row in b.to_pylist()]
        measured = [{**row, "path": path} for row in measured]
        inside = records.inside_splits(measured)
        heads = {(path, r["split_start"]): (r["head"], r["ends_open_if_open"]) for r in measured if inside[path, r["split_start"]]}
        layout = records.Layout(records.starts_of(inside, heads))
        read = [row for at in ranges for b in records._read(records._range_lines(path, *at), layout) for row in b.to_pylist()]
        assert [row["line"] for row in read] == whole, size
        counted = [r["records_if_open" if inside[path, r["split_start"]] else "records"] for r in measured]
        assert sum(counted) == 5, size


@pytest.mark.parametrize("size", [3, 17, 40])
def test_cuts_of_quoted_cells(spark, put, split_size, size):
    path = put("q.csv", QUOTED)
    split_size(size)
    cut = slice_list(spark, [path], 0, 100, True, group_bytes=1).orderBy("pos").collect()
    assert [(r.NAME, r.MSISDN) for r in cut] == QUOTED_CELLS
    rows = lists.scan_first_column(spark, path, multi_line=True).collect()
    assert sorted(r.cell or "" for r in rows) == sorted(name or "" for name, _ in QUOTED_CELLS)


def test_long_cells_make_splits_larger(spark, put, split_size, monkeypatch):
    split_size(500)
    monkeypatch.setattr(records, "HEAD_BYTES", 1_000)
    text = "NAME,MSISDN\n" + "".join('"' + "long line\n" * 300 + f'",{i}\n' for i in range(5)) + "z,9\n"
    path = put("q.csv", text)
    rows = lists.scan_lists(spark, [path], optional=(), multi_line=True).rows.collect()
    assert sorted(r.msisdn_raw for r in rows) == ["0", "1", "2", "3", "4", "9"]


def test_wrong_utf8_is_read(spark, put):
    path = put("w.csv", b'NAME,MSISDN\n"a\n\xff",1\n\xe9,2\n')
    cut = slice_list(spark, [path], 0, 9, True, group_bytes=1).orderBy("pos").collect()
    assert [tuple(r)[1:] for r in cut] == [("a\n�", "1"), ("�", "2")]


def test_states_of_lines():
    for line, inside, after in (
        ('a,"b', False, True), ('a,"b""', False, True), ('a,"b"', False, False), ('a"b,c"', False, False), ('"a"b,"', False, True),
        ('x"', True, False), ('x""', True, True), ('x"",y', True, True), ('x",y,"', True, True), ('"', True, False), ("", True, True),
    ):
        assert records.open_after(line, inside) == after, line
    assert [records.cell_count(r) for r in ("a", ",", '"a,b",c', '"a\n,""",', "")] == [1, 2, 2, 2, 1]


def test_ranges_are_counted_in_growing_steps(spark, put, monkeypatch):
    path = big_list(put, "big.csv", 3_000, "y")
    steps, original = [], records.measure_ranges

    def watched(spark, path, ranges, *options):
        steps.append(len(ranges))
        return original(spark, path, ranges, *options)

    monkeypatch.setattr(records, "measure_ranges", watched)
    ranges = records.byte_ranges(os.path.getsize(path), 1_000)
    found = slicing._measured_until(spark, f"file:{path}", ranges, False, 600)
    assert 600 < sum(r["records"] for r in found) < 1_800 and len(steps) < 5
    assert [r["split_start"] for r in found] == [1_000 * i for i in range(len(found))]


def test_a_store_that_tasks_cannot_open_is_counted_by_files(spark, put, monkeypatch):
    monkeypatch.setattr(slicing, "can_open", lambda path: False)
    path = big_list(put, "big.csv", 300, "y")
    cut = slice_list(spark, [path], 10, 3, group_bytes=10).orderBy("pos").collect()
    assert [r.MSISDN for r in cut] == [f"{i:012d}" for i in range(10, 13)]
