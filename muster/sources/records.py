"""Records of list files, read in splits that need not start at a record.

Spark's own text reader gives the lines of a file in splits; a cell in quotes may hold line ends, so a split may start
inside a record. Whether it does is only known from all that stands before it, and is found in two passes. The first
reads every split under both assumptions, that it starts between records and that it starts inside a quoted cell, and
leaves one small row: how the split ends and how many records start in it under either, and the few lines up to the
end of the cell it may have started in. Put one after another these rows tell how each split truly starts. The second
pass reads the splits again, each from its first record on; what a record lacks at the end of a split are the first
lines of the next ones. So a file of quoted cells is read by as many tasks as any other, and nothing but the rows of
the first pass comes to the driver: at most ``MOST_SPLITS`` of them, as splits are made larger for more bytes.

Where only part of a file is wanted, the same two passes run over byte ranges of it (``measure_ranges``, ``read_ranges``):
a task opens the file at its range and reads that alone. A line belongs to the range that its first byte is in.

A quote opens a quoted cell at the start of a cell only; inside, two quotes stand for one; after the closing quote the
cell goes on to the next comma or line end. Lines of blanks between records do not exist. A record left open at the end
of its file ends there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from muster.functions import plain_path
from muster.session import child_session, scratch_path, ship
from muster.sources.remote import as_literal, decode_listed, task_filesystem

# Splits that are described on the driver, and the bytes of their first lines that are held there, at most.
MOST_SPLITS = 100_000
HEAD_BYTES = 32 << 20
# The lines up to the end of an opened cell are noted in the first pass up to so many characters.
HEAD_CHARACTERS = 1 << 16
# Stands for any number of cells: a bound that only counts commas cannot tell it for records of several lines.
MANY_CELLS = 1 << 30
# Bytes of a range that are read at a time.
CHUNK_BYTES = 1 << 20

BLANKS = "".join(map(chr, range(33)))
REST_OF_QUOTED = re.compile(r'(?:[^"]|"")*+"')
MEASURES = (
    "split_path string, split_start long, split_length long, ends_open boolean, ends_open_if_open boolean, "
    "records long, records_if_open long, most_cells long, head string, complete boolean"
)
RECORDS = "pos long, line string, cells long, split_path string, split_start long, split_length long"


@dataclass(frozen=True)
class Start:
    """How a split starts: inside a record or not, at which position, and what its last record lacks."""

    inside: bool = False
    pos: int = 0
    tail: str | None = None


@dataclass(frozen=True)
class Layout:
    """What the second pass needs to know: splits that start in a special way, and whether cells may hold line ends.

    No record from position ``end`` on is wanted. With ``strip_cr`` the carriage return at the end of a record goes.
    """

    starts: Mapping[tuple[str, int], Start] = field(default_factory=dict)
    quoted: bool = True
    end: int | None = None
    strip_cr: bool = False


def split_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session in which every split of ``split_bytes`` is read by a task of its own, whatever the number of cores."""
    settings = {
        "spark.sql.files.maxPartitionBytes": split_bytes,
        "spark.sql.files.minPartitionNum": 1,
    }
    return child_session(spark, settings)


def line_scan(session: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with the split they start in, for a session made by ``split_session``."""
    lines = session.read.option("lineSep", "\n").text([as_literal(path) for path in paths])
    return lines.select(
        F.make_valid_utf8("value").alias("line"),
        F.input_file_name().alias("split_path"),
        F.input_file_block_start().alias("split_start"),
        F.input_file_block_length().alias("split_length"),
    )


def split_bytes_for(spark: SparkSession, total_bytes: int, most_splits: int = MOST_SPLITS) -> int:
    """The session's size of splits, or a larger one where there would be too many."""
    return max(bytes_of(spark, "spark.sql.files.maxPartitionBytes"), -(-total_bytes // most_splits), 1)


def bytes_of(spark: SparkSession, setting: str) -> int:
    """A setting such as 128MB as a number."""
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting)))


def measure_splits(lines: DataFrame, quoted: bool) -> DataFrame:
    """First pass: one row per split that has lines."""
    ship(lines.sparkSession)
    return lines.mapInArrow(lambda batches: _measured(_of_batches(batches), quoted), MEASURES)


def read_records(lines: DataFrame, layout: Layout) -> DataFrame:
    """Second pass: the records with their position, counted on from that of their split, without the headers."""
    ship(lines.sparkSession)
    return lines.mapInArrow(lambda batches: _read(_of_batches(batches), layout), RECORDS)


def byte_ranges(size: int, length: int) -> list[tuple[int, int]]:
    return [(start, min(length, size - start)) for start in range(0, size, length)]


def measure_ranges(spark: SparkSession, path: str, ranges: Sequence[tuple[int, int]], quoted: bool, enough: int) -> list[Row]:
    """First pass over some byte ranges of a file, each read up to the record after ``enough`` ones; one row per range with lines."""
    ship(spark)

    def measure(batches):
        for begin, length in _own(batches, ranges):
            yield from _measured(_range_lines(path, begin, length), quoted, enough)

    return _one_task_each(spark, len(ranges)).mapInArrow(measure, MEASURES).collect()


def read_ranges(spark: SparkSession, path: str, ranges: Sequence[tuple[int, int]], layout: Layout) -> DataFrame:
    """Second pass over some byte ranges of a file; the rest of it is not touched."""
    ship(spark)

    def read(batches):
        for begin, length in _own(batches, ranges):
            yield from _read(_range_lines(path, begin, length), layout)

    return _one_task_each(spark, len(ranges)).mapInArrow(read, RECORDS)


def _one_task_each(spark, count):
    return spark.range(0, count, 1, max(count, 1))


def _own(batches, ranges):
    for batch in batches:
        for i in batch.column(0).to_pylist():
            yield ranges[i]


def _range_lines(path, begin, length):
    """The lines that begin in a byte range, in portions, as lines of a split."""
    import pyarrow as pa

    key = (path, begin, length)
    filesystem, inner = task_filesystem()(path)
    with filesystem.open_input_file(inner) as file:
        end, at = begin + length, begin
        skipping = False
        if begin:
            file.seek(begin - 1)
            skipping = file.read(1) != b"\n"
        carry = b""
        while data := file.read(CHUNK_BYTES):
            if skipping:
                cut = data.find(b"\n") + 1
                at += cut or len(data)
                skipping, data = not cut, data[cut:] if cut else b""
                if at >= end:
                    return
            data = carry + data
            # The last line to begin in the range is the one that its last byte is in.
            last = data.find(b"\n", end - at - 1) if at + len(data) >= end else -1
            cut = (last if last >= 0 else data.rfind(b"\n")) + 1
            if cut:
                yield key, pa.array(data[: cut - 1].decode("utf-8", "replace").split("\n"), pa.string())
                at += cut
            if last >= 0:
                return
            carry = data[cut:]
        if carry:
            yield key, pa.array([carry.decode("utf-8", "replace")], pa.string())


def quoted_layout(spark: SparkSession, sizes: Mapping[str, int]) -> tuple[SparkSession, Layout]:
    """A session to read files with quoted line ends in, and how their splits start in it.

    Where a cell is so long that its end is not noted, or the ends of cells are too many bytes, splits are made larger; a
    file that is one split has no such ends.
    """
    split_bytes = split_bytes_for(spark, sum(sizes.values()))
    while True:
        session = split_session(spark, split_bytes)
        split = [path for path, size in sizes.items() if size > split_bytes]
        if not split:
            return session, Layout()
        path = scratch_path(spark, "measures")
        measure_splits(line_scan(session, split), True).write.parquet(path)
        measured = spark.read.parquet(path)
        flags = measured.select(_path().alias("path"), "split_start", "ends_open", "ends_open_if_open")
        inside = inside_splits(flags.collect())
        heads = heads_of(measured, inside)
        if heads is not None:
            return session, Layout(starts_of(inside, heads))
        split_bytes *= 8


def _path():
    return plain_path(F.col("split_path"))


def inside_splits(rows) -> dict[tuple[str, int], bool]:
    """Whether each split starts inside a record, by file and start, in this order."""
    out, path, is_open = {}, None, False
    for row in sorted(rows, key=lambda row: (row["path"], row["split_start"])):
        is_open = is_open and row["path"] == path
        path = row["path"]
        out[path, row["split_start"]] = is_open
        is_open = row["ends_open_if_open"] if is_open else row["ends_open"]
    return out


def heads_of(measured: DataFrame, inside: Mapping[tuple[str, int], bool]) -> dict | None:
    """First lines of the splits that start inside a record; None if they are too long to be held."""
    wanted = [key for key, is_inside in inside.items() if is_inside]
    if not wanted:
        return {}
    keys = measured.sparkSession.createDataFrame(wanted, "path string, split_start long")
    heads = measured.withColumn("path", _path()).join(F.broadcast(keys), ["path", "split_start"])
    size = heads.agg(F.sum(F.octet_length("head")), F.count_if(F.col("head").isNull())).first()
    if size[1] or (size[0] or 0) > HEAD_BYTES:
        return None
    return {(row["path"], row["split_start"]): (row["head"], row["ends_open_if_open"]) for row in heads.collect()}


def starts_of(inside: Mapping[tuple[str, int], bool], heads: Mapping, pos: Mapping | None = None) -> dict:
    """Starts of the splits that differ from a plain one."""
    tails: dict[tuple[str, int], list[str]] = {}
    owner = None
    for key, is_inside in inside.items():
        if is_inside:
            tails.setdefault(owner, []).append(heads[key][0])
        # A split that is inside a record from end to end starts none.
        if not is_inside or not _within(heads[key]):
            owner = key
    out = {}
    for key, is_inside in inside.items():
        tail = "\n".join(tails[key]) if key in tails else None
        if is_inside or tail is not None or pos is not None:
            out[key] = Start(is_inside, pos[key] if pos is not None else 0, tail)
    return out


def _within(head) -> bool:
    text, ends_open = head
    return ends_open and open_after(text, True)


def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after some lines of a file, given whether one is before them."""
    at = 0
    if inside:
        rest = REST_OF_QUOTED.match(line)
        if not rest:
            return True
        at = line.find(",", rest.end()) + 1
        if not at:
            return False
    while True:
        if line.startswith('"', at):
            rest = REST_OF_QUOTED.match(line, at + 1)
            if not rest:
                return True
            at = rest.end()
        at = line.find(",", at) + 1
        if not at:
            return False


def cell_count(record: str) -> int:
    """Cells of a record, as its commas outside of quoted cells tell."""
    if '"' not in record:
        return record.count(",") + 1
    count, at = 1, 0
    while True:
        if record.startswith('"', at):
            rest = REST_OF_QUOTED.match(record, at + 1)
            if not rest:
                return count
            at = rest.end()
        at = record.find(",", at) + 1
        if not at:
            return count
        count += 1


def _of_batches(batches) -> Iterator[tuple[tuple[str, int, int], object]]:
    """The lines of a scan by split, as ((path, start, length), lines)."""
    for batch in batches:
        yield from _pieces(batch)


def _pieces(batch):
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    paths, starts = batch.column(1), batch.column(2)
    changed = pc.or_(pc.not_equal(starts[1:], starts[:-1]), pc.not_equal(paths[1:], paths[:-1]))
    cuts = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        key = (paths[begin].as_py(), starts[begin].as_py(), batch.column(3)[begin].as_py())
        yield key, batch.column(0).slice(begin, end - begin)


def _shape(lines, quoted):
    """Which lines are not blank, and the places of those that hold a quote."""
    import numpy as np
    import pyarrow.compute as pc

    solid = pc.greater(pc.binary_length(pc.utf8_trim(lines, BLANKS)), 0).to_numpy(zero_copy_only=False)
    if not quoted:
        return solid, []
    return solid, np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist()


def _joined(lines, quotes, is_open) -> tuple[list[tuple[int, int]], int | None]:
    """Records of several lines as (first, last) line, -1 for one begun before, and the first line of one left open."""
    spans, first = [], -1 if is_open else None
    for at in quotes:
        line = lines[at].as_py()
        if first is None:
            if open_after(line, False):
                first = at
        elif not open_after(line, True):
            spans.append((first, at))
            first = None
    return spans, first


def _begins(solid, spans, left):
    """Where records begin: lines that are not blank and not inside a record."""
    begins = solid.copy()
    for first, last in spans:
        begins[first + 1 : last + 1] = False
    if left is not None:
        begins[left + 1 :] = False
    return begins


class _Measure:
    def __init__(self, key):
        self.key = key
        self.open, self.open_if = False, True
        self.records = self.records_if = 0
        self.most_cells = 0
        self.head: list[str] | None = []
        self.head_size, self.in_head, self.complete = 0, True, True

    def add(self, lines, quoted):
        import pyarrow.compute as pc

        solid, quotes = _shape(lines, quoted)
        spans, left = _joined(lines, quotes, self.open)
        begins = _begins(solid, spans, left)
        self.records += int(begins.sum())
        if spans or left is not None:
            self.most_cells = MANY_CELLS
        else:
            self.most_cells = max(self.most_cells, pc.max(pc.count_substring(lines, ",")).as_py() + 1)
        if not quoted:
            return
        if self.open_if != self.open:
            spans_if, left_if = _joined(lines, quotes, self.open_if)
            begins = _begins(solid, spans_if, left_if)
        else:
            spans_if, left_if = spans, left
        self.records_if += int(begins.sum())
        if self.in_head:
            closed = spans_if[0][1] if spans_if and spans_if[0][0] == -1 else None
            self._add_head(lines if closed is None else lines.slice(0, closed + 1))
            self.in_head = closed is None
        self.open, self.open_if = left is not None, left_if is not None

    def _add_head(self, lines):
        import pyarrow.compute as pc

        self.head_size += pc.sum(pc.binary_length(lines)).as_py() or 0
        if self.head is None or self.head_size > HEAD_CHARACTERS:
            self.head = None
        else:
            self.head += lines.to_pylist()

    def has_more_than(self, enough, quoted):
        """Whether more records start in the split, however it starts; the first split of a file starts between records."""
        return self.records > enough and (not quoted or self.key[1] == 0 or self.records_if > enough)

    def row(self):
        # A header is no record.
        header = self.key[1] == 0 and self.records > 0
        head = None if self.head is None else "\n".join(self.head)
        return (*self.key, self.open, self.open_if, self.records - header, self.records_if, self.most_cells, head, self.complete)


def _measured(pieces, quoted, enough=None):
    """One row per split; with ``enough`` of a split only as far as more records than that have begun."""
    import pyarrow as pa

    schema = pa.schema([
        ("split_path", pa.string()), ("split_start", pa.int64()), ("split_length", pa.int64()),
        ("ends_open", pa.bool_()), ("ends_open_if_open", pa.bool_()), ("records", pa.int64()),
        ("records_if_open", pa.int64()), ("most_cells", pa.int64()), ("head", pa.string()), ("complete", pa.bool_()),
    ])

    def row(measure):
        columns = [pa.array([value], field.type) for value, field in zip(measure.row(), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    now = None
    for key, lines in pieces:
        if now is None or now.key != key:
            if now is not None:
                yield row(now)
            now = _Measure(key)
        now.add(lines, quoted)
        if enough is not None and now.has_more_than(enough, quoted):
            now.complete = False
            break
    if now is not None:
        yield row(now)


class _Reader:
    """Turns the lines of one split into records."""

    def __init__(self, key, start, layout):
        self.key, self.layout, self.start = key, layout, start
        self.pos = start.pos
        self.skipping = start.inside
        self.header = key[1] == 0
        self.pending: list[str] | None = None

    def add(self, lines):
        """The records that are complete after these lines."""
        import pyarrow as pa

        solid, quotes = _shape(lines, self.layout.quoted)
        spans, left = _joined(lines, quotes, self.skipping or self.pending is not None)
        begins = _begins(solid, spans, left)
        out = []
        if spans and spans[0][0] == -1:
            last = spans.pop(0)[1]
            if not self.skipping:
                out.append("\n".join([*self.pending, *lines.slice(0, last + 1).to_pylist()]))
            self.skipping, self.pending = False, None
        elif left == -1:
            if not self.skipping:
                self.pending += lines.to_pylist()
            return out
        places = begins.nonzero()[0].tolist()
        texts = dict(zip(places, lines.filter(pa.array(begins)).to_pylist()))
        for first, last in spans:
            texts[first] = "\n".join(lines.slice(first, last - first + 1).to_pylist())
        if left is not None:
            texts.pop(left)
            self.pending = lines.slice(left).to_pylist()
        out += texts.values()
        return out

    def rest(self):
        """The record that goes on behind the split."""
        if self.pending is None:
            return []
        parts = self.pending if self.start.tail is None else [*self.pending, self.start.tail]
        self.pending = None
        return ["\n".join(parts)]

    def placed(self, texts):
        """A batch of records with their positions, those behind the end left out."""
        import numpy as np
        import pyarrow as pa

        if self.header and texts:
            texts, self.header = texts[1:], False
        if self.layout.strip_cr:
            texts = [text.removesuffix("\r") for text in texts]
        pos = np.arange(self.pos, self.pos + len(texts))
        self.pos += len(texts)
        if self.layout.end is not None:
            kept = int((pos < self.layout.end).sum())
            pos, texts = pos[:kept], texts[:kept]
        n = len(texts)
        path, begin, length = self.key
        columns = [
            pa.array(pos, pa.int64()),
            pa.array(texts, pa.string()),
            pa.array(map(cell_count, texts), pa.int64()),
            pa.repeat(pa.scalar(path, pa.string()), n),
            pa.repeat(pa.scalar(begin, pa.int64()), n),
            pa.repeat(pa.scalar(length, pa.int64()), n),
        ]
        return pa.RecordBatch.from_arrays(columns, ["pos", "line", "cells", "split_path", "split_start", "split_length"])

    def done(self):
        return self.layout.end is not None and self.pos >= self.layout.end


def _read(pieces, layout):
    now = None
    for key, lines in pieces:
        if now is None or now.key != key:
            if now is not None:
                yield now.placed(now.rest())
            now = _Reader(key, layout.starts.get((decode_listed(key[0]), key[1]), Start()), layout)
        if now.done():
            return
        yield now.placed(now.add(lines))
    if now is not None:
        yield now.placed(now.rest())
