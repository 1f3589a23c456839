"""Row-range slices of lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from muster.functions import plain_path
from muster.operators.position import count_splits, file_starts, number_by_split
from muster.sources import records
from muster.sources.headers import KEY_COLUMN, probe_files
from muster.sources.lists import parsed, scan_columns
from muster.sources.remote import can_open

# Rows passed over and rows kept when nothing else is asked for.
START = 28_001
LIMIT = 2_800_000


# Files are counted in groups that grow, until the range is covered.
FIRST_GROUP_BYTES = 256 << 20


# A file larger than its group is counted split by split; it has at most so many.
SPLITS_PER_FILE = 1_000


@dataclass(frozen=True)
class _Run:
    """Files of the range that follow one another, or one large file with the byte ranges of it that are wanted."""

    layouts: list
    base: int
    splits: DataFrame | None = None
    ranges: list[tuple[int, int]] | None = None
    reading: records.Layout | None = None
    width: int = 0


def slice_list(
    spark: SparkSession,
    paths: Sequence[str],
    start: int = START,
    limit: int = LIMIT,
    multi_line: bool = False,
    group_bytes: int = FIRST_GROUP_BYTES,
) -> DataFrame:
    """All cells of data rows ``start`` to ``start + limit - 1``, counted from 0 over the files in order.

    Rows are not validated. The columns are those of the first file, which must
    have the key column; a file with the same columns in another order is put in
    the first one's order, any other header is an error. Cells beyond the header
    are kept in columns named ``_c<number>``. ``pos`` is kept beside the columns,
    as rows come back in no particular order (``writers.write_csv_in_order`` writes them in order).

    Only what is needed is read. Files are counted in groups that grow until the range is covered. A file that is larger than
    its group is counted by byte ranges, some more in each step and none further than the end of the slice, and of these
    only those in the slice are read again. (That takes a file that tasks can open; a store that only Spark's readers
    reach is counted by whole files.)
    """
    first = F.col("file_ordinal") == 1
    probed = probe_files(spark, paths, optional=()).filter(first | (F.col("size_bytes") > 0))
    files = probed.select("file_ordinal", "file_path", "file_name", "status", "crlf", "size_bytes", "header")
    files = files.orderBy("file_ordinal").collect()
    head = files[0]
    if KEY_COLUMN not in (head.header or ()):
        raise ValueError(f"no {KEY_COLUMN} column: {head.status}")
    waiting = [(row, _places(head, row)) for row in files]
    end, own = start + limit, len(head.header)
    runs, rows_so_far, bytes_counted = [], 0, 0
    while waiting and rows_so_far < end:
        most = max(group_bytes, 2 * bytes_counted)
        group = _next_group(waiting, most)
        waiting = waiting[len(group) :]
        bytes_counted += sum(row.size_bytes for row, _ in group)
        if len(group) == 1 and group[0][0].size_bytes > most and can_open(group[0][0].file_path):
            run, rows = _count_large(spark, group[0], rows_so_far, start, end, own, multi_line)
        else:
            run, rows = _count_group(spark, group, rows_so_far, start, end, own, multi_line)
        runs += [run] if run else []
        rows_so_far += rows
    width = max([own, *(run.width for run in runs)])
    names = _distinct_names([*head.header, *("" for _ in range(width - own))])
    if not runs:
        return spark.createDataFrame([], ", ".join(["pos long", *(f"`{name.replace('`', '``')}` string" for name in names)]))
    read = [_read_run(spark, run, width, start, end, own, multi_line) for run in runs]
    cells = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    return reduce(DataFrame.unionByName, read).select("pos", *cells)


def _count_group(spark, group, before, start, end, own, multi_line):
    """Counts whole files; the files of the range, and the rows of all."""
    scan = scan_columns(spark, group, own, multi_line)
    splits = count_splits(scan.rows, F.max("cells").alias("cells"), F.max(F.length("c0")).alias("longest"))
    sizes = file_starts(splits, scan.files).select("file_ordinal", "file_start", "file_rows").collect()
    hit = [r for r in sizes if _overlap(r, before, start, end)]
    ordinals = {r.file_ordinal for r in hit}
    layouts = [layout for layout in group if layout[0].file_ordinal in ordinals]
    width = max(own, splits.agg(F.max("cells")).first()[0] or 0)
    rows = sum(r.file_rows for r in sizes)
    if not hit:
        return None, rows
    if len(layouts) == len(group) and width == own:
        return _Run(layouts, before, splits, width=width), rows
    return _Run(layouts, before + min(r.file_start for r in hit), width=width), rows


def _count_large(spark, layout, before, start, end, own, multi_line):
    """Counts byte ranges of a large file, some more in each step, until the rows wanted are covered."""
    row = layout[0]
    length = records.split_bytes_for(spark, row.size_bytes, SPLITS_PER_FILE)
    while True:
        ranges = records.byte_ranges(row.size_bytes, length)
        found = _measured_until(spark, row.file_path, ranges, multi_line, end - before)
        inside = records.inside_splits(found)
        counted = {(r["path"], r["split_start"]): r for r in found}
        heads = {key: (counted[key]["head"], counted[key]["ends_open_if_open"]) for key, is_inside in inside.items() if is_inside}
        if all(text is not None for text, _ in heads.values()):
            break
        length *= 8
    pos, rows = {}, 0
    for key, is_inside in inside.items():
        pos[key] = before + rows
        rows += counted[key]["records_if_open" if is_inside else "records"]
    starts = records.starts_of(inside, heads, pos)
    ends = dict(zip(pos, [*list(pos.values())[1:], before + rows]))
    hit = {key: at for key, at in starts.items() if at.pos < end and ends[key] > start}
    if not hit:
        return None, rows
    reading = records.Layout(hit, multi_line, end, bool(row.crlf))
    run = _Run([layout], before, ranges=[(key[1], counted[key]["split_length"]) for key in hit], reading=reading)
    if max(counted[key]["most_cells"] for key in hit) > own:
        # The counts are of whole splits and of commas; how many cells the rows of the range have is told by these rows.
        most = _large_rows(spark, run, start).agg(F.max("cells")).first()[0] or 0
        run = replace(run, width=most)
    return run, rows


def _measured_until(spark, path, ranges, multi_line, wanted):
    """Measures of the first ranges of a file, up to where a record behind the wanted ones begins."""
    found, done, asked, rows = [], 0, 1, 0
    while done < len(ranges) and rows <= wanted and all(r["complete"] for r in found):
        step = ranges[done : done + asked]
        done += len(step)
        for r in records.measure_ranges(spark, path, step, multi_line, wanted + 1):
            found.append(Row(path=path, **{name: value for name, value in r.asDict().items() if name != "split_path"}))
        rows = sum(
            r["records_if_open" if is_inside else "records"] for r, is_inside in zip(found, records.inside_splits(found).values())
        )
        asked = min(max((wanted - rows) * done // max(rows, 1) + 2, 1), 4 * done)
    return found


def _large_rows(spark, run, start):
    return records.read_ranges(spark, run.layouts[0][0].file_path, run.ranges, run.reading).filter(F.col("pos") >= start)


def _read_run(spark, run, width, start, end, own, multi_line):
    """The rows of the range as ``pos`` and ``c0`` to ``c<width - 1>``, in the order of the first file's columns."""
    if run.ranges:
        rows = _large_rows(spark, run, start).withColumn("_cells", parsed(F.col("line"), width))
        places = [*run.layouts[0][1], *range(own, width)]
        return rows.select("pos", *[F.col("_cells")[f"c{place}"].alias(f"c{i}") for i, place in enumerate(places)])
    splits = run.splits if width == own else None
    scan = scan_columns(spark, run.layouts, width, multi_line)
    # A carriage return at the end of a line stays in its last cell, whichever column that is put in.
    crlf = [(row.file_ordinal, places.index(own - 1)) for row, places in run.layouts if row.crlf]
    files = scan.files
    if crlf:
        ends = spark.createDataFrame(crlf, "file_ordinal long, _crlf int")
        files = files.join(ends, "file_ordinal", "left")
    else:
        files = files.withColumn("_crlf", F.lit(None).cast("int"))
    numbered = number_by_split(scan.rows, scan.files, splits, bound=files.select("file_ordinal", "_crlf"))
    numbered = numbered.withColumn("pos", F.col("list_pos") + run.base)
    kept = numbered.filter((F.col("pos") >= start) & (F.col("pos") < end))

    def cell(i):
        if not crlf:
            return F.col(f"c{i}")
        bare = F.regexp_replace(f"c{i}", r"\r\z", "")
        here = F.col("_crlf").isNotNull() if i >= own else F.col("_crlf") == i
        return F.when(here, bare).otherwise(F.col(f"c{i}"))

    return kept.select("pos", *[cell(i).alias(f"c{i}") for i in range(width)])


def _places(head, row):
    """Where the first file's columns stand in a file."""
    if row.header == head.header:
        return list(range(len(head.header)))
    if sorted(row.header) != sorted(head.header) or len(set(row.header)) < len(row.header):
        raise ValueError(f"{row.file_name} has other columns than {head.file_name}")
    return [row.header.index(name) for name in head.header]


def _next_group(layouts, most_bytes):
    group, size = [], 0
    for layout in layouts:
        if group and size + layout[0].size_bytes > most_bytes:
            break
        group.append(layout)
        size += layout[0].size_bytes
    return group


def _overlap(row, before, start, end):
    return before + row.file_start < end and before + row.file_start + row.file_rows > start


def _distinct_names(header):
    """A name met again gets its column number; Spark writes no table with a name twice."""
    seen: set[str] = {"pos"}
    names = []
    for i, name in enumerate(header):
        name = name or f"_c{i}"
        if name.lower() in seen:
            name = f"{name}_{i}"
        seen.add(name.lower())
        names.append(name)
    return names
