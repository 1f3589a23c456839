"""Subscriber lists: discovery, scans and the file-status report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from muster.functions import file_type, has_csv_extension, plain_path
from muster.functions.names import TYPE_MARKERS
from muster.session import pin_split_size
from muster.sources import records
from muster.sources.headers import AGE_COLUMN, KEY_COLUMN, OK, UNSUPPORTED, file_list, probe_files
from muster.sources.remote import as_literal, decode_listed, home_folder, is_directly_in, qualify

# The pattern keeps the listing out of subfolders. A subfolder whose name matches is listed and left out
# afterwards; without recursive lookup it would be taken for a partition of a table.
CSV_PATTERN = "*.[cC][sS][vV]"
FOLDER_OPTIONS = {"recursiveFileLookup": "true"}
SPLIT_COLUMNS = ("split_path", "split_start", "split_length")
KNOWN_TYPES = tuple(label for label, _ in TYPE_MARKERS)
# Holds a whole row where its cells are more or fewer than the columns read.
RAW = "_raw_row"


@dataclass(frozen=True)
class ListScan:
    """Rows of several list files with the split each row came from.

    ``rows`` has the wanted columns, the split columns and nothing else; what is
    known per file (``file_ordinal``, ``file_path``, ``file_name``) is in
    ``files`` and meets the rows by way of the table of splits when they are
    numbered.
    """

    rows: DataFrame
    files: DataFrame


def csv_reader(spark: SparkSession):
    """Reader for list files: header skipped, doubled quotes, lines end at ``\n`` only."""
    return spark.read.option("header", True).option("escape", '"').option("enforceSchema", True).option("lineSep", "\n")


def list_csv_files(spark: SparkSession, folder: str) -> list[str]:
    """Full paths of the CSV files in a folder, in byte order, empty files included.

    Names only: no file is opened. What lies in subfolders is left out, and a
    folder that does not exist has no files.
    """
    home = qualify(folder, home_folder(spark))
    reader = spark.read.format("binaryFile").options(**FOLDER_OPTIONS)
    try:
        found = reader.load(csv_pattern(home)).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    paths = (decode_listed(uri) for uri in found)
    return sorted((path for path in paths if is_directly_in(path, home)), key=str.encode)


def csv_pattern(folder: str) -> str:
    return f"{as_literal(folder.rstrip('/'))}/{CSV_PATTERN}"


def discover_files(spark: SparkSession, folder: str, types: Sequence[str] = KNOWN_TYPES) -> DataFrame:
    """CSV files of a folder whose name tells a known type, sorted and numbered."""
    listed = file_list(spark, list_csv_files(spark, folder)).drop("file_ordinal")
    typed = listed.filter(has_csv_extension(F.col("file_path"))).withColumn("file_type", file_type(F.col("file_path")))
    kept = typed.filter(F.col("file_type").isin(list(types)))
    # The listing is on the driver already, so numbering it is no bottleneck.
    paths = [row.file_path for row in kept.orderBy("file_path").select("file_path").collect()]
    return file_list(spark, paths).withColumn("file_type", file_type(F.col("file_path")))


def probe_lists(
    spark: SparkSession, paths: Sequence[str], key: str = KEY_COLUMN, optional: Sequence[str] = (AGE_COLUMN,)
) -> list[Row]:
    """State and column places of the wanted files, one row a file, to be used for a scan and its report alike."""
    names = [f"{name.lower()}_index" for name in optional]
    probed = probe_files(spark, paths, key, optional)
    return (
        probed.select("file_ordinal", "file_path", "file_name", "status", "size_bytes", "key_index", *names)
        .orderBy("file_ordinal")
        .collect()
    )


def file_status(
    spark: SparkSession,
    paths: Sequence[str],
    by_type: bool = False,
    types: Sequence[str] = KNOWN_TYPES,
    probed: Sequence[Row] | None = None,
) -> DataFrame:
    """One row per wanted file: read, or the reason why it is passed over.

    ``probed`` is what a scan of these files was made from, so that the report
    says what that scan did.
    """
    rows = probe_lists(spark, paths) if probed is None else probed
    states = spark.createDataFrame(
        [(r.file_ordinal, r.file_path, r.file_name, r.status) for r in rows],
        "file_ordinal long, file_path string, file_name string, status string",
    )
    if not by_type:
        return states
    known = F.coalesce(file_type(F.col("file_path")).isin(list(types)), F.lit(False))
    return states.withColumn("status", F.when(known, F.col("status")).otherwise(F.lit(UNSUPPORTED)))


def scan_lists(
    spark: SparkSession,
    paths: Sequence[str],
    key: str = KEY_COLUMN,
    optional: Sequence[str] = (AGE_COLUMN,),
    multi_line: bool = False,
    probed: Sequence[Row] | None = None,
) -> ListScan:
    """Read the key and optional columns of many lists, each by its own header.

    Files that are missing, unopenable, empty or without the key column are
    passed over. Columns come out as ``<name>_raw`` strings, null when absent.
    With ``multi_line`` a quoted cell may hold line ends; the splits of such files are
    read twice (see ``records``). ``probed`` is an earlier ``probe_lists`` of the same files.

    Files are grouped by the positions of the wanted columns and each group is
    one positional scan, so the number of scans follows the few places a column
    can stand in, not the number of files or of different headers.
    """
    pin_split_size(spark)
    names = [name.lower() for name in optional]
    index_columns = ["key_index"] + [f"{name}_index" for name in names]
    probed = probe_lists(spark, paths, key, optional) if probed is None else probed
    good = [row for row in probed if row.status == OK]
    columns = [f"{key.lower()}_raw"] + [f"{name}_raw" for name in names]
    groups: dict[tuple, dict[str, None]] = {}
    for row in good:
        groups.setdefault(tuple(row[c] for c in index_columns), {})[row.file_path] = None
    quoted = _quoted(spark, good) if multi_line else None
    scans = [
        _positional_scan(spark, list(group), dict(zip(columns, places)), quoted)
        for places, group in groups.items()
    ]
    rows = reduce(DataFrame.unionByName, scans) if scans else _no_rows(spark, columns)
    return ListScan(rows, _file_table(spark, good))


def scan_columns(
    spark: SparkSession, layouts: Sequence[tuple[Row, Sequence[int]]], width: int, multi_line: bool = False
) -> ListScan:
    """Cells of probed files as ``c0``, ``c1`` and so on, each file with the places of these columns in it.

    Cells beyond a file's own places follow up to ``width``. ``cells`` is the
    number of cells where a row has another number of them than is read, else
    null; Spark reads it only together with another cell.
    """
    pin_split_size(spark)
    groups: dict[tuple, dict[str, None]] = {}
    for row, places in layouts:
        beyond = range(len(places), width)
        groups.setdefault((*places, *beyond), {})[row.file_path] = None
    names = [f"c{i}" for i in range(width)]
    quoted = _quoted(spark, [row for row, _ in layouts]) if multi_line else None
    scans = [
        _positional_scan(spark, list(group), dict(zip(names, places)), quoted, odd="cells")
        for places, group in groups.items()
    ]
    rows = reduce(DataFrame.unionByName, scans) if scans else _no_rows(spark, names).withColumn("cells", F.lit(None).cast("int"))
    return ListScan(rows, _file_table(spark, [row for row, _ in layouts]))


def named_paths(paths: str | Sequence[str], patterns: bool) -> list[str]:
    """Paths for a reader: taken as they are unless they are said to be patterns."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    return listed if patterns else [as_literal(path) for path in listed]


def scan_first_column(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False, patterns: bool = False
) -> DataFrame:
    """Column 0 of every row after the header line, whatever the header says."""
    named = named_paths(paths, patterns)
    if not multi_line:
        return csv_reader(spark).schema("cell string").csv(named)
    # Only what the listing tells is used; no file is opened.
    listed = spark.read.format("binaryFile").load(named).select(plain_path(F.col("path")).alias("path"), "length").collect()
    session, layout = records.quoted_layout(spark, {row["path"]: row["length"] for row in listed})
    if not listed:
        return spark.createDataFrame([], "cell string")
    rows = records.read_records(records.line_scan(session, [row["path"] for row in listed]), layout)
    return rows.select(parsed(F.col("line"), 1)["c0"].alias("cell"))


def parsed(line: Column, width: int) -> Column:
    """The first cells of a record as a struct of ``c0``, ``c1`` and so on, as the reader of files would give them."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    return F.from_csv(line, schema, {"escape": '"', "multiLine": "true", "lineSep": "\n"})


def _quoted(spark, probed):
    return records.quoted_layout(spark, {row.file_path: row.size_bytes for row in probed if row.size_bytes})


def _no_rows(spark, columns):
    layout = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([], f"{layout}, split_path string, split_start long, split_length long")


def _file_table(spark, probed):
    rows = [(r.file_ordinal, r.file_path, r.file_name) for r in probed]
    return spark.createDataFrame(rows, "file_ordinal long, file_path string, file_name string")


def _positional_scan(spark, paths, places, quoted=None, odd=None):
    width = max(place for place in places.values() if place is not None) + 1
    if quoted:
        session, layout = quoted
        table = records.read_records(records.line_scan(session, paths), layout)
        table = table.withColumn("_cells", parsed(F.col("line"), width)).select("_cells.*", "cells", *SPLIT_COLUMNS)
    else:
        schema = ", ".join(f"c{i} string" for i in range(width))
        reader = csv_reader(spark)
        if odd:
            schema += f", {RAW} string"
            # With some columns only, the reader would not see how many cells a row has.
            reader = reader.option("columnNameOfCorruptRecord", RAW).option("columnPruning", False)
        table = reader.schema(schema).csv([as_literal(path) for path in paths])
    wanted = [
        (F.lit(None).cast("string") if place is None else F.col(f"c{place}")).alias(name)
        for name, place in places.items()
    ]
    if odd and quoted:
        wanted.append(F.col("cells").cast("int").alias(odd))
    elif odd:
        bare = F.regexp_replace(RAW, '"(?:[^"]|"")*"', "")
        commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
        wanted.append((commas + 1).alias(odd))
    if quoted:
        return table.select(*wanted, *SPLIT_COLUMNS)
    return table.select(
        *wanted,
        F.input_file_name().alias("split_path"),
        F.input_file_block_start().alias("split_start"),
        F.input_file_block_length().alias("split_length"),
    )
