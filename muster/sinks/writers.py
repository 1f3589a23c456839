"""Sinks: CSV, text, table append, outbox. Spark writes a folder of part files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from muster.functions import plain_path, strip_quotes, whole_div
from muster.sources.headers import file_list
from muster.sources.lists import named_paths

# Rows of a part where a list is written in order.
ROWS_PER_PART = 1_000_000
# Names the folders of an outbox; its columns are all in the files.
LIST_ID = "list_id"
LOAD_ID = "load_id"


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """CSV with a header in every part, doubled quotes, and cells neither trimmed nor filled in.

    Returns the rows written, counted on the way, as do the other writers.
    """
    options = {
        "header": True,
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "lineSep": "\n",
    }
    return _counted(rows, lambda counted: counted.write.mode(mode).options(**options).csv(path))


def write_csv_in_order(
    rows: DataFrame, path: str, order: str = "pos", mode: str = "errorifexists", rows_per_part: int = ROWS_PER_PART
) -> int:
    """As ``write_csv``, in the order of a column of positions, which is left out: parts joined by name are in order.

    The positions are whole numbers with few gaps, so a row's part follows from its position alone: nothing is sampled or
    sorted as a whole, and each part is sorted by the task that writes it. The smallest and the largest position are
    looked up first, by a pass that reads this one column.
    """
    least, most = rows.agg(F.min(order), F.max(order)).first()
    if least is None:
        return write_csv(rows.drop(order), path, mode)
    parts = (most - least) // rows_per_part + 1
    place = whole_div(F.col(order) - F.lit(least).cast("long"), rows_per_part).cast("int")
    dealt = rows.repartitionById(parts, place) if parts > 1 else rows.coalesce(1)
    return write_csv(dealt.sortWithinPartitions(order).drop(order), path, mode)


def write_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> int:
    return _counted(lines, lambda counted: counted.write.mode(mode).option("lineSep", "\n").text(path))


def write_without_quotes(lines: DataFrame, path: str) -> int:
    """Text with every double quote removed. Quoted commas become cell borders, as asked for."""
    return write_text(lines.select(strip_quotes(F.col("line")).alias("line")), path)


def write_files_without_quotes(spark: SparkSession, paths: Sequence[str], out: str) -> int:
    """As ``write_without_quotes``, one output per input: a folder ``out/lines/list_id=N`` for each file.

    The parts of a folder joined by name are the lines in order. Each task writes the splits it reads, which a scan hands out in the
    order of their file, so nothing is shuffled or looked up: ``list_id`` is a hash of the path. ``out/inputs`` tells the ``list_id`` of
    each file in list order; a file named twice has one output.
    """
    files = file_list(spark, paths)
    files.withColumn(LIST_ID, F.xxhash64("file_path")).write.parquet(f"{out}/inputs")
    named = [row.file_path for row in files.select("file_path").distinct().collect()]
    lines = spark.read.option("lineSep", "\n").text(named_paths(named, False))
    numbered = lines.select(
        strip_quotes(F.col("value")).alias("line"),
        F.xxhash64(plain_path(F.input_file_name())).alias(LIST_ID),
        F.monotonically_increasing_id().alias("_id"),
    )
    placed = numbered.sortWithinPartitions(LIST_ID, "_id").select("line", LIST_ID)
    return _counted(placed, lambda counted: counted.write.option("lineSep", "\n").partitionBy(LIST_ID).text(f"{out}/lines"))


def append_load(rows: DataFrame, path: str, load_id: str) -> int:
    """Append to a parquet table under the name of the load; the same load again takes the place of its earlier try.

    So a load whose answer was lost can be run again. Other loads are left alone; nothing of a load is seen before all of it is.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id):
        raise ValueError(f"a load is named by letters, digits and _.-, not {load_id!r}")
    return _counted(rows, lambda counted: counted.write.mode("overwrite").parquet(f"{path}/{LOAD_ID}={load_id}"))


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """A table of named loads with ``load_id``, whose names stay as they are."""
    inside = spark.read.parquet(path).drop(LOAD_ID).schema
    return spark.read.schema(inside.add(LOAD_ID, "string")).parquet(path)


def append_table(rows: DataFrame, path: str) -> int:
    """Append to a parquet table."""
    return _counted(rows, lambda counted: counted.write.mode("append").parquet(path))


def append_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> int:
    """Append to a database table; the driver class and login come as options of the caller."""
    return _counted(
        rows,
        lambda counted: counted.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save(),
    )


def write_outbox(outbox: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Outbox table with one folder per list; chunks and batches are columns.

    The folder is named by a number, the list's ordinal or else a hash of its
    name: a name such as ``007`` would be read back as a number. A folder per
    chunk of some thousand rows would drown a large run in small files. Each
    task writes the lists it holds, so a large list is written by many tasks.
    """
    number = F.col("file_ordinal") if "file_ordinal" in outbox.columns else F.xxhash64("file_name")
    numbered = outbox.withColumn(LIST_ID, number)
    return _counted(numbered, lambda counted: counted.write.mode(mode).partitionBy(LIST_ID).parquet(path))


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(LIST_ID)


def _counted(rows, write):
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("written")))
    return seen.get["written"]
