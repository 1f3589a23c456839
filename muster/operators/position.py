"""Row positions: the place of a row among the rows of its file, counted from 0.

A plain ``row_number`` over a file puts the whole file on one task. Both forms
below cut a file into pieces, number rows inside a piece, and add the number of
rows in earlier pieces, which comes from a table with one small row per piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.functions import plain_path, whole_div
from muster.operators.lookup import BROADCAST_BYTES, attach
from muster.session import pin_split_size, scratch_path
from muster.sources.lists import SPLIT_COLUMNS

RANGES_PER_TASK = 4
PIECES_PER_GROUP = 512
# Bytes of a split's entry in memory: six numbers and what a hash table adds.
SPLIT_BYTES = 100


def number_by_key(
    rows: DataFrame, file: str = "file_name", key: str = "row_key", ranges: int | None = None
) -> DataFrame:
    """Add ``pos`` and ``file_rows`` from a whole-number order column.

    ``key`` is unique in its file. The keys of the table are cut into ``ranges`` of about as many
    rows each (by default a few per shuffle partition) at bounds taken from the
    data, so neither gaps in the keys nor a file with a third of all rows makes a
    large piece. The rows are shuffled once, by (file, range): the window and the
    join with the starts of the pieces share that partitioning.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_TASK
    wanted = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = rows.agg(F.percentile_approx(key, wanted, 20 * ranges)).first()[0]
    piece = _range_of(sorted(set(cuts or [])))
    pieces = rows.withColumn("_piece", piece(F.col(key).cast("long")))
    sizes = pieces.groupBy(file, "_piece").agg(F.count("*").alias("_size"))
    starts = _piece_starts(sizes, file)
    in_piece = Window.partitionBy(file, "_piece").orderBy(key)
    numbered = pieces.withColumn("_place", F.row_number().over(in_piece).cast("long") - 1)
    # A left join, so that a row without file or key fails the job and is not dropped.
    unplaced = F.raise_error(F.lit("a row has no file or no key")).cast("long")
    return (
        numbered.join(starts, [file, "_piece"], "left")
        .withColumn("pos", F.coalesce(F.col("_start") + F.col("_place"), unplaced))
        .drop("_piece", "_place", "_start")
    )


def _range_of(bounds: list[int]):
    """The number of a key's range, that is of bounds below the key, by halving steps; null for no key."""
    if not bounds:
        return lambda key: F.when(key.isNotNull(), F.lit(0))
    table = F.array(*[F.lit(bound).cast("long") for bound in bounds])
    steps = F.array(*[F.lit(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)])

    def place(key: Column) -> Column:
        # Behind the last bound nothing is found, which is not below any key.
        found = F.aggregate(
            steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(table, at + step - 1) < key, F.lit(False)), at + step).otherwise(at)
        )
        return F.when(key.isNotNull(), found)

    return place


def _piece_starts(sizes: DataFrame, file: str) -> DataFrame:
    """Rows of a file before each of its pieces, summed up in two levels so that no task holds all pieces of a file."""
    grouped = sizes.withColumn("_group", whole_div(F.col("_piece"), PIECES_PER_GROUP))
    groups = grouped.groupBy(file, "_group").agg(F.sum("_size").alias("_group_size"))
    in_file = Window.partitionBy(file)
    before_group = in_file.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        file,
        "_group",
        F.coalesce(F.sum("_group_size").over(before_group), F.lit(0)).alias("_group_start"),
        F.sum("_group_size").over(in_file).alias("file_rows"),
    )
    in_group = Window.partitionBy(file, "_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("_before", F.coalesce(F.sum("_size").over(in_group), F.lit(0)))
    return placed.join(groups, [file, "_group"]).select(
        file, "_piece", (F.col("_group_start") + F.col("_before")).alias("_start"), "file_rows"
    )


def count_splits(rows: DataFrame, *extra: Column) -> DataFrame:
    """First pass over a list scan: rows and first row id of every split, as a written table.

    The table has one small row per split and lies in the shared folder, so that
    several uses read it and not the lists again. ``extra`` are more aggregates.
    """
    spark = rows.sparkSession
    pin_split_size(spark)
    sizes = _tag(rows).groupBy("_split", *SPLIT_COLUMNS).agg(
        F.min("_id").alias("_first"), F.count("*").alias("_size"), *extra
    )
    path = scratch_path(spark, "splits")
    sizes.write.parquet(path)
    return spark.read.schema(sizes.schema).parquet(path)


def count_and_reject(flagged: DataFrame, cell: str = "msisdn_raw") -> tuple[DataFrame, DataFrame]:
    """First pass over a list scan that also keeps what it rejects: the splits, as ``count_splits`` has them for the valid
    rows, and the rejected cells as ``split_path`` and the cell.

    ``flagged`` has all rows of the scan with ``is_valid``. Grouped by split and, for a rejected row, by its own number and cell, the
    valid rows of a split become one row before anything is shuffled, and each rejected row stays one.
    """
    spark = flagged.sparkSession
    pin_split_size(spark)
    rejected = ~F.col("is_valid")
    keyed = _tag(flagged).select(
        "_split",
        *SPLIT_COLUMNS,
        "_id",
        F.when(rejected, F.col("_id")).alias("_reject"),
        F.when(rejected, F.coalesce(cell, F.lit(""))).alias(cell),
    )
    grouped = keyed.groupBy("_split", *SPLIT_COLUMNS, "_reject", cell).agg(F.min("_id").alias("_low"), F.count("*").alias("_rows"))
    path = scratch_path(spark, "counted")
    grouped.write.parquet(path)
    counted = spark.read.schema(grouped.schema).parquet(path)
    # Row ids count all rows of a task here and only the valid ones in the second pass.
    task = F.shiftright("_low", 33)
    order = Window.partitionBy("_task").orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counted.filter(F.col("_reject").isNull()).withColumn("_task", task)
    before = F.coalesce(F.sum("_rows").over(order), F.lit(0))
    splits = sizes.select("_split", *SPLIT_COLUMNS, (F.shiftleft("_task", 33) + before).alias("_first"), F.col("_rows").alias("_size"))
    return splits, counted.filter(F.col("_reject").isNotNull()).select("split_path", cell)


def file_starts(splits: DataFrame, files: DataFrame) -> DataFrame:
    """Files with their ``file_rows`` and ``file_start``, the rows in files of lower ordinal.

    A file listed twice counts twice; a file without rows is left out.
    """
    path = plain_path(F.col("split_path")).alias("file_path")
    totals = splits.groupBy(path).agg(F.sum("_size").alias("_size")).join(files, "file_path")
    everything = totals.select("*", F.col("file_ordinal").alias("_piece"), F.lit(0).alias("_all"))
    starts = _piece_starts(everything.select("_all", "_piece", "_size"), "_all")
    starts = starts.select(F.col("_piece").alias("file_ordinal"), F.col("_start").alias("file_start"))
    return totals.withColumnRenamed("_size", "file_rows").join(starts, "file_ordinal")


def number_by_split(
    rows: DataFrame,
    files: DataFrame,
    splits: DataFrame | None = None,
    bound: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add positions in physical row order to the rows of a list scan.

    ``rows`` comes from ``ListScan.rows`` by filters and projections that keep
    the split columns; positions count the rows it holds. ``files`` is the
    scan's own table of files; a file named twice in it is numbered twice. Added
    are ``file_ordinal``, ``file_path``, ``file_name``, ``pos``, ``file_rows``
    and ``list_pos``, the position over all files in ordinal order.

    ``bound`` has more to add per ``file_ordinal`` (type, message, sender): a
    file that is several times in it, as in several campaigns, is planned as
    often, and one that is not in it is left out.

    Rows are neither sorted nor shuffled: a row's number inside its split comes
    from the row id Spark hands out in reading order, the split's start from
    ``count_splits``, which runs here as a job of its own. Only numbers are kept
    per split; up to ``broadcast_bytes`` they are broadcast, beyond that the rows are
    shuffled to them by split, which no single file can unbalance. Names and
    messages meet the rows by ordinal, under the same bound. If the passes were ever
    cut into different splits, or a row comes from a file that is not in
    ``files``, the job fails rather than number rows wrongly or lose them.
    """
    splits = count_splits(rows) if splits is None else splits
    split_count, tags = splits.agg(F.count("*"), F.count_distinct("_split")).first()
    if tags != split_count:
        raise ValueError("two splits have the same tag")
    # One entry per split; a file's pieces are its splits.
    pieces = splits.select(
        "split_path", F.dense_rank().over(Window.partitionBy("split_path").orderBy("split_start")).alias("_piece"), "_split", "_first", "_size"
    )
    starts = pieces.join(_piece_starts(pieces.select("split_path", "_piece", "_size"), "split_path"), ["split_path", "_piece"])
    starts = starts.select("_split", "_first", "_start", plain_path(F.col("split_path")).alias("file_path"))
    known = file_starts(splits, files.select("file_ordinal", "file_path"))
    starts = starts.join(known, "file_path", "left").drop("file_path")
    # A file named several times repeats its splits.
    most = files.groupBy("file_path").count().agg(F.max("count")).first()[0] or 1
    if split_count * most * SPLIT_BYTES <= broadcast_bytes:
        starts = F.broadcast(starts)

    placed = _tag(rows).drop(*SPLIT_COLUMNS).join(starts, "_split", "left")
    changed = F.raise_error(F.lit("a split changed between two passes over the lists")).cast("long")
    unlisted = F.raise_error(F.lit("a row comes from a file that is not in the list of files")).cast("long")
    place = F.coalesce("_start", changed) + F.col("_id") - F.col("_first")
    numbered = (
        placed.withColumn("file_ordinal", F.when(F.col("_first").isNull(), changed).otherwise(F.coalesce("file_ordinal", unlisted)))
        .withColumn("pos", place)
        .withColumn("list_pos", F.col("file_start") + place)
        .drop("_split", "_id", "_first", "_start", "file_start")
    )
    about = files.select("file_ordinal", "file_path", "file_name")
    if bound is not None:
        more = [name for name in bound.columns if name not in about.columns]
        about = about.join(bound.select("file_ordinal", *more), "file_ordinal")
    return attach(numbered, about, "file_ordinal", broadcast_bytes=broadcast_bytes)


def _tag(rows: DataFrame) -> DataFrame:
    """Add the row id, and one number that stands for the split and the task it is read by."""
    tag = F.xxhash64(*SPLIT_COLUMNS, F.spark_partition_id())
    return rows.withColumn("_split", tag).withColumn("_id", F.monotonically_increasing_id())
