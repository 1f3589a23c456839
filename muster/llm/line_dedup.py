"""Drop lines that many documents share.

Lines are exploded with their positions, their normalised keys hashed, and distinct documents counted per
hash; lines whose hash reaches the threshold go, the others are put together again in their order. Only
hashes and positions are shuffled for the count; whole texts move once, to meet the positions they lose.

Defined results: a null or empty text is one empty line. Keys shorter than ``min_chars`` are never dropped.
Documents are told apart by their id, and all rows without an id count as one document. Rows with equal id
and equal text are each kept and treated alike. An empty table gives an empty result. Any further columns,
whatever their names, come back inside ``document``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, digest, fold_ascii, written

MIN_DOCUMENTS = 10
MIN_CHARS = 1


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return fold_ascii(F.btrim(line, F.lit(ASCII_SPACE)))


def dedup_lines(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows ``document`` (the row as given), ``kept_text``, ``n_lines`` before dropping and ``n_dropped``."""
    row_1, row_2 = digest(id_column, text_column)
    lines = documents.select(
        F.col(id_column).alias("id"),
        row_1.alias("row_1"),
        row_2.alias("row_2"),
        F.posexplode(split_lines(F.col(text_column))).alias("position", "line"),
    ).withColumn("key", line_key(F.col("line")))
    key_1, key_2 = digest("key")
    hashed = written(
        lines.where(F.char_length("key") >= min_chars).select(
            "id", "row_1", "row_2", "position", key_1.alias("key_1"), key_2.alias("key_2")
        ),
        "lines",
    )
    # Written before it meets the lines: a table joined with an aggregate of its own key keeps that key's partitioning, so that
    # all lines of a hot key would stay on one task. This way they are dealt out anew, and the join is split where it is hot.
    shared = written(
        hashed.select("id", "key_1", "key_2")
        .distinct()
        .groupBy("key_1", "key_2")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_documents),
        "shared",
    )
    lost = (
        hashed.join(shared, ["key_1", "key_2"], "left_semi")
        .groupBy("row_1", "row_2")
        .agg(F.collect_set("position").alias("lost"))
    )
    whole = documents.select(F.struct("*").alias("document"), F.col(text_column).alias("text")).select(
        "document", "text", *(c.alias(n) for c, n in zip(digest(F.col(f"document.{id_column}"), "text"), ("row_1", "row_2")))
    )
    kept = F.when(F.col("lost").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(
            F.filter(split_lines(F.col("text")), lambda _, place: ~F.array_contains(F.col("lost"), place)), "\n"
        )
    )
    return whole.join(lost, ["row_1", "row_2"], "left").select(
        "document",
        kept.alias("kept_text"),
        F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
