"""Binding files to types, messages and campaigns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
SALTS = 64
# What a row and a value take in a hash table beside their own bytes.
ROW_BYTES, VALUE_BYTES = 64, 16


def message_table(spark: SparkSession, messages: Mapping[str, str]) -> DataFrame:
    """The type to message map as a table; at most one message per type."""
    return spark.createDataFrame(list(messages.items()), "file_type string, message string")


def table_bytes(table: DataFrame) -> int:
    """About the memory a table takes when it is broadcast, measured on all its rows."""
    value = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in table.columns]
    row = sum(value, F.lit(ROW_BYTES + VALUE_BYTES * len(table.columns)))
    return table.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    known_bytes: int | None = None,
) -> DataFrame:
    """Equi-join of rows with a lookup table, safe for a hot key.

    The table is measured, unless the caller knows its size as ``known_bytes``,
    and broadcast when it is within the bound. Beyond it, rows of one key are
    spread over ``SALTS`` groups and the table is repeated for each, so that a
    file holding a third of all rows still meets its entry on many tasks. The
    salt is made of the row and its partition: equal rows of several partitions
    have several, and a task that runs again deals out the same ones.
    ``how`` is inner, left, left_semi or left_anti.
    """
    if (table_bytes(table) if known_bytes is None else known_bytes) <= broadcast_bytes:
        return rows.join(F.broadcast(table), on, how)
    salted = rows.withColumn("_salt", row_salt(rows))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")


def row_salt(rows: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*rows.columns) + F.spark_partition_id(), F.lit(SALTS)).cast("int")


def bind_messages(rows: DataFrame, messages: Mapping[str, str]) -> DataFrame:
    """Add ``message`` by ``file_type``; rows of other types are left out."""
    return attach(rows, message_table(rows.sparkSession, messages), "file_type", known_bytes=_message_bytes(messages))


def known_types(rows: DataFrame, messages: Mapping[str, str], known: bool = True) -> DataFrame:
    """Rows whose type is in the map, or with ``known=False`` the others, null type included."""
    table = message_table(rows.sparkSession, messages).select("file_type")
    return attach(rows, table, "file_type", "left_semi" if known else "left_anti", known_bytes=_message_bytes(messages))


def bind_campaigns(rows: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Add ``campaign``, ``message`` and ``sender`` by ``file_name``. A file in two campaigns runs twice."""
    return attach(rows, campaigns, "file_name")


def _message_bytes(messages: Mapping[str, str]) -> int:
    return sum(len(kind.encode()) + len(text.encode()) + ROW_BYTES + 2 * VALUE_BYTES for kind, text in messages.items())
