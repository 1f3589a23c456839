"""Loading a list into the campaign table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import clean_msisdn

# Fixed value: the status of a row that was only loaded.
LOADED = "0"


def nonempty_rows(rows: DataFrame, cell: str) -> DataFrame:
    """The load's only check: the trimmed first cell is not empty. Numbers are not validated."""
    return rows.withColumn("msisdn", clean_msisdn(F.col(cell))).filter(F.col("msisdn") != "")


def campaign_rows(rows: DataFrame, run_time: str, cell: str = "cell") -> DataFrame:
    """Rows of the campaign table. ``run_time`` is one local ``yyyy-MM-dd HH:mm:ss`` for the whole run."""
    return nonempty_rows(rows, cell).select(
        "msisdn",
        F.lit(LOADED).alias("status"),
        F.to_timestamp_ntz(F.lit(run_time)).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
    )


def rejected_rows(rows: DataFrame, run_time: str, cell: str = "cell") -> DataFrame:
    """The rows that a load passes over, as they stand in the list: ``cell``, ``reason``, ``created_at``."""
    return rows.filter(F.coalesce(clean_msisdn(F.col(cell)), F.lit("")) == "").select(
        F.coalesce(F.col(cell), F.lit("")).alias("cell"),
        F.lit("empty").alias("reason"),
        F.to_timestamp_ntz(F.lit(run_time)).alias("created_at"),
    )
