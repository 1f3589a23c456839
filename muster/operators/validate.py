"""Cleaning, validating and segmenting subscriber rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import clean_msisdn, is_msisdn, numeric_value

# Fixed value: the age from which the older message is used.
AGE_LIMIT = 35
OLDER = "o35"
YOUNGER = "u35"
BAD_MSISDN = "invalid_msisdn"


def flag_rows(rows: DataFrame, cell: str = "msisdn_raw") -> DataFrame:
    """Add ``msisdn`` (cleaned) and ``is_valid``."""
    cleaned = rows.withColumn("msisdn", clean_msisdn(F.col(cell)))
    return cleaned.withColumn("is_valid", is_msisdn(F.col("msisdn")))


def valid_rows(rows: DataFrame, cell: str = "msisdn_raw") -> DataFrame:
    return flag_rows(rows, cell).filter("is_valid").drop("is_valid")


def rejected_rows(rows: DataFrame, cell: str = "msisdn_raw") -> DataFrame:
    """Rows that take no position, with the cleaned value and a reason."""
    return flag_rows(rows, cell).filter(~F.col("is_valid")).drop("is_valid").withColumn("reason", F.lit(BAD_MSISDN))


def validity_counts(rows: DataFrame, file: str = "file_name", cell: str = "msisdn_raw") -> DataFrame:
    """Rows read, valid and rejected per file."""
    counts = (
        flag_rows(rows, cell).groupBy(file).agg(F.count("*").alias("read"), F.count_if("is_valid").alias("valid"))
    )
    return counts.withColumn("rejected", F.col("read") - F.col("valid"))


def age_segment(age_cell: Column) -> Column:
    """``o35`` for a numeric age of 35 or more, ``u35`` for anything else, null included."""
    return F.when(numeric_value(age_cell) >= AGE_LIMIT, F.lit(OLDER)).otherwise(F.lit(YOUNGER))


def segment_message(age_cell: Column, older: str, younger: str) -> Column:
    return F.when(age_segment(age_cell) == OLDER, F.lit(older)).otherwise(F.lit(younger))
