"""Cell text: trimming, number validation, quote removal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six characters a cell is trimmed of, and the shape of a valid number.
TRIMMED = " \t\n\r\x0b\x00"
MSISDN_SHAPE = r"^255[0-9]{9}\z"


def clean_msisdn(cell: Column) -> Column:
    """Missing becomes the empty string, then trim. Unicode blanks are not trimmed."""
    return F.btrim(F.coalesce(cell, F.lit("")), F.lit(TRIMMED))


def is_msisdn(cleaned: Column) -> Column:
    """Country code 255 and nine ASCII digits. ``\\z`` because ``$`` lets a line end pass."""
    return cleaned.rlike(MSISDN_SHAPE)


def strip_quotes(line: Column) -> Column:
    return F.replace(line, F.lit('"'), F.lit(""))
