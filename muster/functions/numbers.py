"""Numeric strings and whole-number division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a numeric string. A cast alone is too wide, as it
# takes "40d", "NaN" and "Infinity".
NUMERIC_SHAPE = r"^[ \t\n\r\x0B\f]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\x0B\f]*\z"


def is_numeric_string(cell: Column) -> Column:
    return F.coalesce(cell.rlike(NUMERIC_SHAPE), F.lit(False))


def numeric_value(cell: Column) -> Column:
    """The number in a numeric string, null for any other text."""
    return F.when(cell.rlike(NUMERIC_SHAPE), F.btrim(cell, F.lit(" \t\n\r\x0b\x0c")).try_cast("double"))


def whole_div(number: Column, by: int | Column) -> Column:
    """Integer division without a detour over doubles."""
    return F.call_function("div", number, by if isinstance(by, Column) else F.lit(by).cast("long"))
