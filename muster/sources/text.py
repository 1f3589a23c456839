"""Raw text, one row per line. Only ``\\n`` ends a line, so ``\\r`` stays in the text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from muster.sources.lists import named_paths


def scan_text(spark: SparkSession, paths: str | Sequence[str], patterns: bool = False) -> DataFrame:
    """The lines of the named files or folders; names are patterns only if that is asked for."""
    lines = spark.read.option("lineSep", "\n").text(named_paths(paths, patterns))
    return lines.withColumnRenamed("value", "line")
