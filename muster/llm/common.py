"""Small helpers that several corpus operators share."""

from __future__ import annotations

import string
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import muster
from muster.session import scratch_path

#: Fixed: the white space that words and line keys are cut at, U+0020 and U+0009 to U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship() -> None:
    """Give the session's Python workers this package, which need not be installed where they run."""
    context = SparkSession.active().sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(muster.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="muster-code-")) / "muster.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(package.rglob("*.py")):
            packed.write(module, f"muster/{module.relative_to(package)}")
    context.addPyFile(str(archive))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(column: Column) -> Column:
    """A-Z in lower case, all other letters as they are.

    ``lower`` is much faster than ``translate`` but folds other letters as well, so it serves texts that are
    ASCII throughout.
    """
    ascii_only = F.octet_length(column) == F.char_length(column)
    slow = F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(column)).otherwise(slow)


def digest(*columns: Column | str) -> tuple[Column, Column]:
    """Two 64-bit hashes of the columns; together they tell all rows of a corpus apart."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, and any executor can read it again."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def removed(*frames: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    spark = frames[0].sparkSession
    hadoop = spark._jsc.hadoopConfiguration()
    for frame in frames:
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def tasks_for(rows: int, rows_per_task: int) -> int:
    return max(1, -(-rows // rows_per_task))


def in_training(doc_id: Column | str) -> Column:
    """Three quarters of the documents; the rest, crc32(doc_id as text) mod 4 = 2, are held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column | str) -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
