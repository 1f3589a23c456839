"""Header probe: one row per wanted file with its state and its column positions.

Only the head of every file is read, in tasks of a few hundred files each, so
the cost follows the number of files and not their size. A store that tasks have
no client for is read by Spark's own one, which only the driver can call: it reads the
same heads, many at a time, and never more of a file.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.functions import base_name
from muster.sources.remote import OPENED, home_folder, qualify, task_filesystem

KEY_COLUMN = "MSISDN"
AGE_COLUMN = "AGE"
FILES_PER_TASK = 256
# A header is one line; a file whose first line is longer is no list.
HEADER_BYTES = 1 << 20

# Heads that the driver reads at a time where tasks cannot.
HEADS_AT_A_TIME = 32
HEADS = "file_ordinal long, file_path string, file_name string, size_bytes long, state string, header array<string>, crlf boolean"
# How the file clients of Spark's readers say that a file is not there, or not for us.
NOT_FOUND = ("java.io.FileNotFoundException", "java.nio.file.NoSuchFileException", "org.apache.hadoop.fs.viewfs.NotInMountpointException")
REFUSED = ("org.apache.hadoop.security.AccessControlException", "java.nio.file.AccessDeniedException")

OK = "ok"
MISSING = "missing"
UNOPENABLE = "unopenable"
EMPTY = "empty"
NO_KEY = "no_key_column"
UNSUPPORTED = "unsupported_type"


def file_list(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The wanted files in list order: ``file_ordinal`` from 1, ``file_path``, ``file_name``."""
    home = home_folder(spark)
    rows = [(i, qualify(path, home)) for i, path in enumerate(paths, start=1)]
    listed = spark.createDataFrame(rows, "file_ordinal long, file_path string")
    return listed.withColumn("file_name", base_name(F.col("file_path")))


def probe_files(
    spark: SparkSession,
    paths: Sequence[str],
    key: str = KEY_COLUMN,
    optional: Iterable[str] = (AGE_COLUMN,),
) -> DataFrame:
    """State and column positions of every wanted file.

    Columns: ``file_ordinal``, ``file_path``, ``file_name``, ``size_bytes``,
    ``header`` (array of names, null when there is none), ``crlf``, ``status``,
    ``key_index`` and ``<name>_index`` for each optional column. Names match
    exactly; the first match counts; an absent column has a null index.

    A file is missing if it is not found and unopenable if it is no file or access
    to it is refused. Any other failure to read fails the task, which is tried
    again: a store that is slow or down must not take lists out of a plan.
    """
    files = file_list(spark, paths)
    opened = files.filter(_opened(F.col("file_path")))
    others = files.filter(~_opened(F.col("file_path"))).collect()
    tasks = -(-len(paths) // FILES_PER_TASK) or 1
    heads = opened.repartition(min(tasks, 10_000)).mapInPandas(_head_reader(), HEADS)
    if others:
        read = hadoop_heads(spark, [row.file_path for row in others])
        rows = [(*row, *head) for row, head in zip(others, read)]
        heads = heads.unionByName(spark.createDataFrame(rows, HEADS))
    header = F.col("header")
    found = heads.withColumn("key_index", _index_of(header, key))
    for name in optional:
        found = found.withColumn(f"{name.lower()}_index", _index_of(header, name))
    no_key = (F.col("state") == OK) & F.col("key_index").isNull()
    return found.withColumn("status", F.when(no_key, F.lit(NO_KEY)).otherwise(F.col("state"))).drop("state")


def _opened(path):
    return F.lower(F.substring_index(path, ":", 1)).isin(*OPENED)


def hadoop_heads(spark: SparkSession, paths: Sequence[str]) -> list[tuple]:
    """Size, state, header and kind of line end of each file, by the file client that Spark's readers use."""
    with ThreadPoolExecutor(HEADS_AT_A_TIME) as pool:
        return list(pool.map(lambda path: _hadoop_head(spark, path), paths))


def _hadoop_head(spark, path):
    jvm = spark._jvm
    name = jvm.org.apache.hadoop.fs.Path(path)
    try:
        system = name.getFileSystem(spark._jsc.hadoopConfiguration())
        found = system.getFileStatus(name)
        if not found.isFile():
            return None, UNOPENABLE, None, None
        if not found.getLen():
            return 0, EMPTY, None, None
        stream = system.open(name)
        try:
            text = jvm.org.apache.hadoop.io.Text()
            jvm.org.apache.hadoop.util.LineReader(stream, 65536, bytearray(b"\n")).readLine(text, HEADER_BYTES + 1, HEADER_BYTES + 1)
            line = bytes(text.getBytes())[: text.getLength()]
        finally:
            stream.close()
    except Py4JJavaError as error:
        kind = error.java_exception.getClass().getName()
        if kind in NOT_FOUND:
            return None, MISSING, None, None
        if kind in REFUSED:
            return None, UNOPENABLE, None, None
        raise
    if len(line) > HEADER_BYTES:
        raise ValueError(f"the first line of {path} has over {HEADER_BYTES} bytes")
    return found.getLen(), OK, *header_cells(line)


def header_cells(line: bytes) -> tuple[list[str], bool]:
    """The cells of a first line, and whether it ends in a carriage return."""
    import csv
    import sys

    csv.field_size_limit(sys.maxsize)
    text = line.removesuffix(b"\n").decode("utf-8-sig", errors="replace")
    return next(csv.reader([text.removesuffix("\r")]), []), text.endswith("\r")


def _index_of(header, name):
    place = F.array_position(header, F.lit(name))
    return F.when(place > 0, (place - 1).cast("int"))


def _head_reader():
    locate = task_filesystem()
    states = (OK, MISSING, UNOPENABLE, EMPTY)
    longest = HEADER_BYTES

    def head_of(path):
        import csv
        import io
        import sys

        from pyarrow import fs

        ok, missing, unopenable, empty = states
        filesystem, inner = locate(path)
        try:
            info = filesystem.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                return None, missing, None, None
            if info.type != fs.FileType.File:
                return None, unopenable, None, None
            if info.size == 0:
                return 0, empty, None, None
            with filesystem.open_input_stream(inner, compression=None) as stream:
                line = io.BufferedReader(stream, 65536).readline(longest + 1)
        except FileNotFoundError:
            return None, missing, None, None
        except PermissionError:
            return None, unopenable, None, None
        if len(line) > longest:
            raise ValueError(f"the first line of {path} has over {longest} bytes")
        csv.field_size_limit(sys.maxsize)
        text = line.removesuffix(b"\n").decode("utf-8-sig", errors="replace")
        cells = next(csv.reader([text.removesuffix("\r")]), [])
        return info.size, ok, cells, text.endswith("\r")

    def read_heads(batches):
        import pandas

        for batch in batches:
            heads = [head_of(path) for path in batch["file_path"]]
            batch["size_bytes"] = pandas.array([head[0] for head in heads], dtype="Int64")
            for i, column in enumerate(("state", "header", "crlf"), start=1):
                batch[column] = [head[i] for head in heads]
            yield batch

    return read_heads
