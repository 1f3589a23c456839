"""Paths on the driver, and reaching single files from inside a task."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import SparkSession


def home_folder(spark: SparkSession) -> str:
    """The folder that relative paths start from, as the default file system has it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    system = hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
    return qualify(system.getWorkingDirectory().toString(), "file:/")


def qualify(path: str, home: str) -> str:
    """The one full spelling of a path: ``file:/a/b`` or ``scheme://host/a/b``.

    It is that of the file systems Spark reads by, so that it can be compared with
    the path a row came from: no double or trailing slash, ``.`` and ``..`` resolved.
    ``home`` is the full path that others are relative to.
    """
    scheme, inner = _parts(path)
    if not scheme:
        scheme, folder = _parts(home)
        inner = inner if inner.startswith("/") else f"{folder}/{inner}"
    return scheme + posixpath.normpath("/" + inner.lstrip("/"))


def _parts(path: str) -> tuple[str, str]:
    """Scheme with authority, and the path in it. The local file system has no authority."""
    found = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*:)(//[^/]*)?(?=/|$)", path)
    if not found:
        return "", path
    scheme = "file:" if found[1].lower() == "file:" else found[0]
    return scheme, path[found.end() :]


def decode_listed(uri: str) -> str:
    """Full path of an entry of ``DataFrame.inputFiles()``, which is percent encoded."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


def is_directly_in(path: str, folder: str) -> bool:
    """Whether a full path lies in a folder itself and not in one of its subfolders."""
    return _parts(path.rsplit("/", 1)[0])[1].rstrip("/") == _parts(folder)[1].rstrip("/")


def as_literal(path: str) -> str:
    """Escape the glob characters, so that a reader takes the path as it is."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


# Schemes of the stores that ``task_filesystem`` has a client for.
OPENED = ("file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "abfs", "abfss")


def can_open(path: str) -> bool:
    """Whether a task can open a full path by itself; others only Spark's readers reach."""
    return path.split(":", 1)[0].lower() in OPENED


def task_filesystem() -> Callable:
    """A function ``locate(path) -> (filesystem, path in it)`` for use inside tasks.

    It is a closure so that it travels by value: workers need pyarrow but not this package.
    """

    def locate(path):
        from pyarrow import fs

        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
        scheme, rest = path.split("://", 1)
        if scheme in ("s3a", "s3n"):
            return fs.FileSystem.from_uri("s3://" + rest.split("/", 1)[0])[0], rest
        if scheme == "hdfs":
            host, _, inner = rest.partition("/")
            return fs.FileSystem.from_uri(f"hdfs://{host}")[0], "/" + inner
        return fs.FileSystem.from_uri(path)

    return locate
