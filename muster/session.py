"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_local_folder: str | None = None


def build_session(app_name: str = "muster", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is written for.

    Times are handled without a zone or in a named one, so the session zone is
    pinned to UTC. AQE coalesces small shuffle partitions and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder stands in, which is only
    reachable in local mode; a cluster without the setting is an error.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="muster-")
    return _local_folder


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to fresh paths inside; frames that read it must be used up by then."""
    first = len(_scratch)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scratch[first:]:
            found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(hadoop).delete(found, True)
        del _scratch[first:]


def child_session(spark: SparkSession, settings: dict[str, object]) -> SparkSession:
    """A session beside this one, with its settings but for some."""
    session = spark.newSession()
    inherited = {key: value for key, value in spark.conf.getAll.items() if spark.conf.isModifiable(key)}
    for key, value in {**inherited, **settings}.items():
        session.conf.set(key, str(value))
    return session


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, which need not be installed where they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="muster-code-")) / "muster-code.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(package.rglob("*.py")):
            packed.write(module, f"{package.name}/{module.relative_to(package)}")
    context.addPyFile(str(archive))


def pin_split_size(spark: SparkSession) -> int:
    """Keep the cutting of files into splits the same for every scan of this session.

    Spark derives the split size from the number of cores when it starts a scan,
    and that number moves when executors come and go. Operators that read the
    same files twice need the same splits both times. Returns the pinned number.
    """
    setting = "spark.sql.files.minPartitionNum"
    pinned = spark.conf.get(setting, None)
    if pinned is None:
        pinned = str(max(spark.sparkContext.defaultParallelism, 1))
        spark.conf.set(setting, pinned)
    return int(pinned)
