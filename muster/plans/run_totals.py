"""Totals over many runs, kept up to date from the outcomes that are new.

Outcomes lie in ``run=ID/batch_id=N`` below one folder, as the folder job lays out its plans. Batches are whole inside
such a part, so the totals of its lists can be made from it alone and later be added up with those of other parts. The
table of totals has the same parts, each with a few rows: one per list, and one without a list that says which state
of the part they were made from. Bringing it up to date lists the files of the outcomes, reads only the parts whose
files are not those it was made from (new ones, and ones that a replay wrote again), and overwrites just these.
A part is replaced as a whole, so what is done twice, or again after a failure, counts once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.operators.lookup import attach
from muster.operators.outcomes import BATCH, COUNTS, RUN, file_totals, identity
from muster.sources.remote import as_literal, home_folder, qualify

RUN_NAME = r"[A-Za-z0-9_.-]+"
# A part in the path of one of its files; ``batch_id`` is a whole number, ``run`` a name as Spark spells it in paths.
PART = r"/(run=[^/]+/batch_id=[0-9]+)/[^/]*\z"
PART_TYPES = "run string, batch_id long"
# Says in a table of totals that a row stands for a part and not for a list.
MARK = "is_mark"


def write_outcomes(outcomes: DataFrame, path: str, run: str, batch_id: int = 0) -> None:
    """Store the outcomes of one part; those of an earlier try are replaced, those of other parts left alone."""
    if not re.fullmatch(RUN_NAME, run):
        raise ValueError(f"a run is named by letters, digits and _.-, not {run!r}")
    outcomes.drop(*RUN).write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")


def changed_parts(spark: SparkSession, outcomes: str, totals: str) -> DataFrame:
    """Parts of the outcomes that the totals were not made from: ``part`` (its folder) and ``state`` of its files."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(as_literal(qualify(outcomes, home_folder(spark))))
    )
    # Only what the listing tells is used; no file is opened.
    part = F.regexp_extract("path", PART, 1)
    state = F.bit_xor(F.xxhash64("path", "length", F.col("modificationTime").cast("long")))
    found = files.groupBy(part.alias("part")).agg(state.alias("state")).where("part != ''")
    known = _stored(spark, totals)
    if known is None:
        return found
    marks = known.where(MARK).select("part", "state")
    return found.join(marks, ["part", "state"], "left_anti")


def new_outcomes(spark: SparkSession, outcomes: str, parts: Sequence[str]) -> DataFrame:
    """The outcomes in some parts, with ``run`` and ``batch_id``; the other parts are not even listed."""
    folder = qualify(outcomes, home_folder(spark))
    paths = [as_literal(f"{folder}/{part}") for part in parts]
    # Named types keep a run called 007 as it is.
    inside = spark.read.parquet(paths[0]).drop(*RUN).schema
    layout = inside.add("run", "string").add("batch_id", "long")
    return spark.read.schema(layout).option("basePath", folder).parquet(*paths)


def update_totals(
    spark: SparkSession, outcomes: str, totals: str, batch: Sequence[str] = BATCH, ts: str = "ts"
) -> list[str]:
    """Bring the table of totals up to date and return the parts that were read.

    The driver holds the names of these parts, one per run and micro-batch; their rows stay on the executors.
    """
    changed = {row["part"]: row["state"] for row in changed_parts(spark, outcomes, totals).collect()}
    if not changed:
        return []
    parts = sorted(changed)
    made = file_totals(new_outcomes(spark, outcomes, parts), batch, ts)
    states = spark.createDataFrame([(*_run_of(part), part, changed[part]) for part in parts], f"{PART_TYPES}, part string, state long")
    named = made.withColumn("_part", F.struct(*RUN))
    marked = attach(named, states.select(F.struct(*RUN).alias("_part"), "part", "state"), "_part").drop("_part")
    both = marked.withColumn(MARK, F.lit(False)).unionByName(states.withColumn(MARK, F.lit(True)), allowMissingColumns=True)
    # A part has a row per list of a micro-batch, which one task can hold.
    dealt = both.repartition(*RUN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    dealt.partitionBy(*RUN).parquet(totals)
    return parts


def read_totals(spark: SparkSession, totals: str) -> DataFrame:
    """Totals per run, micro-batch and list, as ``file_totals`` gives them, for ``merged`` and ``totals_rollup``."""
    stored = _stored(spark, totals)
    if stored is None:
        raise FileNotFoundError(totals)
    lists = stored.where(~F.col(MARK))
    return lists.select(*identity(lists), *COUNTS, "start_ts", "end_ts")


def _stored(spark, totals):
    folder = qualify(totals, home_folder(spark))
    try:
        inside = spark.read.parquet(as_literal(folder)).drop(*RUN).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return spark.read.schema(inside.add("run", "string").add("batch_id", "long")).parquet(as_literal(folder))


def _run_of(part):
    run, batch_id = part.split("/")
    return unquote(run.removeprefix("run=")), int(batch_id.removeprefix("batch_id="))
