"""Accounting for outcomes: last result per number and batch, totals, spans and rates.

An outcome row is one issued request as the outbox has it: the list (see ``IDENTITY``), ``chunk_no``,
``batch_no``, ``pos``, ``msisdn`` and ``transport_errno`` (0 is success).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import duration_hundredths, hms, local_time, rate_hundredths, whole_div

# What tells the lists of all runs apart, as far as the outcomes carry it. The base name alone does not: lists of two
# folders may share it, and one list may be named twice, be in several campaigns or be sent to by several runs.
RUN = ("run", "batch_id")
IDENTITY = (*RUN, "campaign", "file_ordinal", "file_path", "file_name")
BATCH = ("chunk_no", "batch_no")
COUNTS = ("issued", "counted", "sent", "failed")


def identity(outcomes: DataFrame) -> list[str]:
    found = [name for name in IDENTITY if name in outcomes.columns]
    if not found:
        raise ValueError(f"outcomes have none of {', '.join(IDENTITY)}")
    return found


def outcome_counts(outcomes: DataFrame, by: Sequence[str] | None = None, ts: str | None = None) -> DataFrame:
    """Sent and failed by error code, every request counted; with ``ts`` also the duration, in the same pass."""
    counts = [
        F.count_if(F.col("transport_errno") == 0).alias("sent"),
        F.count_if(F.col("transport_errno") != 0).alias("failed"),
    ]
    if ts is not None:
        counts.append(_between(F.min(ts), F.max(ts)).alias("duration_x100"))
    return outcomes.groupBy(*(by or identity(outcomes))).agg(*counts)


def batch_last_outcomes(outcomes: DataFrame, batch: Sequence[str] = BATCH, ts: str | None = None) -> DataFrame:
    """One row per number and batch with its last result; with ``ts`` also its first and last time.

    A number repeated inside a batch is issued each time and counted once. The
    rows are dealt out by batch, groups of a few rows that no file makes hot, so
    what is summed up per batch afterwards needs no second shuffle of them.
    """
    return _last_outcomes(outcomes, batch, ts).drop("_low", "_high", "_places")


def _last_outcomes(outcomes, batch, ts):
    whole = [*identity(outcomes), *batch]
    times = [F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts")] if ts else []
    places = F.bit_or(F.expr("shiftleft(1L, cast(pmod(pos, 64) as int))"))
    return (
        outcomes.repartition(*whole)
        .groupBy(*whole, "msisdn")
        .agg(
            F.max_by("transport_errno", "pos").alias("transport_errno"),
            F.count("*").alias("issued"),
            F.min("pos").alias("_low"),
            F.max("pos").alias("_high"),
            places.alias("_places"),
            *times,
        )
    )


def batch_totals(outcomes: DataFrame, batch: Sequence[str] = BATCH, ts: str | None = None) -> DataFrame:
    """Issued, counted, sent and failed per batch, with ``ts`` also its first and last time.

    A batch holds each of its positions once. One that has a position twice fails the job: its outcomes come from several
    runs that nothing tells apart, and to merge them would count too few numbers. (Beyond 64 positions a batch fails
    if it has more requests than positions.)
    """
    times = [F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts")] if ts else []
    totals = (
        _last_outcomes(outcomes, batch, ts)
        .groupBy(*identity(outcomes), *batch)
        .agg(
            F.sum("issued").alias("issued"),
            F.count("*").alias("counted"),
            F.count_if(F.col("transport_errno") == 0).alias("sent"),
            F.count_if(F.col("transport_errno") != 0).alias("failed"),
            F.min("_low").alias("_low"),
            F.max("_high").alias("_high"),
            F.bit_or("_places").alias("_places"),
            *times,
        )
    )
    span = F.col("_high") - F.col("_low") + 1
    held = F.when(span <= 64, F.bit_count("_places").cast("long")).otherwise(span)
    twice = F.raise_error(F.lit("a batch has a position twice: outcomes of several runs need a run column")).cast("long")
    checked = F.when(F.col("issued") <= held, F.col("issued")).otherwise(twice)
    return totals.withColumn("issued", checked).drop("_low", "_high", "_places")


def batch_distinct(outcomes: DataFrame, batch: Sequence[str] = BATCH) -> DataFrame:
    """Requests issued and numbers counted per batch."""
    return batch_totals(outcomes, batch).drop("sent", "failed")


def file_totals(outcomes: DataFrame, batch: Sequence[str] = BATCH, ts: str | None = None) -> DataFrame:
    """Issued, counted, sent and failed per file; sent and failed by last result per batch.

    With ``ts`` also ``start_ts`` and ``end_ts``, from the same pass over the outcomes.
    """
    return merged(batch_totals(outcomes, batch, ts), identity(outcomes))


def merged(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals of parts that share no batch as totals ``by`` fewer columns."""
    times = [F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts")] if "start_ts" in totals.columns else []
    return totals.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS], *times)


def run_span(outcomes: DataFrame, by: Sequence[str] | None = None, ts: str = "ts") -> DataFrame:
    """First and last time, their local rendering, the duration to a hundredth second and as ``H:i:s``."""
    by = by or identity(outcomes)
    span = outcomes.groupBy(*by).agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"))
    span = span.withColumn("duration_x100", _between(F.col("start_ts"), F.col("end_ts")))
    return span.select(
        *by,
        "start_ts",
        "end_ts",
        local_time(F.col("start_ts")).alias("started"),
        local_time(F.col("end_ts")).alias("ended"),
        "duration_x100",
        hms(whole_div(F.col("duration_x100"), 100)).alias("duration"),
    )


def with_duration(totals: DataFrame) -> DataFrame:
    return totals.withColumn("duration_x100", _between(F.col("start_ts"), F.col("end_ts")))


def add_rate(totals: DataFrame, count: str = "sent", unit_seconds: int = 1, floor_seconds: int = 0) -> DataFrame:
    """Add ``rate_x100``, the ``count`` per unit of time in hundredths, over ``duration_x100``.

    A duration of 0 gives the rate 0; with ``floor_seconds`` shorter durations
    count as that long.
    """
    width = F.greatest(F.col("duration_x100"), F.lit(100 * floor_seconds).cast("long"))
    return totals.withColumn("rate_x100", rate_hundredths(F.col(count), width, unit_seconds))


def totals_rollup(totals: DataFrame, unit_seconds: int = 1) -> DataFrame:
    """Per-file totals and a grand total (``level`` 1, null names) with durations and rates of sending.

    ``totals`` are ``file_totals`` with times. Rolled up from one row per file, so
    the expansion a rollup makes happens after the aggregation and not on the
    outcome rows. The grand duration runs from the first start to the last end.
    Totals with a ``run`` have the grand total of each run at ``level`` 1 and that of all runs at ``level`` 3.
    """
    names = [name for name in identity(totals) if name != "run"]
    runs = ["run"] if "run" in totals.columns else []
    rolled = (
        totals.withColumn("_file", F.struct(*names))
        .rollup(*runs, "_file")
        .agg(
            F.grouping_id().cast("long").alias("level"),
            *[F.sum(c).alias(c) for c in COUNTS],
            _between(F.min("start_ts"), F.max("end_ts")).alias("duration_x100"),
        )
        .select(*runs, "_file.*", "level", *COUNTS, "duration_x100")
    )
    return add_rate(rolled, unit_seconds=unit_seconds)


def _between(start, end):
    return duration_hundredths(F.timestamp_diff("MICROSECOND", start, end))
