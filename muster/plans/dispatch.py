"""The dispatch plan: chunk, batch, port and schedule of every valid row, and the request rows.

All of it is arithmetic on ``pos``, so nothing here shuffles. Nothing is sent:
the plan ends in an outbox table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from muster.functions import base_name, file_type, plain_path, sms_query, voice_query, whole_div
from muster.functions.encoding import DLR_MASK
from muster.operators.lookup import bind_campaigns, bind_messages, known_types
from muster.operators.outcomes import identity
from muster.operators.position import count_and_reject, number_by_split
from muster.operators.validate import BAD_MSISDN, flag_rows, rejected_rows, segment_message, valid_rows
from muster.sources.headers import file_list
from muster.sources.lists import discover_files, probe_lists, scan_lists

# Sizes of a message campaign, its ports, and those of a call campaign.
CHUNK = 5_000
BATCH = 11
PORTS = (6016, 6017, 6018)
CALL_BATCH = 50
CALLS_PER_SECOND = 20

CHUNKS_PER_BLOCK = 10_000


def plan_batches(
    numbered: DataFrame, chunk: int = CHUNK, batch: int = BATCH, ports: Sequence[int] = PORTS
) -> DataFrame:
    """Add ``chunk_no`` (from 1), ``chunk_pos``, ``batch_no`` (from 0 in its chunk) and ``port``."""
    chunk_pos = F.col("pos") % chunk
    turn = (chunk_pos % len(ports) + 1).cast("int")
    return (
        numbered.withColumn("chunk_no", whole_div(F.col("pos"), chunk) + 1)
        .withColumn("chunk_pos", chunk_pos)
        .withColumn("batch_no", whole_div(chunk_pos, batch))
        .withColumn("port", F.element_at(F.array(*[F.lit(p) for p in ports]), turn))
    )


def flag_final_chunks(plan: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Add ``in_final_chunk``: in the partial chunk at the end of a file. A full last chunk is none."""
    partial = (F.col("file_rows") % chunk != 0) & (F.col("chunk_no") == whole_div(F.col("file_rows"), chunk) + 1)
    return plan.withColumn("in_final_chunk", partial)


def chunk_sizes(file_counts: DataFrame, rows: str = "valid", chunk: int = CHUNK) -> DataFrame:
    """Chunks of each file with their sizes, from the number of valid rows alone; no row is numbered.

    The chunks of a file are laid out in blocks, so that neither one array nor
    one task has to hold all chunks of a very large file.
    """
    total = F.col(rows)
    blocks = F.sequence(F.lit(0).cast("long"), whole_div(total - 1, chunk * CHUNKS_PER_BLOCK))
    tasks = int(file_counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = (
        file_counts.filter(total > 0)
        .select("file_name", total.alias("_total"), F.explode(blocks).alias("_block"))
        .repartition(tasks, "file_name", "_block")
    )
    first = F.col("_block") * CHUNKS_PER_BLOCK + 1
    last = F.least(first + (CHUNKS_PER_BLOCK - 1), whole_div(F.col("_total") - 1, chunk) + 1)
    numbered = laid_out.withColumn("chunk_no", F.explode(F.sequence(first, last)))
    size = F.least(F.lit(chunk).cast("long"), F.col("_total") - (F.col("chunk_no") - 1) * chunk)
    return numbered.select("file_name", "chunk_no", size.alias("chunk_rows"))


def plan_calls(numbered: DataFrame, batch: int = CALL_BATCH, per_second: int = CALLS_PER_SECOND) -> DataFrame:
    """Add ``batch_no`` and ``earliest_start_s``: a pause of whole seconds follows every full batch."""
    pause = -(-batch // per_second)
    number = whole_div(F.col("pos"), batch)
    return numbered.withColumn("batch_no", number).withColumn("earliest_start_s", number * pause)


def sms_outbox(plan: DataFrame) -> DataFrame:
    """Request rows of a message plan that carries ``message`` and ``sender``, with what tells its lists apart."""
    return plan.select(
        *identity(plan),
        "msisdn",
        "pos",
        "chunk_no",
        "chunk_pos",
        "batch_no",
        "port",
        "sender",
        "message",
        F.lit(DLR_MASK).alias("dlr_mask"),
        sms_query(F.col("sender"), F.col("msisdn"), F.col("message")).alias("request_query"),
    )


def voice_outbox(plan: DataFrame, account: int | str) -> DataFrame:
    return plan.select(
        *identity(plan),
        "msisdn",
        "pos",
        "batch_no",
        "earliest_start_s",
        voice_query(F.col("msisdn"), account).alias("request_query"),
    )


def plan_lists(
    spark: SparkSession,
    paths: Sequence[str],
    bound: DataFrame | None = None,
    message: Column | None = None,
    multi_line: bool = False,
    probed: Sequence[Row] | None = None,
    on_rejects: Callable[[DataFrame], object] | None = None,
    **sizes,
) -> DataFrame:
    """Plan the valid rows of list files, each file numbered by itself in list order.

    ``bound`` adds columns per ``file_ordinal`` (see ``number_by_split``);
    ``message`` is an expression over the row cells ``msisdn_raw`` and
    ``age_raw``. ``multi_line`` and ``probed`` are those of ``scan_lists``; all
    plans below take ``multi_line`` as well. ``on_rejects`` is given the cells that
    take no position, as ``list_rejects`` has them; they come from the plan's first
    pass, so the lists are not read once more. All plans below but that of calls take it.
    """
    scan = scan_lists(spark, paths, multi_line=multi_line, probed=probed)
    splits = None
    if on_rejects is not None:
        splits, rejected = count_and_reject(flag_rows(scan.rows))
        on_rejects(_reject_lines(rejected.withColumn("reason", F.lit(BAD_MSISDN))))
    valid = valid_rows(scan.rows)
    if message is not None:
        valid = valid.withColumn("message", message)
    return plan_batches(number_by_split(valid, scan.files, splits, bound=bound), **sizes)


def list_rejects(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """The cells of list files that take no position: ``file_path``, ``file_name``, ``msisdn_raw``, ``reason``."""
    return _reject_lines(rejected_rows(scan_lists(spark, paths, optional=(), multi_line=multi_line).rows))


def _reject_lines(rejected):
    path = plain_path(F.col("split_path"))
    return rejected.select(
        path.alias("file_path"),
        base_name(path).alias("file_name"),
        F.coalesce("msisdn_raw", F.lit("")).alias("msisdn_raw"),
        "reason",
    )


def plan_campaign(spark: SparkSession, paths: Sequence[str], message: str, sender: str, **options) -> DataFrame:
    """Outbox of one message to all valid numbers of the given lists."""
    plan = plan_lists(spark, paths, **options)
    return sms_outbox(plan.withColumn("message", F.lit(message)).withColumn("sender", F.lit(sender)))


def plan_campaigns(
    spark: SparkSession,
    paths: Sequence[str],
    campaigns: DataFrame,
    multi_line: bool = False,
    on_rejects: Callable[[DataFrame], object] | None = None,
    **sizes,
) -> DataFrame:
    """Outbox of many campaigns: ``campaign``, ``file_name``, ``message``, ``sender`` rows bound to the lists.

    The campaigns meet the table of files, not the rows. A list in two campaigns
    is planned for both; a list in none is left out.
    """
    bound = bind_campaigns(file_list(spark, paths), campaigns).select("file_ordinal", "campaign", "message", "sender")
    return sms_outbox(plan_lists(spark, paths, bound, multi_line=multi_line, on_rejects=on_rejects, **sizes))


def plan_segmented(
    spark: SparkSession, paths: Sequence[str], older: str, younger: str, sender: str, **options
) -> DataFrame:
    """Outbox of one of two messages by age. A list without an age column gets the younger one."""
    message = segment_message(F.col("age_raw"), older, younger)
    plan = plan_lists(spark, paths, message=message, **options)
    return sms_outbox(plan.withColumn("sender", F.lit(sender)))


def plan_folder(spark: SparkSession, folder: str, messages: Mapping[str, str], sender: str, **options) -> DataFrame:
    """Discover the typed lists of a folder, bind their messages and plan them as an outbox."""
    return plan_typed_files(spark, discover_files(spark, folder, list(messages)), messages, sender, **options)


def plan_typed_paths(
    spark: SparkSession, paths: Sequence[str], messages: Mapping[str, str], sender: str, **options
) -> DataFrame:
    """As ``plan_folder`` for named files of any extension; names of unknown type are left out."""
    listed = file_list(spark, paths)
    typed = known_types(listed.withColumn("file_type", file_type(F.col("file_path"))), messages)
    return plan_typed_files(spark, typed, messages, sender, **options)


def plan_typed_files(
    spark: SparkSession,
    found: DataFrame,
    messages: Mapping[str, str],
    sender: str,
    probed: Sequence[Row] | None = None,
    **options,
) -> DataFrame:
    """Plan the files of a listing that has ``file_ordinal``, ``file_path`` and ``file_type``.

    ``probed`` has the state of the files of the listing, under the ordinals of it.
    """
    listed = found.orderBy("file_ordinal").select("file_ordinal", "file_path").collect()
    if probed is None:
        probed = probe_lists(spark, [row.file_path for row in listed])
        ordinals = {place: row.file_ordinal for place, row in enumerate(listed, start=1)}
        probed = [Row(**{**row.asDict(), "file_ordinal": ordinals[row.file_ordinal]}) for row in probed]
    bound = bind_messages(found, messages).withColumn("sender", F.lit(sender))
    bound = bound.select("file_ordinal", "file_type", "message", "sender")
    return sms_outbox(plan_lists(spark, [], bound, probed=probed, **options))


def plan_call_list(
    spark: SparkSession,
    paths: Sequence[str],
    account: int | str,
    batch: int = CALL_BATCH,
    per_second: int = CALLS_PER_SECOND,
    multi_line: bool = False,
) -> DataFrame:
    """Outbox of voice calls to all valid numbers of the given lists."""
    scan = scan_lists(spark, paths, optional=(), multi_line=multi_line)
    numbered = number_by_split(valid_rows(scan.rows), scan.files)
    return voice_outbox(plan_calls(numbered, batch, per_second), account)
