"""One query per operator, on the driver's tables or on files that Spark writes from them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (
    CAMPAIGNS,
    MESSAGES,
    SENDER,
    bulk_lists,
    campaign_table,
    list_folder,
    list_names,
    quoted_lists,
    spelled,
    subscribers,
    table,
    traffic,
)
from muster.functions import (
    base_name,
    clean_msisdn,
    extension,
    file_type,
    form_encode,
    has_csv_extension,
    hms,
    is_numeric_string,
    local_time,
    numeric_value,
    sms_query,
    strip_quotes,
    voice_query,
    whole_div,
)
from muster.operators import lookup, outcomes, validate
from muster.operators.position import number_by_key, number_by_split
from muster.operators.slicing import slice_list
from muster.plans import dispatch, load, run_totals
from muster.session import scratch_path
from muster.sinks import writers
from muster.sources import lists
from muster.sources.headers import MISSING, OK, file_list, probe_files
from muster.sources.remote import decode_listed
from muster.sources.text import scan_text
from muster.streaming.folder import plan_arrivals

CHUNK, BATCH = 70, 11
HOUR = 3_600
RUN_TIME = "2024-05-16 08:30:00"
SLICE_START, SLICE_LIMIT = 1_001, 5_000
PAGES_PER_FILE = 100


def _numbered(spark, sf_dir):
    return number_by_key(validate.valid_rows(subscribers(spark, sf_dir)))


def _plan(spark, sf_dir):
    return dispatch.plan_batches(_numbered(spark, sf_dir), CHUNK, BATCH)


def _issued(spark, sf_dir, files=1):
    return dispatch.plan_batches(number_by_key(traffic(spark, sf_dir, files)))


# Sources


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lists.scan_lists(spark, bulk_lists(spark, sf_dir, "subscribers"), optional=("AGE", "ROW_KEY")).rows
    return rows.select(F.coalesce("msisdn_raw", F.lit("")).alias("msisdn_raw"), "age_raw", "row_key_raw")


def resolve_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    probed = probe_files(spark, list_folder(spark, sf_dir)[1])
    return probed.filter(F.col("status") != MISSING).select("file_ordinal", "file_name", "key_index", "age_index")


def csv_scan_first_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "first-column")
    writers.write_csv(table(spark, sf_dir, "events").select("props", "event_id"), path)
    return lists.scan_first_column(spark, path)


def multi_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = lists.scan_lists(spark, spelled(*list_folder(spark, sf_dir)))
    rows = number_by_split(scan.rows, scan.files)
    raw = F.coalesce("msisdn_raw", F.lit("")).alias("msisdn_raw")
    return rows.select("file_ordinal", "file_name", "pos", raw, F.coalesce("age_raw", F.lit("")).alias("age_raw"))


def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lists.discover_files(spark, f"{list_folder(spark, sf_dir)[0]}/.//")
    return found.select("file_ordinal", "file_name", "file_type")


def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = lists.file_status(spark, list_folder(spark, sf_dir)[1], by_type=True)
    return report.select("file_ordinal", "file_name", "status")


def files_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = lists.scan_lists(spark, list_folder(spark, sf_dir)[1], optional=())
    return validate.valid_rows(scan.rows).select("msisdn")


def file_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = list_folder(spark, sf_dir)[1]
    read = lists.file_status(spark, paths).filter(F.col("status") == OK)
    return read.select("file_name", "file_ordinal", F.lit(len(paths)).cast("long").alias("files"))


def file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, paths = list_folder(spark, sf_dir)
    scan = lists.scan_lists(spark, paths)
    listed = len(lists.list_csv_files(spark, folder))
    return scan.rows.agg(
        F.lit(listed).cast("long").alias("listed"), F.count_distinct("split_path").alias("with_rows")
    )


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    writers.write_text(table(spark, sf_dir, "documents").select("text"), path)
    return scan_text(spark, path)


# Sinks


def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    events = table(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_id").cast("string").alias("ID"),
        F.col("props").alias("PROPS"),
        F.concat(F.lit(" "), "event_type", F.lit(", ")).alias("NOTE"),
    )
    writers.write_csv(rows, path)
    return lists.csv_reader(spark).schema(rows.schema).csv(path)


def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    writers.write_text(table(spark, sf_dir, "pages").select("html"), raw)
    writers.write_without_quotes(scan_text(spark, raw), clean)
    return scan_text(spark, clean)


def text_sink_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in files of a hundred, cleaned file by file, and all lines numbered as the outputs stand."""
    raw, clean = scratch_path(spark, "raw-files"), scratch_path(spark, "clean-files")
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("value"))
    parts = pages.agg(F.max("page_id")).first()[0] // PAGES_PER_FILE + 1
    dealt = pages.repartitionById(parts, whole_div(F.col("page_id"), PAGES_PER_FILE).cast("int"))
    writers.write_text(dealt.sortWithinPartitions("page_id").select("value"), raw)
    inputs = sorted(spark.read.text(raw).inputFiles())
    writers.write_files_without_quotes(spark, inputs, clean)
    outputs = spark.read.parquet(f"{clean}/inputs").orderBy("file_ordinal").collect()
    written = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{clean}/lines").select("path").collect()
    by_list: dict[str, list[str]] = {}
    for row in sorted(written):
        by_list.setdefault(re.search(r"list_id=(-?\d+)/", row.path)[1], []).append(decode_listed(row.path))
    paths = [path for row in outputs for path in by_list[str(row.list_id)]]
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("value").alias("line"),
        F.input_file_name().alias("split_path"),
        F.input_file_block_start().alias("split_start"),
        F.input_file_block_length().alias("split_length"),
    )
    return number_by_split(lines, file_list(spark, paths)).select(F.col("list_pos").alias("line_no"), "line")


def table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, of which one was run again after it had been done in part."""
    path = scratch_path(spark, "loads")
    rows = load.campaign_rows(subscribers(spark, sf_dir), RUN_TIME, "msisdn_raw")
    writers.append_load(rows.limit(5), path, "007")
    for load_id in ("7", "007", "007"):
        writers.append_load(rows, path, load_id)
    return writers.read_loads(spark, path)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _load_halves(spark, sf_dir)
    return spark.read.parquet(path)


def written_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, written = _load_halves(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(written)), "part long, written long")


def _load_halves(spark, sf_dir):
    path = scratch_path(spark, "campaign")
    rows = subscribers(spark, sf_dir)
    written = [
        writers.append_table(load.campaign_rows(rows.filter(F.col("row_key") % 2 == half), RUN_TIME, "msisdn_raw"), path)
        for half in (0, 1)
    ]
    return path, written


def sms_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sms-outbox")
    typed = _plan(spark, sf_dir).withColumn("file_type", file_type(F.col("file_name")))
    plan = lookup.bind_messages(typed, MESSAGES).withColumn("sender", F.lit(SENDER))
    writers.write_outbox(dispatch.sms_outbox(plan), path)
    return writers.read_outbox(spark, path)


def voice_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "voice-outbox")
    writers.write_outbox(dispatch.voice_outbox(dispatch.plan_calls(_numbered(spark, sf_dir)), 77), path)
    return writers.read_outbox(spark, path)


def msisdn_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = validate.rejected_rows(subscribers(spark, sf_dir))
    return rejected.select("file_name", "row_key", "msisdn_raw", "reason")


# Row operators


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subscribers(spark, sf_dir).select("row_key", clean_msisdn(F.col("msisdn_raw")).alias("msisdn"))


def valid_msisdns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.valid_rows(subscribers(spark, sf_dir)).select("file_name", "row_key", "msisdn")


def validity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validity_counts(subscribers(spark, sf_dir))


def nonempty_msisdns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.nonempty_rows(subscribers(spark, sf_dir), "msisdn_raw").select("row_key", "msisdn")


def campaign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.campaign_rows(subscribers(spark, sf_dir), RUN_TIME, "msisdn_raw")


def age_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = subscribers(spark, sf_dir)
    text = validate.segment_message(F.col("age_raw"), "Care for joints", "Care for muscles")
    return rows.select("row_key", validate.age_segment(F.col("age_raw")).alias("segment"), text.alias("message"))


def numeric_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.col("age_raw")
    return subscribers(spark, sf_dir).select(
        "row_key", is_numeric_string(age).alias("is_numeric"), numeric_value(age).alias("number")
    )


def file_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = subscribers(spark, sf_dir)
    return rows.select("row_key", "file_name", file_type(F.col("file_name")).alias("file_type"))


def supported_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = list_names(spark, sf_dir).select("list_name", file_type(F.col("list_name")).alias("file_type"))
    return names.filter(F.col("file_type").isNotNull())


def csv_files_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_names(spark, sf_dir).filter(has_csv_extension(F.col("list_name"))).select("list_name")


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", base_name(url).alias("base_name"), extension(url).alias("extension")
    )


def strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", strip_quotes(F.col("html")).alias("html"))


def url_encode_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", form_encode(F.col("text")).alias("encoded"))


def request_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = F.concat(F.lit("255"), F.lpad(F.col("page_id").cast("string"), 9, "0"))
    query = sms_query(F.lit("CARE LINE"), to, F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", query.alias("request_query"))


def voice_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = traffic(spark, sf_dir)
    return rows.select("row_key", voice_query(F.col("msisdn"), 77).alias("request_query"))


def local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", local_time(F.col("ts")).alias("local_ts"))


def duration_hms(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = (F.col("event_id") * 37) % 200_000
    return table(spark, sf_dir, "events").select("event_id", hms(seconds).alias("duration"))


# Lookups


def message_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = subscribers(spark, sf_dir).withColumn("file_type", file_type(F.col("file_name")))
    return lookup.bind_messages(typed, MESSAGES).select("row_key", "file_type", "message")


def known_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = list_names(spark, sf_dir).withColumn("file_type", file_type(F.col("list_name")))
    two = {kind: MESSAGES[kind] for kind in ("ivr", "sms")}
    kept = lookup.known_types(typed, two).withColumn("known", F.lit(True))
    left = lookup.known_types(typed, two, known=False).withColumn("known", F.lit(False))
    return kept.unionByName(left).select("list_name", "known")


def campaign_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    campaigns = spark.createDataFrame(CAMPAIGNS, "campaign string, file_name string, message string, sender string")
    bound = lookup.bind_campaigns(subscribers(spark, sf_dir), campaigns)
    return bound.select("row_key", "file_name", "campaign", "message", "sender")


# Positions and plans


def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("file_name", "row_key", "pos", "file_rows")


def file_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of raw CSV rows; over all parts they equal the order of ``ROW_KEY``."""
    scan = lists.scan_lists(spark, bulk_lists(spark, sf_dir, "subscribers"), optional=("ROW_KEY",))
    numbered = number_by_split(validate.valid_rows(scan.rows), scan.files)
    return numbered.select(F.col("row_key_raw").cast("long").alias("row_key"), "msisdn", "list_pos")


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir).select("file_name", "msisdn", "pos", "chunk_no", "chunk_pos", "batch_no", "port")


def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issued(spark, sf_dir).select("row_key", "pos", "chunk_no", "chunk_pos", "batch_no")


def port_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issued(spark, sf_dir, 3).select("file_name", "row_key", "port")


def throttle_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = dispatch.plan_calls(_numbered(spark, sf_dir))
    return calls.select("file_name", "pos", "batch_no", "earliest_start_s")


def final_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = dispatch.flag_final_chunks(_plan(spark, sf_dir), CHUNK)
    return flagged.select("file_name", "pos", "chunk_no", "in_final_chunk")


def chunk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.chunk_sizes(validate.validity_counts(subscribers(spark, sf_dir)), chunk=CHUNK)


def row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_list(spark, bulk_lists(spark, sf_dir, "traffic"), SLICE_START, SLICE_LIMIT)


def ordered_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of files larger than a group, written in order; the parts by name are numbered as they stand."""
    path = scratch_path(spark, "ordered-slice")
    cut = slice_list(spark, bulk_lists(spark, sf_dir, "traffic"), SLICE_START, SLICE_LIMIT, group_bytes=4_096)
    writers.write_csv_in_order(cut, path, rows_per_part=1_000)
    scan = lists.scan_lists(spark, lists.list_csv_files(spark, path), optional=("ROW_KEY",))
    return number_by_split(scan.rows, scan.files).select("list_pos", "msisdn_raw", "row_key_raw")


def stream_folder_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream")
    run = plan_arrivals(
        spark, f"{list_folder(spark, sf_dir)[0]}/x/..//", out, f"{out}/checkpoint", MESSAGES, SENDER, chunk=CHUNK, batch=BATCH
    )
    run.awaitTermination()
    columns = ("file_name", "msisdn", "pos", "chunk_no", "batch_no", "port", "message")
    return spark.read.parquet(f"{out}/plan").select(*columns)


def typed_paths_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named lists of any extension, by the type that their names tell."""
    paths = list_folder(spark, sf_dir)[1]
    plan = dispatch.plan_typed_paths(spark, paths, MESSAGES, SENDER, chunk=CHUNK, batch=BATCH)
    return plan.select("file_ordinal", "file_name", "msisdn", "pos", "chunk_no", "batch_no", "port", "message")


def campaigns_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, campaigns = list_folder(spark, sf_dir)[1], campaign_table(spark, sf_dir)
    plan = dispatch.plan_campaigns(spark, paths, campaigns, chunk=CHUNK, batch=BATCH)
    return plan.select("campaign", "file_ordinal", "file_name", "msisdn", "pos", "chunk_no", "batch_no", "message", "sender")


def quoted_lines_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = dispatch.plan_lists(spark, quoted_lists(spark, sf_dir), multi_line=True)
    return plan.select("msisdn", "list_pos")


# Outcomes


def campaign_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of lists that share their names: two folders of equal lists, the first one named twice."""
    (one, first), (two, second) = list_folder(spark, sf_dir), list_folder(spark, sf_dir, "same-names")
    paths = [*first, *spelled(two, second), *spelled(one, first)]
    plan = dispatch.plan_campaigns(spark, paths, campaign_table(spark, sf_dir), chunk=CHUNK, batch=BATCH)
    results = plan.withColumn("transport_errno", F.when(F.col("pos") % 4 == 0, 28).otherwise(0))
    totals = outcomes.file_totals(results)
    return totals.select("campaign", "file_ordinal", "file_name", "issued", "counted", "sent", "failed")


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.outcome_counts(traffic(spark, sf_dir, 3))


def batch_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.batch_distinct(_issued(spark, sf_dir))


def batch_last_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.batch_last_outcomes(_issued(spark, sf_dir))


def totals_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.totals_rollup(outcomes.file_totals(_issued(spark, sf_dir, 3), ts="ts"), HOUR)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the folder job passes over, kept beside its plan."""
    out = scratch_path(spark, "stream-rejects")
    run = plan_arrivals(spark, list_folder(spark, sf_dir)[0], out, f"{out}/checkpoint", MESSAGES, SENDER)
    run.awaitTermination()
    return spark.read.parquet(f"{out}/rejects").select("file_name", "msisdn_raw", "reason")


def plan_and_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows planned and rejected per list, both from the two passes of one plan."""
    rejected = []
    plan = dispatch.plan_lists(spark, list_folder(spark, sf_dir)[1], on_rejects=rejected.append)
    planned = plan.groupBy("file_name").agg(F.count("*").alias("planned"), (F.max("pos") + 1).alias("positions"))
    passed_over = rejected[0].groupBy("file_name").agg(F.count("*").alias("rejected"))
    both = planned.join(passed_over, "file_name", "full")
    return both.select("file_name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("planned", "positions", "rejected")])


def run_totals_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two runs over equal lists, kept up to date as they come; one batch is replayed after half of it was sent."""
    plan, results, totals = (scratch_path(spark, label) for label in ("issued", "outcomes", "totals"))
    _issued(spark, sf_dir, 3).write.parquet(plan)
    issued = spark.read.parquet(plan)
    early = F.col("file_name") != "traffic_2.csv"
    run_totals.write_outcomes(issued.filter(early & (F.col("pos") % 2 == 0)), results, "first", 0)
    run_totals.update_totals(spark, results, totals)
    for run in ("first", "second"):
        for batch_id, rows in enumerate((issued.filter(early), issued.filter(~early))):
            run_totals.write_outcomes(rows, results, run, batch_id)
        run_totals.update_totals(spark, results, totals)
    return outcomes.totals_rollup(run_totals.read_totals(spark, totals), HOUR)


def voice_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls per list: processed with repeats, success and failed by last result per batch."""
    calls = dispatch.plan_calls(number_by_key(traffic(spark, sf_dir, 3)))
    totals = outcomes.with_duration(outcomes.file_totals(calls, ("batch_no",), ts="ts")).select(
        "file_name", F.col("issued").alias("processed"), F.col("sent").alias("success"), "failed", "duration_x100"
    )
    return outcomes.add_rate(totals, "processed", HOUR)


def run_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = outcomes.run_span(traffic(spark, sf_dir, 3))
    return span.select("file_name", "started", "ended", "duration_x100", "duration")


def send_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.add_rate(outcomes.outcome_counts(traffic(spark, sf_dir, 3), ts="ts"), unit_seconds=HOUR)


def send_rate_floor1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list per minute: most have a single request, so their durations are below a second."""
    minute = F.date_format("ts", "yyyyMMddHHmm")
    rows = traffic(spark, sf_dir).withColumn("file_name", F.concat(F.lit("traffic_"), minute, F.lit(".csv")))
    return outcomes.add_rate(outcomes.outcome_counts(rows, ts="ts"), floor_seconds=1)


QUERIES = {
    "csv_scan": csv_scan,
    "resolve_column": resolve_column,
    "csv_scan_first_column": csv_scan_first_column,
    "multi_file_scan": multi_file_scan,
    "discover_files": discover_files,
    "file_status": file_status,
    "files_union": files_union,
    "file_ordinals": file_ordinals,
    "file_count": file_count,
    "text_scan": text_scan,
    "csv_sink": csv_sink,
    "text_sink": text_sink,
    "text_sink_by_file": text_sink_by_file,
    "table_append": table_append,
    "table_load": table_load,
    "written_count": written_count,
    "sms_outbox": sms_outbox,
    "voice_outbox": voice_outbox,
    "msisdn_rejects": msisdn_rejects,
    "clean_msisdn": clean,
    "valid_msisdns": valid_msisdns,
    "validity_counts": validity_counts,
    "nonempty_msisdns": nonempty_msisdns,
    "campaign_rows": campaign_rows,
    "age_segments": age_segments,
    "numeric_strings": numeric_strings,
    "file_types": file_types,
    "supported_files": supported_files,
    "csv_files_only": csv_files_only,
    "path_parts": path_parts,
    "strip_quotes": strip,
    "url_encode_form": url_encode_form,
    "request_query": request_query,
    "voice_request": voice_request,
    "local_time": local_times,
    "duration_hms": duration_hms,
    "message_by_type": message_by_type,
    "known_types": known_types,
    "campaign_binding": campaign_binding,
    "row_positions": row_positions,
    "file_positions": file_positions,
    "chunk_plan": chunk_plan,
    "batch_plan": batch_plan,
    "port_plan": port_plan,
    "throttle_schedule": throttle_schedule,
    "final_chunks": final_chunks,
    "chunk_sizes": chunk_sizes,
    "row_slice": row_slice,
    "ordered_slice": ordered_slice,
    "stream_folder_plan": stream_folder_plan,
    "stream_rejects": stream_rejects,
    "plan_and_rejects": plan_and_rejects,
    "typed_paths_plan": typed_paths_plan,
    "campaigns_plan": campaigns_plan,
    "quoted_lines_plan": quoted_lines_plan,
    "campaign_totals": campaign_totals,
    "outcome_counts": outcome_counts,
    "batch_distinct": batch_distinct,
    "batch_last_outcome": batch_last_outcome,
    "totals_rollup": totals_rollup,
    "run_totals": run_totals_table,
    "voice_totals": voice_totals,
    "run_span": run_span,
    "send_rate": send_rate,
    "send_rate_floor1": send_rate_floor1,
}
