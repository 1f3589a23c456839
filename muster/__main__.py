"""Batch jobs for ``spark-submit``: ``python -m muster <job> ...``. Reports are counts, never numbers."""

from __future__ import annotations

import argparse
import json
from datetime import datetime
from functools import partial
from zoneinfo import ZoneInfo

from muster.functions.times import ZONE
from muster.operators import outcomes, slicing
from muster.plans import dispatch, load, run_totals
from muster.session import build_session, scratch_scope
from muster.sinks import writers
from muster.sources import lists
from muster.sources.text import scan_text
from muster.streaming.folder import plan_arrivals


def main(args: list[str] | None = None) -> None:
    options = _parser().parse_args(args)
    spark = build_session("muster")
    with scratch_scope(spark):
        report = options.job(spark, options)
    print(json.dumps(report))


def _report(spark, paths, types=None):
    by_type = {} if types is None else {"by_type": True, "types": types}
    states = lists.file_status(spark, paths, **by_type).groupBy("status").count().collect()
    return {row["status"]: row["count"] for row in states}


def _sizes(o):
    return {"chunk": o.chunk, "batch": o.batch, "multi_line": o.multi_line}


def _written(plan, o):
    """Runs a plan, a function of what to do with its rejects, and writes both where they are wanted."""
    report = {}

    def keep(rejects):
        report["rejected"] = writers.write_csv(rejects, o.rejects)

    planned = plan(**({"on_rejects": keep} if o.rejects else {}))
    return {"planned": writers.write_outbox(planned, o.out), **report}


def _campaign(spark, o):
    plan = partial(dispatch.plan_campaign, spark, o.lists, o.message, o.sender, **_sizes(o))
    return {"files": _report(spark, o.lists), **_written(plan, o)}


def _segmented(spark, o):
    plan = partial(dispatch.plan_segmented, spark, o.lists, o.older, o.younger, o.sender, **_sizes(o))
    return {"files": _report(spark, o.lists), **_written(plan, o)}


def _calls(spark, o):
    plan = dispatch.plan_call_list(spark, o.lists, o.account, o.batch, o.per_second, o.multi_line)
    return {"files": _report(spark, o.lists), "planned": writers.write_outbox(plan, o.out)}


def _folder(spark, o):
    messages = json.loads(o.messages)
    plan = partial(dispatch.plan_folder, spark, o.folder, messages, o.sender, **_sizes(o))
    states = _report(spark, lists.list_csv_files(spark, o.folder), list(messages))
    return {"files": states, **_written(plan, o)}


def _typed(spark, o):
    messages = json.loads(o.messages)
    plan = partial(dispatch.plan_typed_paths, spark, o.lists, messages, o.sender, **_sizes(o))
    return {"files": _report(spark, o.lists, list(messages)), **_written(plan, o)}


def _campaigns(spark, o):
    layout = "campaign string, file_name string, message string, sender string"
    campaigns = spark.read.option("header", True).schema(layout).csv(o.campaigns)
    plan = partial(dispatch.plan_campaigns, spark, o.lists, campaigns, **_sizes(o))
    return {"files": _report(spark, o.lists), **_written(plan, o)}


def _arrivals(spark, o):
    messages = json.loads(o.messages)
    run = plan_arrivals(
        spark, o.folder, o.out, o.checkpoint, messages, o.sender, **_sizes(o)
    )
    run.awaitTermination()
    return {"batches": len([p for p in run.recentProgress if p.numInputRows])}


def _rejects(spark, o):
    return {"rejected": writers.write_csv(dispatch.list_rejects(spark, o.lists, o.multi_line), o.out)}


def _totals(spark, o):
    issued = spark.read.parquet(o.outcomes)
    totals = outcomes.totals_rollup(outcomes.file_totals(issued, ts="ts"))
    totals.write.mode("errorifexists").parquet(o.out)
    grand = spark.read.parquet(o.out).filter("level = 1").select("issued", "counted", "sent", "failed").first()
    return grand.asDict() if grand else {}


def _run_totals(spark, o):
    read = run_totals.update_totals(spark, o.outcomes, o.table)
    rolled = outcomes.totals_rollup(run_totals.read_totals(spark, o.table))
    grand = rolled.filter("level > 0").select("run", *outcomes.COUNTS, "duration_x100", "rate_x100").collect()
    return {"read": len(read), "totals": {row["run"] or "all": {k: v for k, v in row.asDict().items() if k != "run"} for row in grand}}


def _slice(spark, o):
    rows = slicing.slice_list(spark, o.lists, o.start, o.limit, o.multi_line)
    return {"written": writers.write_csv_in_order(rows, o.out)}


def _strip_quotes(spark, o):
    if o.by_file:
        return {"written": writers.write_files_without_quotes(spark, o.text, o.out)}
    return {"written": writers.write_without_quotes(scan_text(spark, o.text), o.out)}


def _load(spark, o):
    now = datetime.now(ZoneInfo(ZONE)).strftime("%Y-%m-%d %H:%M:%S")
    cells = lists.scan_first_column(spark, o.lists, o.multi_line)
    rows = load.campaign_rows(cells, now)
    report = {"inserted": writers.append_load(rows, o.out, o.load_id) if o.load_id else writers.append_table(rows, o.out)}
    if o.rejects:
        report["rejected"] = writers.append_table(load.rejected_rows(cells, now), o.rejects)
    return report


def _parser():
    parser = argparse.ArgumentParser(prog="muster")
    jobs = parser.add_subparsers(required=True)

    def job(name, run, *names):
        added = jobs.add_parser(name)
        added.set_defaults(job=run)
        for option in names:
            added.add_argument(f"--{option}", required=True)
        return added

    def sizes(added, chunk, batch):
        if chunk:
            added.add_argument("--chunk", type=int, default=chunk)
        added.add_argument("--batch", type=int, default=batch)

    for name, run, names in (
        ("campaign", _campaign, ("message", "sender", "out")),
        ("segmented", _segmented, ("older", "younger", "sender", "out")),
        ("folder", _folder, ("folder", "messages", "sender", "out")),
        ("arrivals", _arrivals, ("folder", "messages", "sender", "out", "checkpoint")),
        ("typed", _typed, ("messages", "sender", "out")),
        ("campaigns", _campaigns, ("campaigns", "out")),
    ):
        sizes(job(name, run, *names), dispatch.CHUNK, dispatch.BATCH)
        if name != "arrivals":
            jobs.choices[name].add_argument("--rejects", help="folder for the cells that the plan passes over")
        if "folder" not in names:
            jobs.choices[name].add_argument("lists", nargs="+")

    calls = job("calls", _calls, "account", "out")
    sizes(calls, None, dispatch.CALL_BATCH)
    calls.add_argument("--per-second", type=int, default=dispatch.CALLS_PER_SECOND)
    calls.add_argument("lists", nargs="+")

    cut = job("slice", _slice, "out")
    cut.add_argument("--start", type=int, default=slicing.START)
    cut.add_argument("--limit", type=int, default=slicing.LIMIT)
    cut.add_argument("lists", nargs="+")

    loaded = job("load", _load, "out")
    loaded.add_argument("--load-id", help="name of the load; run again it replaces its earlier try")
    loaded.add_argument("--rejects", help="table of the rows that are not loaded")
    loaded.add_argument("lists", nargs="+")
    job("rejects", _rejects, "out").add_argument("lists", nargs="+")
    job("totals", _totals, "outcomes", "out")
    job("run-totals", _run_totals, "outcomes", "table")
    stripped = job("strip-quotes", _strip_quotes, "out")
    stripped.add_argument("--by-file", action="store_true", help="one output per input, lines in order")
    stripped.add_argument("text", nargs="+")
    for name, added in jobs.choices.items():
        if name not in ("totals", "run-totals", "strip-quotes"):
            added.add_argument("--multi-line", action="store_true", help="quoted cells may hold line ends")
    return parser


if __name__ == "__main__":
    main()
