"""Rates on one generated list file: ``python bench_lists.py [rows]``, 2,828,001 rows unless told otherwise."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from muster.operators import outcomes  # noqa: E402
from muster.operators.slicing import slice_list  # noqa: E402
from muster.operators.validate import valid_rows  # noqa: E402
from muster.plans import dispatch  # noqa: E402
from muster.session import build_session, scratch_path  # noqa: E402
from muster.sinks import writers  # noqa: E402
from muster.sources.lists import list_csv_files, scan_lists  # noqa: E402


def timed(work):
    best = None
    for _ in range(2):
        began = time.perf_counter()
        work()
        spent = time.perf_counter() - began
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def drain(rows):
    rows.write.format("noop").mode("overwrite").save()


def main(rows: int) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-lists", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    number = F.concat(F.lit("255"), F.lpad((F.col("id") * 7919 % 1_000_000_000).cast("string"), 9, "0"))
    cells = F.when(F.col("id") % 20 == 0, F.lit("n/a")).otherwise(number)
    frame = spark.range(0, rows, 1, 1).select(
        cells.alias("MSISDN"), (F.col("id") % 80).cast("string").alias("AGE"), F.lit("REGION 5").alias("REGION")
    )
    folder = scratch_path(spark, "bench-list")
    writers.write_csv(frame, folder)
    paths = list_csv_files(spark, folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 << 20))

    scan = timed(lambda: drain(valid_rows(scan_lists(spark, paths).rows)))
    plan = timed(lambda: drain(dispatch.plan_lists(spark, paths)))
    outbox = timed(
        lambda: writers.write_outbox(dispatch.plan_campaign(spark, paths, "Hello & bye", "S"), scratch_path(spark, "o"))
    )
    cut = timed(lambda: writers.write_csv(slice_list(spark, paths).drop("pos"), scratch_path(spark, "slice")))

    results = dispatch.plan_lists(spark, paths).select(
        "file_name",
        "chunk_no",
        "batch_no",
        "pos",
        "msisdn",
        F.when(F.col("pos") % 9 == 0, 28).otherwise(0).alias("transport_errno"),
        F.timestamp_seconds(F.col("pos")).cast("timestamp_ntz").alias("ts"),
    )
    table = scratch_path(spark, "outcomes")
    results.write.parquet(table)
    stored = spark.read.parquet(table)
    rollup = timed(
        lambda: drain(outcomes.totals_rollup(outcomes.file_totals(stored, ts="ts")))
    )
    print(
        json.dumps(
            {
                "rows": rows,
                "cores": int(cpus),
                "scan_clean_validate_sec": scan,
                "scan_clean_validate_rows_per_sec": round(rows / scan),
                "dispatch_plan_sec": plan,
                "dispatch_plan_rows_per_sec": round(rows / plan),
                "outbox_write_sec": outbox,
                "slice_sec": cut,
                "rollup_sec": rollup,
            }
        )
    )


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 2_828_001)
