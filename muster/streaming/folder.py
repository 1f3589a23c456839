"""Incremental folder job: every list that arrives in a folder is planned once.

The stream carries paths, not rows, as each list has to be read by its own
header. Positions start anew in every list, so no state crosses micro-batches.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from muster.functions import file_type
from muster.plans.dispatch import plan_typed_files
from muster.sinks.writers import write_outbox
from muster.sources.headers import file_list
from muster.sources.lists import FOLDER_OPTIONS, csv_pattern, file_status, probe_lists
from muster.sources.remote import home_folder, is_directly_in, qualify

# A list may arrive with an old time stamp; by default those of a week before the newest are passed over.
ANY_AGE = "36500d"
LISTING = "path string, modificationTime timestamp, length long, content binary"


def plan_arrivals(
    spark: SparkSession,
    folder: str,
    outbox: str,
    checkpoint: str,
    messages: Mapping[str, str],
    sender: str,
    files_per_batch: int = 10_000,
    **options,
) -> StreamingQuery:
    """Plan the lists that are new since the last run and stop.

    Each micro-batch writes ``outbox/plan/run=ID/batch_id=N``, the cells that it passes over to
    ``outbox/rejects/run=ID/batch_id=N`` and the state of all its files to ``outbox/status/run=ID/batch_id=N``, where ID is that of the
    checkpoint. All are overwritten when a batch is replayed after a failure, so a
    replay leaves no second copy; a run with another checkpoint, whose batches
    are numbered from 0 again, leaves what is there alone.
    """

    home = qualify(folder, home_folder(spark))

    def plan_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Names of at most files_per_batch files; their rows stay on the executors.
        arrived = (row.path for row in batch.select("path").collect())
        paths = sorted((path for path in arrived if is_directly_in(path, home)), key=str.encode)
        if not paths:
            return
        place = f"run={_run_id(session, checkpoint)}/batch_id={batch_id}"
        found = file_list(session, paths).withColumn("file_type", file_type(F.col("file_path")))
        known = found.filter(F.col("file_type").isin(list(messages)))
        # Read once: the report tells what the plan was made from.
        probed = probe_lists(session, paths)
        kept = {row.file_ordinal for row in known.select("file_ordinal").collect()}
        planned = [row for row in probed if row.file_ordinal in kept]

        def keep_rejects(rejects: DataFrame) -> None:
            rejects.write.mode("overwrite").parquet(f"{outbox}/rejects/{place}")

        plan = plan_typed_files(session, known, messages, sender, probed=planned, on_rejects=keep_rejects, **options)
        write_outbox(plan, f"{outbox}/plan/{place}", mode="overwrite")
        status = file_status(session, paths, by_type=True, types=list(messages), probed=probed)
        status.write.mode("overwrite").parquet(f"{outbox}/status/{place}")

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .options(**FOLDER_OPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .load(csv_pattern(home))
        .select("path")
    )
    return (
        arrivals.writeStream.foreachBatch(plan_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The number that a checkpoint gives to all runs on it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
