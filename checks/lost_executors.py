"""Run queries on two executor processes and kill one of them during each: ``python -m checks.lost_executors [sf_dir]``."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import threading
import time

from checks.compare import compare, connect
from muster.session import build_session

NAMES = (
    "multi_file_scan",
    "totals_rollup",
    "file_positions",
    "sms_outbox",
    "batch_last_outcome",
    "row_slice",
    "stream_folder_plan",
)
DELAY = 1.5


def own_executors() -> list[int]:
    """Executor processes among the descendants of this one."""
    listing = subprocess.run(["ps", "-eo", "pid,ppid,cmd"], capture_output=True, text=True, check=True).stdout
    rows = [line.split(None, 2) for line in listing.splitlines()[1:]]
    family = {os.getpid()}
    while True:
        grown = family | {int(pid) for pid, parent, *_ in rows if int(parent) in family}
        if grown == family:
            break
        family = grown
    return [int(r[0]) for r in rows if int(r[0]) in family and "CoarseGrainedExecutorBackend" in r[2]]


def kill_one(killed: list[int]) -> None:
    time.sleep(DELAY)
    for pid in own_executors()[:1]:
        os.kill(pid, signal.SIGKILL)
        killed.append(pid)


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    spark = build_session(
        "lost-executors",
        "local-cluster[2,2,1536]",
        **{"spark.sql.shuffle.partitions": "8", "spark.executor.memory": "1g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name in NAMES:
        killed: list[int] = []
        killer = threading.Thread(target=kill_one, args=(killed,))
        killer.start()
        same, note = compare(spark, con, name, sf_dir)
        killer.join()
        failed += not same
        print("ok  " if same else "FAIL", name, f"executors killed: {len(killed)}", "" if same else note, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
