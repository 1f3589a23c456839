"""Run every query and its SQL and compare rows: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from muster.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    got = QUERIES[name](spark, sf_dir)
    got_rows = normal_rows(got.columns, got.collect())
    want = con.execute(ORACLE[name])
    want_columns = [d[0] for d in want.description]
    want_types = dict(zip(want_columns, (str(d[1]) for d in want.description)))
    want_rows = normal_rows(want_columns, want.fetchall())
    types = {c: (t, want_types.get(c)) for c, t in got.dtypes}
    if sorted(got.columns) != sorted(want_columns):
        return False, f"columns {sorted(got.columns)} / {sorted(want_columns)}"
    if len(got_rows) != len(want_rows):
        return False, f"rows {len(got_rows)} / {len(want_rows)}"
    odd = [(a, b) for a, b in zip(got_rows, want_rows) if a != b]
    if odd:
        return False, f"{len(odd)} rows differ, first {repr(odd[0])[:600]}"
    return True, f"{len(got_rows)} rows {types}"


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = build_session(
        "compare", f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{"spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        began = time.time()
        try:
            same, note = compare(spark, con, name, sf_dir)
        except Exception:
            same, note = False, traceback.format_exc()[-1500:]
        failed += not same
        print("ok  " if same else "FAIL", name, f"{time.time() - began:.2f}s", note, flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
