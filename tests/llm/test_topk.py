import math
import random

import pytest
from checks.compare import connect, normal_rows
from pyspark.sql import functions as F

from muster.llm import topk
from muster.llm.oracle import ORACLE
from muster.llm.queries import QUERIES


def plain(rows, k):
    sound = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            whole = [math.floor(256 * x) for x in vector]
            sound[vec_id] = min(sound.get(vec_id, whole), whole)
    out = []
    for q in sound:
        if q % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(sound[q], v)), c) for c, v in sound.items() if c != q]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def got(spark, rows, k=5, **blocks):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = frame.select(F.col("vec_id").alias("id"), topk.quantised(F.col("embedding")).alias("vector"))
    return sorted(tuple(row) for row in topk.top_k(found, found.where("id % 50 = 0"), k, **blocks).collect())


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 20, "query_rows": 2}])
def test_equals_all_scores(spark, blocks):
    draw = random.Random(7)
    rows = [(i * 10, [draw.gauss(0, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(10_000 + i, rows[i % 3][1]) for i in range(12)]
    assert got(spark, rows, **blocks) == plain(rows, 5)


def test_odd_rows(spark):
    rows = [(0, [0.5, -0.5]), (50, None), (100, [None, 1.0]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0])]
    rows += [(1, [0.5]), (2, [0.5, -0.5, 9.0]), (2, [0.5, -0.5, 9.0]), (None, [1.0, 1.0]), (250, []), (3, [0.0, 0.0])]
    assert got(spark, rows) == plain(rows, 5)
    assert got(spark, rows, 1) == plain(rows, 1)


def test_few_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_scores_too_large_to_hold(spark):
    with pytest.raises(ValueError):
        got(spark, [(0, [1e12]), (1, [1e12])])


def test_scores_that_doubles_do_not_hold(spark):
    """Scores of 54 to 62 bits that differ in their last bits only."""
    draw = random.Random(8)
    for size in (2.0**20, 2.0**22):
        rows = [(i, [draw.choice([size, size - 1, -size]) + draw.randrange(4) / 256 for _ in range(5)]) for i in range(120)]
        want = plain(rows, 5)
        assert got(spark, rows) == want and max(abs(row[3]) for row in want) > 2**53
        assert got(spark, rows, block_rows=16, query_rows=2) == want


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    frame = QUERIES["op7_exact_topk"](spark, sf)
    want = connect(sf).execute(ORACLE["op7_exact_topk"])
    columns = [d[0] for d in want.description]
    assert normal_rows(frame.columns, frame.collect()) == normal_rows(columns, want.fetchall())
