import hashlib
import math
import random

import pytest
from checks.compare import connect, normal_rows
from pyspark.sql import functions as F

from muster.llm import centroids
from muster.llm.oracle import ORACLE
from muster.llm.queries import QUERIES


def plain(rows, width, clusters=8, rounds=10):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) of each vector, by plain loops."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == width and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(1024 * x) for x in vector]))
    named = [(vec_id is None, hashlib.sha256(f"3:{vec_id}".encode()).hexdigest() if vec_id is not None else "", v) for vec_id, v in kept]
    centres = [v for _, _, v in sorted(named)[:clusters]]

    def near(vector):
        return min((sum((x - c) ** 2 for x, c in zip(vector, centre)), k) for k, centre in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, vector in kept:
            groups.setdefault(near(vector)[1], []).append(vector)
        for k, group in groups.items():
            centres[k] = [sum(column) // len(group) for column in zip(*group)]
    found = [(vec_id, *near(vector)[::-1]) for vec_id, vector in kept]
    sums = {}
    for _, k, d in found:
        sums[k] = sums.get(k, 0) + d
    digests = [hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest() for centre in centres]
    return sorted(((i, k, d, sums[k], sum(sums.values()), digests[k]) for i, k, d in found), key=repr)


def got(spark, rows, width, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    frame = frame.withColumns({name: F.lit("x") for name in ("cluster", "distance", "vector", "near")})
    vectors = frame.select("vec_id", centroids.quantised(F.col("embedding"), components=width).alias("vector"))
    found = centroids.with_inertia(*centroids.cluster(vectors, **options))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(row) for row in found.collect()), key=repr)


def test_equals_plain_loops(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(i % 5, 0.4) - 2 for _ in range(4)]) for i in range(400)]
    assert got(spark, rows, 4) == plain(rows, 4)
    assert got(spark, rows, 4, clusters=3, rounds=2) == plain(rows, 4, 3, 2)


def test_one_vector_a_third_of_all(spark):
    draw = random.Random(4)
    rows = [(i, [0.5, -0.25]) for i in range(200)] + [(i, [draw.random(), -draw.random()]) for i in range(200, 600)]
    assert got(spark, rows, 2) == plain(rows, 2)


def test_odd_rows(spark):
    odd = [None, [], [1.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, -float("inf")], [1.0, 2.0, 3.0]]
    rows = list(enumerate(odd)) + [(20, [0.5, -0.5]), (20, [0.5, -0.5]), (20, [-0.001, 0.001]), (None, [0.25, 0.25]), (None, [9.0, 9.0])]
    rows += [(i, [i / 7, -i / 3]) for i in range(30, 45)]
    assert got(spark, rows, 2) == plain(rows, 2)
    assert got(spark, rows, 2, clusters=30) == plain(rows, 2, 30)


def test_few_rows(spark):
    assert got(spark, [], 2) == []
    assert got(spark, [(1, None)], 2) == []
    assert got(spark, [(1, [0.1, 0.2]), (2, [0.1, 0.2])], 2) == plain([(1, [0.1, 0.2]), (2, [0.1, 0.2])], 2)


def test_large_components(spark):
    rows = [(i, [(-1) ** i * 2.0**45 + i * 1000, i / 3]) for i in range(40)]
    assert got(spark, rows, 2) == plain(rows, 2)
    near = [(i, [1.0e5 * i, -1.0e5]) for i in range(40)]
    assert got(spark, near, 2) == plain(near, 2)
    for large in ([1e300, 0.0], [2.0**50, 0.0]):
        with pytest.raises(Exception, match="larger than"):
            got(spark, [(1, large)], 2)
    with pytest.raises(Exception, match="64 bits"):
        got(spark, [(i, [2.0**30 * i, 0.0]) for i in range(300)], 2)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    frame = QUERIES["op13_centroid_clustering"](spark, folder)
    want = connect(folder).execute(ORACLE["op13_centroid_clustering"])
    columns = [d[0] for d in want.description]
    assert normal_rows(frame.columns, frame.collect()) == normal_rows(columns, want.fetchall())
    types = dict(zip(columns, (str(d[1]) for d in want.description)))
    assert (types["cluster"], types["distance"], types["inertia"]) == ("INTEGER", "BIGINT", "BIGINT")


def test_no_python_in_the_plan(spark):
    rows = spark.createDataFrame([(1, [0.5] * 64)], "vec_id long, embedding array<float>")
    vectors = rows.select("vec_id", centroids.quantised(F.col("embedding")).alias("vector"))
    found = vectors.select(centroids.nearest(F.col("vector"), [[0] * 64, [1] * 64]))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "zip_with" in plan and "array_min" in plan
