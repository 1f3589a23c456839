"""Clustering of vectors of whole numbers around centroids, with column expressions only.

Each round assigns every vector to the nearest centroid and then moves each centroid to the exact mean of its vectors,
rounded down. The centroids are literals: for each one, ``zip_with`` and ``aggregate`` give the squared distance of
a vector, and ``array_min`` over structs of distance and number picks the cluster, so ties go to the smaller number.
A round is one pass over the vectors with one sum per component and cluster. It is added up in the tasks before it
is shuffled, so one row per cluster and task moves however uneven the clusters are, and one row per cluster (a bounded
number) comes to the driver. The vectors are written once and each round reads them from there, so no round depends
on the executors of another.

Whole numbers are exact throughout. Distances are 64-bit numbers as long as no component is beyond 2^27 in size; where one
is, which a pass over the vectors tells, they are decimals of 38 digits and only the distance to the nearest centroid has
to fit 64 bits. Sums are decimals. A component beyond 2^59 or a nearest distance beyond 64 bits fails the job.

Defined results: vectors that are null, of another length, or hold a component that is null or not finite are left
out. Rows that share an id are vectors of their own, and a row without an id is one as well; it comes last as a
starting centroid. Of starting centroids with equal hashes the smaller vector comes first. Fewer vectors than
centroids give as many centroids as there are vectors; no vectors give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import removed, written

COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Components up to this size have distances of 64 bits over 64 components; up to the other one, of 38 digits.
NARROW, LARGEST = 1 << 27, 1 << 59


def quantised(vector: Column, scale: int = SCALE, components: int = COMPONENTS) -> Column:
    """The vector as whole numbers floor(scale * x); null if it takes no part."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double") * scale) <= F.lit(float(LARGEST)))
    large = F.raise_error(F.lit(f"a component is larger than {LARGEST}")).cast("array<bigint>")
    return F.when((F.size(vector) == components) & finite, F.when(fits, whole).otherwise(large))


def starting_order(vec_id: Column) -> Column:
    """What the first centroids are the smallest of: the hexadecimal sha256 of ``3:<id>``."""
    return F.sha2(F.concat(F.lit("3:"), vec_id.cast("string")), 256)


def distance(vector: Column, centroid: Sequence[int], wide: bool = False) -> Column:
    """Squared Euclidean distance to a centroid, as a 64-bit number or, if ``wide``, a decimal."""
    kind = "decimal(19,0)" if wide else "bigint"
    total = "decimal(38,0)" if wide else "bigint"
    point = F.array(*[F.lit(x).cast("bigint") for x in centroid])
    squares = F.zip_with(vector, point, lambda x, c: ((x - c).cast(kind) * (x - c).cast(kind)).cast(total))
    return F.aggregate(squares, F.lit(0).cast(total), lambda sum_, square: (sum_ + square).cast(total))


def nearest(vector: Column, centroids: Sequence[Sequence[int]], wide: bool = False) -> Column:
    """A struct of the ``distance`` to the nearest centroid and its number, ``cluster``."""
    found = [
        F.struct(distance(vector, centroid, wide).alias("distance"), F.lit(i).alias("cluster"))
        for i, centroid in enumerate(centroids)
    ]
    return F.array_min(F.array(*found))


def is_wide(vectors: DataFrame) -> bool:
    """Whether a component is so large that 64 bits may not hold a distance."""
    sizes = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    return (vectors.agg(F.max(sizes)).first()[0] or 0) > NARROW


def moved(vectors: DataFrame, centroids: list[tuple[int, ...]], wide: bool = False) -> list[tuple[int, ...]]:
    """The centroids after one round; one without vectors stays."""
    width = len(centroids[0])
    assigned = vectors.select("vector", nearest(F.col("vector"), centroids, wide)["cluster"].alias("cluster"))
    sums = [F.sum(F.col("vector")[i].cast("decimal(19,0)")).alias(f"s{i}") for i in range(width)]
    out = list(centroids)
    for row in assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[row["cluster"]] = tuple(int(row[f"s{i}"]) // row["n"] for i in range(width))
    return out


def cluster(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "vector", clusters: int = CLUSTERS, rounds: int = ROUNDS
) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """Vectors with ``cluster`` and ``distance``, and the final centroids.

    ``rows`` has an id and a vector of whole numbers, null where a row takes no part; all vectors are of one length.
    """
    vectors = rows.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector")).where("vector IS NOT NULL")
    vectors = written(vectors, "vectors")
    first = vectors.orderBy(starting_order(F.col("vec_id")).asc_nulls_last(), "vector").limit(clusters).collect()
    centroids = [tuple(row["vector"]) for row in first]
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    wide = is_wide(vectors)
    for _ in range(rounds):
        centroids = moved(vectors, centroids, wide)
    found = vectors.select("vec_id", nearest(F.col("vector"), centroids, wide).alias("near"))
    far = F.raise_error(F.lit("a distance does not fit 64 bits")).cast("bigint")
    near = F.when(F.col("near.distance") < F.lit(str(1 << 63)).cast("decimal(38,0)"), F.col("near.distance").cast("bigint")).otherwise(far)
    assigned = written(found.select("vec_id", "near.cluster", (near if wide else F.col("near.distance")).alias("distance")), "clusters")
    removed(vectors)
    return assigned, centroids


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: Sequence[Sequence[int]]) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256``: one row per cluster, held as literals."""
    total = F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")
    of = {row["cluster"]: int(row["total"]) for row in assigned.groupBy("cluster").agg(total).collect()}
    inertias = F.array(*[F.lit(of.get(i, 0)).cast("bigint") for i in range(len(centroids))]).cast("array<bigint>")
    digests = F.array(*[F.lit(centroid_digest(centroid)) for centroid in centroids]).cast("array<string>")
    return assigned.select(
        "*",
        F.get(inertias, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(of.values())).cast("bigint").alias("inertia"),
        F.get(digests, F.col("cluster")).alias("centroid_sha256"),
    )
