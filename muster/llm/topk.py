"""Exact top-k search for inner products by the threshold algorithm.

Rows are dealt to blocks of a bounded size, queries to groups; a block meets every group of queries in a task.
A block sorts its rows along each dimension. A query walks all lists from their better end at once (from the
top where its component is positive, else from the bottom), scores each row it meets for the first time, and
stops when no unseen row can reach its k-th score: the bound is the query's product with the values it stands
at. Queries of a group walk together, in steps that double. A block returns at most k rows a query, and the
best k of all blocks are kept.

Vectors are whole numbers and scores are exact: computed as doubles where those hold every score, else as 64-bit whole
numbers. Vectors whose scores might not fit 64 bits are refused.

Defined results: a null vector, or one with a null or non-finite component, takes no part, neither as query nor as
candidate. A shorter vector has zeros in the dimensions it lacks. Equal scores are ranked by the smaller id.
A query's own id is no candidate; rows given twice with one id count once, with the vector of smaller
components. An id that is null takes no part. Further columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, tasks_for

K = 5
BLOCK_ROWS = 1024
QUERY_ROWS = 4096
FIRST_STEP = 16


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, null if one is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")))


class Block:
    """Rows of a block with their order along each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors, axis=0, kind="stable")

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of the best k rows of each query."""
        n, found = len(self.ids), []
        walking = np.arange(len(queries))
        # Rows that a query has met have their score; the others count as less than any.
        least = -np.inf if queries.dtype == np.float64 else np.iinfo(np.int64).min
        scores = np.full((len(queries), n), least, queries.dtype)
        depth, step = 0, FIRST_STEP
        down = queries > 0
        while len(walking):
            reach = min(n, depth + step)
            meets = np.zeros((len(walking), n), bool)
            for dimension in range(self.vectors.shape[1]):
                falls = down[walking, dimension]
                meets[np.ix_(falls, self.order[n - reach : n - depth, dimension])] = True
                meets[np.ix_(~falls, self.order[depth:reach, dimension])] = True
            rows = np.flatnonzero(meets.any(axis=0))
            products = queries[walking] @ self.vectors[rows].T
            at = np.ix_(walking, rows)
            scores[at] = np.where(meets[:, rows], products, scores[at])
            own = np.searchsorted(self.ids, query_ids[walking])
            hit = (own < n) & (self.ids[np.minimum(own, n - 1)] == query_ids[walking])
            scores[walking[hit], own[hit]] = least
            depth, step = reach, step * 2
            if depth == n:
                found.append(walking)
                break
            at_top = np.take_along_axis(self.vectors, self.order[n - depth][None, :], 0)[0]
            at_bottom = np.take_along_axis(self.vectors, self.order[depth - 1][None, :], 0)[0]
            bound = (np.where(down[walking], at_top, at_bottom) * queries[walking]).sum(axis=1)
            kth = np.partition(scores[walking], max(n - k, 0), axis=1)[:, max(n - k, 0)]
            # A row that equals the k-th score may still have the smaller id.
            done = (bound < kth) & (kth > least)
            found.append(walking[done])
            walking = walking[~done]
        order = np.concatenate(found) if found else walking
        # Reversed before and after, so that of equal scores the smaller id, which stands first, stays first.
        best = scores.shape[1] - 1 - np.argsort(scores[order][:, ::-1], axis=1, kind="stable")[:, ::-1][:, :k]
        query = np.repeat(order, best.shape[1])
        row = best.ravel()
        score = scores[query, row]
        real = score > least
        return query[real], row[real], score[real]


def _matrix(vectors: pd.Series, dimensions: int, kind: type) -> np.ndarray:
    out = np.zeros((len(vectors), dimensions), kind)
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return out


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best rows for each query; both frames have ``id`` and ``vector``."""
    rows = _once(vectors)
    asked = _once(queries)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d"), _largest().alias("most")).first()
    asked_size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d"), _largest().alias("most")).first()
    dimensions = max(size["d"] or 0, asked_size["d"] or 0, 1)
    largest = dimensions * int(size["most"] or 0) * int(asked_size["most"] or 0)
    if largest >= 2**63:
        raise ValueError("scores of 64 bits or more cannot be held; scale the vectors down")
    kind = np.float64 if largest < 2**53 else np.int64
    blocks, groups = tasks_for(size["n"], block_rows), tasks_for(asked_size["n"], query_rows)
    each = F.sequence(F.lit(0), F.lit(groups - 1)), F.sequence(F.lit(0), F.lit(blocks - 1))
    met = rows.select(
        F.lit(False).alias("asks"), "id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.explode(each[0]).alias("group")
    ).unionByName(
        asked.select(
            F.lit(True).alias("asks"), "id", "vector", F.explode(each[1]).alias("block"), F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group")
        )
    )

    ship()

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = frame[~frame["asks"]], frame[frame["asks"]]
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        block = Block(mine["id"].to_numpy(np.int64), _matrix(mine["vector"], dimensions, kind))
        ids, asked_vectors = theirs["id"].to_numpy(np.int64), _matrix(theirs["vector"], dimensions, kind)
        query, row, score = block.top(ids, asked_vectors, k)
        return pd.DataFrame({"query_id": ids[query], "vec_id": block.ids[row], "score": score.astype(np.int64)})

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        met.groupBy("block", "group")
        .applyInPandas(search, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _once(vectors: DataFrame) -> DataFrame:
    return vectors.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))


def _largest() -> Column:
    return F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))
