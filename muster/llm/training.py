"""Choosing bounded samples of labelled documents, and a small optimiser."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_cuts(sizes: dict, most: int) -> dict:
    """Up to which signed 64-bit hash the rows of each label are drawn, for about as many of each and ``most`` in all."""
    return {label: min(1 << 64, (int(most) << 64) // (len(sizes) * n)) - (1 << 63) - 1 for label, n in sizes.items()}


def chosen(labels: DataFrame, most: int, id_column: str, label_column: str, name: str) -> DataFrame:
    """About ``most`` labelled ids by a hash of the id, as many of each label if there are: ``id``, ``label``, ``weight``.

    The weight makes up for that: it is the share of the label among all labelled ids over its share in the sample.
    The id with the smallest hash of a label is always taken, so that no label goes without.

    An id with several labels has the smallest one; labels and ids that are null take no part.
    """
    known = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IS NOT NULL")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    drawn = F.xxhash64(F.lit(name), "id")
    found = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min(drawn).alias("least")).collect()
    sizes = {row["label"]: row["n"] for row in found}
    cuts = hash_cuts(sizes, most)
    taken: Column = F.lit(False)
    weight: Column = F.lit(1.0)
    taken_of = {label: min(n, max(1.0, most / len(sizes))) for label, n in sizes.items()}
    for label, n, least in sorted(found):
        true_share, sample_share = n / sum(sizes.values()), taken_of[label] / sum(taken_of.values())
        weight = F.when(F.col("label") == label, true_share / sample_share).otherwise(weight)
        taken |= (F.col("label") == label) & (drawn <= max(cuts[label], least))
    return known.where(taken).withColumn("weight", weight)


def labelled_texts(documents: DataFrame, sample: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``text`` and the columns of the sample, which is small by its making."""
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return texts.join(F.broadcast(sample), "id").dropDuplicates(["id"])


def portions(texts: pa.Array, characters: int, most: int = 1000) -> Iterator[list[str | None]]:
    """The texts of a batch in portions of bounded length, at least one text each."""
    part, size = [], 0
    for value in texts:
        text = value.as_py()
        length = len(text or "")
        if part and (size + length > characters or len(part) == most):
            yield part
            part, size = [], 0
        part.append(text)
        size += length
    if part:
        yield part


class Adam:
    """Step sizes by running means of the gradient and its square."""

    def __init__(self, rate: float):
        self.rate, self.step, self.mean, self.square = rate, 0, 0.0, 0.0

    def move(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.99 * self.square + 0.01 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.99**self.step)
        return -self.rate * mean / (np.sqrt(square) + 1e-8)
