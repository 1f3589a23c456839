import pyarrow as pa
from pyspark.sql import functions as F

from muster.llm import training


def test_some_of_every_label(spark):
    """The frequent label's share of the sample is less than one in two million."""
    labels = spark.range(2_100_000).select(F.col("id").alias("doc_id"), (F.col("id") < 3).cast("int").alias("quality"))
    rows = training.chosen(labels, 2, "doc_id", "quality", "quality").collect()
    assert {row["label"] for row in rows} == {0, 1}


def test_shares_are_not_rounded():
    """A share of 1.4 millionths stays one."""
    cut = training.hash_cuts({0: 1_000_000_000, 1: 10}, 2800)
    assert cut[0] + 2**63 + 1 == 2**64 * 14 // 10_000_000 and cut[1] == 2**63 - 1


def test_portions_are_bounded_by_length():
    texts = ["a" * 5, None, "b" * 20, "", "c" * 3, "d" * 3, "e" * 30]
    parts = list(training.portions(pa.array(texts, pa.string()), 10))
    assert [text for part in parts for text in part] == texts
    assert all(len(part) == 1 or sum(len(text or "") for text in part) <= 10 for part in parts)
    assert [len(part) for part in training.portions(pa.array(["x"] * 7), 100, most=3)] == [3, 3, 1]
    assert list(training.portions(pa.array([], pa.string()), 10)) == []
