import itertools

import numpy as np
from pyspark.sql import functions as F

from muster.llm import quality
from muster.llm.queries import QUERIES
from muster.llm.training import chosen

SF = "/root/testdata/sf0.01"
GOOD = "A calm line of words, with an end.\nAnother one that follows it quite well."
BAD = "BUY!! NOW!! | NOW!! ###\n$$$ BUY!! BUY!! BUY!!"


def model():
    texts = [f"{GOOD} {i}" for i in range(30)] + [f"{BAD} {i}" for i in range(30)]
    return quality.fit(texts, [1] * 30 + [0] * 30, steps=60)


def test_marginals_are_sums_over_all_paths():
    draw = np.random.default_rng(1)
    sizes = np.array([3, 1, 5])
    chains = quality.Chains(sizes)
    scores, steps = draw.normal(0, 1, (9, 2)), draw.normal(0, 1, (2, 2))
    forward, backward, total = chains.sums(scores, steps)
    for document, (start, size) in enumerate(zip(chains.starts, chains.sizes)):
        weights, good = 0.0, np.zeros(size)
        for path in itertools.product((0, 1), repeat=int(size)):
            value = np.exp(sum(scores[start + i, s] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
            weights += value
            good += value * np.array(path)
        assert abs(total[document] - np.log(weights)) < 1e-9
        lines = slice(start, start + size)
        assert np.allclose(np.exp(forward[lines, 1] + backward[lines, 1] - total[document]), good / weights)


def test_lines_are_judged():
    [(good, _), (bad, _), (mixed, lines)] = model().score([GOOD, BAD, "\n".join([GOOD] * 6 + [BAD] * 6)])
    assert good > 0.7 > 0.3 > bad and bad < mixed < good and len(lines) == 24
    assert lines[:12].mean() > lines[12:].mean()


def test_odd_texts():
    texts = [None, "", "\n\n", "x" * 200_000, "word " * 60_000, "line\n" * 20_000, "\x00\x85"]
    found = model().score(texts)
    assert [len(lines) for _, lines in found] == [1, 1, 3, 1, 1, 20_001, 1]
    assert all(0 <= score <= 1 for score, _ in found)
    assert found[0][0] == found[1][0]
    assert quality.fit([], []).score(["a\nb"])[0][0] == 0.5
    assert 0.5 < quality.fit(["a"] * 5, [1] * 5).score(["a"])[0][0] <= 1


def test_rows_and_columns(documents):
    frame = documents([(1, GOOD), (1, GOOD), (None, None), (2, BAD)])
    rows = frame.select("*", quality.score_quality(F.col("text"), model()).alias("found")).collect()
    assert len(rows) == 4 and len({row["found"]["score"] for row in rows if row["doc_id"] == 1}) == 1
    assert documents([]).select(quality.score_quality(F.col("text"), model())).collect() == []


def test_sample_is_bounded_and_weighted(spark):
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(4000)] + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    rows = chosen(labels, 400, "doc_id", "quality", "x").collect()
    good = [row for row in rows if row["label"] == 1]
    assert 300 < len(rows) < 500 and 150 < len(good) < 260
    assert abs(sum(r["weight"] for r in good) / sum(r["weight"] for r in rows) - 0.9) < 0.05
    assert not chosen(labels.limit(0), 400, "doc_id", "quality", "x").collect()


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op10_quality"](spark, SF).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert len(rows) > 60
    assert sum(row["predicted"] == row["quality"] for row in rows) / len(rows) > 0.93
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7) for row in rows)
