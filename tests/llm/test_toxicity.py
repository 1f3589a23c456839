import numpy as np
from pyspark.sql import functions as F

from muster.llm import toxicity
from muster.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def numeric_slope(loss, point, step=1e-5):
    return np.array([(loss(point + step * e) - loss(point - step * e)) / (2 * step) for e in np.eye(len(point))])


def test_fit_is_the_most_likely():
    draw = np.random.default_rng(1)
    terms = ["bad", "awful", "nice"]
    texts, grades = [], []
    for _ in range(300):
        counts = draw.integers(0, 4, 3)
        score = np.log1p(counts) @ [2.0, 3.0, -1.0] + draw.logistic(0, 1)
        texts.append(" ".join(word for word, n in zip(terms, counts) for _ in range(n)))
        grades.append(int(score > 1.0) + int(score > 3.0))
    grades = np.array(grades)
    model = toxicity.fit(terms, texts, grades, 3, steps=3000)
    features = toxicity.Features(terms)
    x = np.array([np.bincount(p, v, 3) if len(p) else np.zeros(3) for p, v in (features.of(text) for text in texts)])

    def loss(point):
        at_least = 1 / (1 + np.exp(-(x @ point[:3])[:, None] + point[3:][None]))
        framed = np.c_[np.ones(len(x)), at_least, np.zeros(len(x))]
        pick = np.arange(len(x))
        return -np.log(framed[pick, grades] - framed[pick, grades + 1]).mean() + 0.5e-4 * (point[:3] ** 2).sum()

    slope = numeric_slope(loss, np.r_[model.weights, model.thresholds])
    assert np.abs(slope).max() < 5e-3
    assert (np.diff(model.thresholds) > 0).all()


def model():
    return toxicity.Model(["scum", "idi*"], np.array([3.0, 2.0]), np.array([1.0, 3.0]))


def test_scores():
    found, features = model(), toxicity.Features(model().terms)
    clean, mild, severe = (found.score(t, features).sum() for t in ("a b", "Idiotic", "scum SCUM idiots"))
    assert clean < mild < severe <= 2
    assert (found.score(None, features) == found.score("", features)).all()
    assert 0 <= found.score("scum " * 200_000, features).sum() <= 2


def test_rows_and_columns(documents):
    frame = documents([(1, "scum"), (1, "scum"), (None, None), (2, "")])
    rows = frame.select("*", toxicity.score_toxicity(F.col("text"), model()).alias("found")).collect()
    assert len(rows) == 4 and all(len(row["found"]["at_least"]) == 2 for row in rows)
    assert documents([]).select(toxicity.score_toxicity(F.col("text"), model())).collect() == []


def test_training_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(documents([(1, "a")]), none).terms == []
    one = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.train(documents([(1, "a"), (1, "a"), (2, None)]), one)
    assert found.score("a", toxicity.Features(found.terms))[0] > 0.5


def test_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op9_toxicity"](spark, SF).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    toxic, clean = ([row["predicted"] for row in rows if row["toxic"] == t] for t in (1, 0))
    assert len(toxic) > 80 and np.mean(toxic) > 0.9 and np.mean(clean) < 0.02
    assert all(0 <= row["severity"] <= 2 for row in rows)
