"""Toxicity as a severity grade, by cumulative-link ordinal regression on sparse word counts.

The probability that a text's grade is at least k is a logistic function of one weighted sum over its words, less
the k-th threshold. All thresholds share the weights and stand in order, and the expected severity is the sum of
these probabilities.

Labels only say whether a document is toxic. Grade 0 is a document that is not; a toxic one has grade 1, or 2
if it holds more words with terms that tell toxic documents from others than the median of them.

A word has as terms itself and its beginnings, so that inflected forms share weights. The model is fitted on about
``train_documents`` labelled documents, chosen by a hash of their id, as many toxic as others. All terms whose share in
the two kinds of documents differs significantly become features; Spark counts them, and the driver gets these terms and the
features of the documents, but no text. Documents are weighted as the two kinds are among all labels. Every document is
scored by all its words.

Defined results: a null or empty text has the severity of a text without any such word. Without training
documents, or with one label only, no word counts. Rows given twice are scored alike; further columns are not touched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .training import Adam, chosen, labelled_texts

TRAIN_DOCUMENTS = 8000
#: Lengths of the beginnings of words that are terms.
BEGINNINGS = (3, 4, 5, 6)
#: Words whose features a task keeps at a time; beyond that it starts afresh.
CACHED_WORDS = 200_000
#: Least documents with a term, and least standard deviations between its shares.
LEAST_DOCUMENTS = 3
LEAST_DEVIATIONS = 3.5
GRADES = 3
#: A text counts as toxic from this probability of grade 1 or more.
THRESHOLD = 0.2
STEPS = 400

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, which end in a star."""
    return [word, *(word[:size] + "*" for size in BEGINNINGS if size <= len(word))]


class Features(dict):
    """The features of each word, filled as words come up."""

    def __init__(self, terms: list[str]):
        self.place = {term: at for at, term in enumerate(terms)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHED_WORDS:
            self.clear()
        found = self[word] = tuple(self.place[term] for term in terms_of(word) if term in self.place)
        return found

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the features that a text has."""
        counts = Counter(chain.from_iterable(map(self.__getitem__, words_of(text))))
        places = np.fromiter(counts.keys(), np.int64, len(counts))
        return places, np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))


class Model:
    """Weights of terms and the thresholds between grades."""

    def __init__(self, terms: list[str], weights: np.ndarray, thresholds: np.ndarray):
        self.terms, self.weights, self.thresholds = terms, weights, thresholds

    def score(self, text: str | None, features: Features) -> np.ndarray:
        """The probabilities of grade 1 or more, 2 or more, and so on."""
        places, values = features.of(text)
        return _logistic(self.weights[places] @ values - self.thresholds)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def fit(
    terms: list[str],
    texts: list[str | None],
    grades: np.ndarray,
    grade_count: int = GRADES,
    document_weights: list[float] | None = None,
    steps: int = STEPS,
) -> Model:
    """As ``fit_features``, for texts."""
    features = Features(terms)
    return fit_features(terms, [features.of(text) for text in texts], grades, grade_count, document_weights, steps)


def fit_features(
    terms: list[str],
    found: list[tuple[np.ndarray, np.ndarray]],
    grades: np.ndarray,
    grade_count: int = GRADES,
    document_weights: list[float] | None = None,
    steps: int = STEPS,
) -> Model:
    """The most likely weights and thresholds for documents given by places and values of their features, with a prior around zero."""
    row = np.repeat(np.arange(len(found)), [len(places) for places, _ in found])
    column = np.concatenate([places for places, _ in found]) if found else np.zeros(0, np.int64)
    value = np.concatenate([values for _, values in found]) if found else np.zeros(0)
    weights, first, gaps = np.zeros(len(terms)), 0.0, np.zeros(max(grade_count - 2, 0))
    point, adam = np.r_[weights, first, gaps], Adam(0.05)
    shares = np.ones(len(found)) if document_weights is None else np.array(document_weights)
    shares = shares / max(shares.sum(), 1e-9)
    for _ in range(steps if len(found) else 0):
        weights, thresholds = point[: len(terms)], _thresholds(point[len(terms) :])
        score = np.bincount(row, weights[column] * value, len(found))
        at_least = _logistic(score[:, None] - thresholds[None])
        # P(grade) is the difference of two neighbouring probabilities; the outer ones are 1 and 0.
        framed = np.concatenate([np.ones((len(found), 1)), at_least, np.zeros((len(found), 1))], axis=1)
        slopes = framed * (1 - framed)
        pick = np.arange(len(found))
        probability = np.maximum(framed[pick, grades] - framed[pick, grades + 1], 1e-9)
        lower, upper = slopes[pick, grades] / probability, slopes[pick, grades + 1] / probability
        by_score = -(lower - upper) * shares
        by_threshold = np.zeros(len(thresholds) + 2)
        np.add.at(by_threshold, grades, lower * shares)
        np.add.at(by_threshold, grades + 1, -upper * shares)
        by_threshold = by_threshold[1:-1]
        # Later thresholds contain all gaps before them.
        tail = np.cumsum(by_threshold[::-1])[::-1]
        slope = np.r_[
            np.bincount(column, by_score[row] * value, len(terms)) + 1e-4 * weights,
            tail[0],
            tail[1:] * np.exp(point[len(terms) + 1 :]),
        ]
        point = point + adam.move(slope)
    return Model(terms, point[: len(terms)], _thresholds(point[len(terms) :]))


def _thresholds(point: np.ndarray) -> np.ndarray:
    """The first one as it is, each later one above the one before by the exponential of its gap."""
    return point[0] + np.r_[0.0, np.cumsum(np.exp(point[1:]))]


def train(
    documents: DataFrame,
    labels: DataFrame,
    train_documents: int = TRAIN_DOCUMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    """Fit on about ``train_documents`` of the documents that ``labels`` marks."""
    sample = chosen(labels, train_documents, id_column, label_column, "toxic")
    texts = written(labelled_texts(documents, sample, id_column, text_column), "sample")
    telling = telling_terms(texts)
    terms, marked = [term for term, _ in telling], {term for term, deviation in telling if deviation > 0}
    ship()

    @F.arrow_udf("struct<places:array<int>, values:array<double>, marked:int>")
    def featured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        every, toxic = Features(terms), Features(sorted(marked))
        for batch in batches:
            found, words = [], []
            for value in batch:
                found.append(every.of(value.as_py()))
                words.append(sum(bool(toxic[word]) for word in words_of(value.as_py())))
            columns = [
                pa.array([places for places, _ in found], pa.list_(pa.int32())),
                pa.array([values for _, values in found], pa.list_(pa.float64())),
                pa.array(words, pa.int32()),
            ]
            yield pa.StructArray.from_arrays(columns, ["places", "values", "marked"])

    rows = texts.select("id", "label", "weight", featured("text").alias("f")).orderBy("id").collect()
    kind = np.array([row["label"] for row in rows], np.int64)
    marked_words = np.array([row["f"]["marked"] for row in rows])
    grades = np.where(kind > 0, 1, 0)
    if grades.any():
        grades[(kind > 0) & (marked_words > np.median(marked_words[kind > 0]))] = 2
    found = [(np.array(row["f"]["places"], np.int64), np.array(row["f"]["values"], np.float64)) for row in rows]
    return fit_features(terms, found, grades, GRADES, [row["weight"] for row in rows])


def telling_terms(texts: DataFrame) -> list[tuple[str, float]]:
    """Terms whose share of documents differs between the two kinds, with the difference in standard deviations.

    ``texts`` has ``text`` and ``label``. Spark counts the documents of each kind that have a term.
    """
    ship()

    @F.arrow_udf("array<string>")
    def terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [set(chain.from_iterable(map(terms_of, set(words_of(value.as_py()))))) for value in batch]
            yield pa.array([sorted(found) for found in sets], pa.list_(pa.string()))

    toxic = F.col("label") > 0
    sizes = texts.agg(F.count_if(~toxic).alias("clean"), F.count_if(toxic).alias("bad")).first()
    clean_size, bad_size = max(sizes["clean"], 1), max(sizes["bad"], 1)
    counts = (
        texts.select("label", F.explode(terms("text")).alias("term"))
        .groupBy("term")
        .agg(F.count_if(~toxic).alias("clean"), F.count_if(toxic).alias("bad"))
        .where(F.col("clean") + F.col("bad") >= LEAST_DOCUMENTS)
    )
    share = (F.col("clean") + F.col("bad") + 1) / (clean_size + bad_size + 2)
    spread = F.sqrt(share * (1 - share) * (1 / clean_size + 1 / bad_size))
    deviation = (F.col("bad") / bad_size - F.col("clean") / clean_size) / spread
    found = counts.select("term", deviation.alias("deviation")).where(F.abs("deviation") >= LEAST_DEVIATIONS).collect()
    return sorted(((row["term"], row["deviation"]) for row in found), key=lambda item: (-abs(item[1]), item[0]))


TOXICITY_TYPE = "struct<severity:double, at_least:array<double>>"


def score_toxicity(text: Column, model: Model) -> Column:
    """A struct of the expected ``severity`` and the probabilities of grade 1 or more, 2 or more, and so on."""
    kind = pa.struct([("severity", pa.float64()), ("at_least", pa.list_(pa.float64()))])

    ship()

    @F.arrow_udf(TOXICITY_TYPE)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(model.terms)
        for batch in batches:
            out = [model.score(text.as_py(), features) for text in batch]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([float(p.sum()) for p in out], pa.float64()),
                    pa.array([p.tolist() for p in out], pa.list_(pa.float64())),
                ],
                fields=list(kind),
            )

    return scored(text)
