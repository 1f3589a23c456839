"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its shape (letter case, digits, symbols, repeated words, lengths and more) is
measured and cut into bins; the bins of the line itself and of its two neighbours have weights, and so has each
step from a line to the next. Forward and backward sums give each line's probability of being good; their mean,
weighted by the lines' lengths, is the document's quality.

Labels are those of documents: in training all lines of a document have its label. The model is fitted on about
``train_documents`` labelled documents, chosen by a hash of their id; every document is scored by all its lines.

Defined results: a null or empty text is one empty line, and every line weighs at least 1. Without training
documents everything has quality 0.5; with one label only, a constant near it. Rows given twice are scored alike;
further columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .training import Adam, chosen, labelled_texts, portions

TRAIN_DOCUMENTS = 4000
THRESHOLD = 0.7
BINS = 8
STEPS = 200
#: Characters of the texts that are scored side by side, unless one text has more.
SCORED_CHARACTERS = 4_000_000

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGITS = bytes(range(0x30, 0x3A))
_HIGH = bytes(range(0x80, 0x100))
_SYMBOLS = b"#$%&*@^~=<>{}[]\\/_+|"
FEATURES = 15


def _count(line: bytes, kind: bytes) -> int:
    return len(line) - len(line.translate(None, kind))


def line_shapes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Measures of each line (rows) and the lines' lengths in code points."""
    lines = (text or "").split("\n")
    seen: set[bytes] = set()
    shapes = np.empty((len(lines), FEATURES), np.float32)
    for row, line in enumerate(lines):
        raw = line.encode()
        size, words = len(raw), raw.split()
        upper, high = _count(raw, _UPPER), _count(raw, _HIGH)
        letters = upper + high + _count(raw, _LOWER)
        n = max(len(words), 1)
        shapes[row] = (
            np.log1p(size),
            np.log1p(len(words)),
            upper / max(letters, 1),
            letters / max(size, 1),
            _count(raw, _DIGITS) / max(size, 1),
            _count(raw, _SYMBOLS) / n,
            raw.count(b"!") / n,
            raw.count(b"|") / n,
            (raw.count(b".") + raw.count(b"?")) / n,
            raw.count(b",") / n,
            size / n,
            len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n,
            raw.rstrip()[-1:] in (b".", b"!", b"?", b":"),
            raw in seen,
        )
        seen.add(raw)
    return shapes, np.fromiter((max(len(line), 1) for line in lines), np.float64, len(lines))


class Chains:
    """Documents' lines end to end, the longest document first, so that all documents advance together."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]].astype(np.int64)
        longest = int(self.sizes[0]) if len(sizes) else 0
        self.running = np.searchsorted(-self.sizes, -np.arange(longest), side="left")

    def sums(self, scores: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log sums (lines by 2 states), and each document's total."""
        forward, backward = scores.copy(), np.zeros_like(scores)
        for at in range(1, len(self.running)):
            here = self.starts[: self.running[at]] + at
            forward[here] += _log_sum(forward[here - 1][:, :, None] + steps[None])
        for at in range(len(self.running) - 1, 0, -1):
            here = self.starts[: self.running[at]] + at
            backward[here - 1] = _log_sum((backward[here] + scores[here])[:, :, None] + steps.T[None])
        last = self.starts + self.sizes - 1
        total = np.logaddexp(forward[last, 0], forward[last, 1])
        return forward, backward, total


def _log_sum(values: np.ndarray) -> np.ndarray:
    return np.logaddexp(values[:, 0], values[:, 1])


class Model:
    """Bins of the measures, weights of the bins for "good", and weights of the steps between states."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float, steps: np.ndarray):
        self.edges, self.weights, self.bias, self.steps = edges, weights, bias, steps

    def good_scores(self, bins: np.ndarray) -> np.ndarray:
        return self.bias + _gathered(self.weights, bins)

    def score(self, texts: list[str | None]) -> list[tuple[float, np.ndarray]]:
        """Quality of each text and the probability of each line to be good."""
        shapes = [line_shapes(text) for text in texts]
        chains = Chains(np.array([len(lengths) for _, lengths in shapes]))
        bins = np.concatenate([with_neighbours(binned(shapes[at][0], self.edges)) for at in chains.order])
        good = self.good_scores(bins)
        scores = np.stack([np.zeros_like(good), good], axis=1)
        forward, backward, total = chains.sums(scores, self.steps)
        marginal = np.exp(forward[:, 1] + backward[:, 1] - np.repeat(total, chains.sizes))
        out: list = [None] * len(texts)
        for at, start, size in zip(chains.order, chains.starts, chains.sizes):
            lines = np.clip(marginal[start : start + size], 0.0, 1.0)
            weights = shapes[at][1]
            out[at] = (float((lines * weights).sum() / weights.sum()), lines)
        return out


def binned(shapes: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(edge, shapes[:, at], side="right") for at, edge in enumerate(edges)], axis=1)


def with_neighbours(bins: np.ndarray) -> np.ndarray:
    """Bins of the line, the one before and the one after; a line that is not there has a bin of its own."""
    none = np.full((1, bins.shape[1]), BINS)
    return np.stack([bins, np.concatenate([none, bins[:-1]]), np.concatenate([bins[1:], none])], axis=1)


def _gathered(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """``weights``: neighbour by measure by bin. The sum of the weights that each line's bins pick."""
    return np.take_along_axis(weights[None], bins[..., None], axis=3)[..., 0].sum(axis=(1, 2))


def fit(
    texts: list[str | None], labels: list[int], weights: list[float] | None = None, steps: int = STEPS
) -> Model:
    """As ``fit_shapes``, for texts."""
    return fit_shapes([line_shapes(text)[0] for text in texts], labels, weights, steps)


def fit_shapes(
    shapes: list[np.ndarray], labels: list[int], weights: list[float] | None = None, steps: int = STEPS
) -> Model:
    """Weights of the most likely chain model for documents given by the measures of their lines, with a prior around zero."""
    if not shapes:
        flat = [np.zeros(0) for _ in range(FEATURES)]
        return Model(flat, np.zeros((3, FEATURES, BINS + 1)), 0.0, np.zeros((2, 2)))
    every = np.concatenate(shapes)
    edges = [np.unique(np.quantile(every[:, at], np.linspace(0, 1, BINS + 1)[1:-1])) for at in range(FEATURES)]
    chains = Chains(np.array([len(shape) for shape in shapes]))
    bins = np.concatenate([with_neighbours(binned(shapes[at], edges)) for at in chains.order])
    y = np.array(labels)[chains.order]
    good = np.repeat(y, chains.sizes).astype(np.float64)
    # Every document counts the same, however many lines it has.
    document = np.repeat(np.arange(len(y)), chains.sizes)
    share = np.ones(len(y)) if weights is None else np.array(weights)[chains.order]
    pairs = np.flatnonzero(document[1:] == document[:-1])
    flat = (np.arange(3 * FEATURES).reshape(3, FEATURES) * (BINS + 1))[None] + bins
    model = Model(edges, np.zeros((3, FEATURES, BINS + 1)), 0.0, np.zeros((2, 2)))
    size = model.weights.size
    point, adam = np.zeros(size + 5), Adam(0.05)
    weight = (share / share.sum() / chains.sizes)[document]
    for _ in range(steps):
        model.weights, model.bias = point[:size].reshape(model.weights.shape), float(point[size])
        model.steps = point[size + 1 :].reshape(2, 2)
        scores = np.stack([np.zeros(len(good)), model.good_scores(bins)], axis=1)
        forward, backward, total = chains.sums(scores, model.steps)
        marginal = np.exp(forward[:, 1] + backward[:, 1] - total[document])
        error = (marginal - good) * weight
        slope = np.zeros(size + 5)
        slope[:size] = np.bincount(flat.ravel(), np.repeat(error, 3 * FEATURES), size)
        slope[size] = error.sum()
        if len(pairs):
            joint = forward[pairs][:, :, None] + model.steps[None] + (scores + backward)[pairs + 1][:, None, :]
            expected = np.exp(joint - total[document[pairs]][:, None, None]) * weight[pairs][:, None, None]
            slope[size + 1 :] = expected.sum(axis=0).ravel()
            slope[size + 1] -= ((1 - good[pairs]) * weight[pairs]).sum()
            slope[size + 4] -= (good[pairs] * weight[pairs]).sum()
        slope += 2e-4 * point
        point = point + adam.move(slope)
    model.weights, model.bias = point[:size].reshape(model.weights.shape), float(point[size])
    model.steps = point[size + 1 :].reshape(2, 2)
    return model


def train(
    documents: DataFrame,
    labels: DataFrame,
    train_documents: int = TRAIN_DOCUMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Fit on about ``train_documents`` of the documents that ``labels`` marks.

    Their lines are measured in the tasks; the driver gets these measures and no text.
    """
    sample = chosen(labels, train_documents, id_column, label_column, "quality")
    ship()

    @F.arrow_udf("array<float>")
    def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([line_shapes(text.as_py())[0].ravel() for text in batch], pa.list_(pa.float32()))

    found = labelled_texts(documents, sample, id_column, text_column)
    rows = found.select("id", "label", "weight", measured("text").alias("shapes")).orderBy("id").collect()
    shapes = [np.array(row["shapes"], np.float32).reshape(-1, FEATURES) for row in rows]
    return fit_shapes(shapes, [row["label"] for row in rows], [row["weight"] for row in rows])


QUALITY_TYPE = "struct<score:double, lines:array<float>>"


def score_quality(text: Column, model: Model) -> Column:
    """A struct of ``score`` and, by line, the probability of being good."""
    kind = pa.struct([("score", pa.float64()), ("lines", pa.list_(pa.float32()))])

    ship()

    @F.arrow_udf(QUALITY_TYPE)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [found for part in portions(batch, SCORED_CHARACTERS) for found in model.score(part)]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([score for score, _ in out], pa.float64()),
                    pa.array([lines.astype(np.float32) for _, lines in out], pa.list_(pa.float32())),
                ],
                fields=list(kind),
            )

    return scored(text)
