"""Language identification of mixed texts by word scores and Viterbi.

Every word has a score in every language: from the model's word counts, or for an unknown word from its
character trigrams. The script of a word's letters leaves only the languages that are written in it. Viterbi
over the words, with a fixed price for changing the language, labels spans; the language with the most letters in
its spans is that of the text. Texts of a batch are labelled side by side, one word of each at a time.

The model is counted by Spark over training documents that are chosen by a hash of their id, about
``train_documents`` of them whatever the size of the corpus and at least one of each language, and keeps at most ``max_words`` words a language.
Texts to be labelled are read whole.

Defined results: a null or empty text, or one without a letter, is ``und`` with score 0 and has no spans. The score
is the share of the text's letters in spans of its language, times the probability of that language against the
others given the words of these spans. If two languages have equally many letters the one first in the alphabet is taken. A model
without training documents labels everything ``und``. Rows given twice are labelled alike; further columns are not touched.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship
from .training import hash_cuts

UNDETERMINED = "und"
TRAIN_DOCUMENTS = 6000
MAX_WORDS = 30_000
SWITCH_PRICE = 8.0
#: The most that one word may say against a language, in natural log units.
WORST = 6.0
#: A language counts as written in a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Words whose scores a task keeps at a time; beyond that it starts afresh.
CACHED_WORDS = 200_000

#: Fixed: ranges of code points by script; letters outside them are "other".
SCRIPTS = (
    ("latin", 0x41, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF),
    ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)

#: A word is a letter and the letters and combining marks that follow it.
_words = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
_ascii_words = re.compile(r"[a-z]+").findall
_marks = regex.compile(r"\p{M}+")


def words_of(text: str | None) -> list[str]:
    """The words that are learnt and looked up."""
    lowered = (text or "").lower()
    return _ascii_words(lowered) if lowered.isascii() else _words(lowered)


def _letters(word: str) -> str:
    """The word without combining marks."""
    return word if word.isalpha() else _marks.sub("", word)


@lru_cache(maxsize=10_000)
def script(letter: str) -> str:
    point = ord(letter)
    return next((name for name, first, last in SCRIPTS if first <= point <= last), "other")


def scripts_of(word: str) -> frozenset:
    return frozenset(map(script, set(_letters(word))))


class Model:
    """Word and trigram scores by language."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        """``counts``: word, language, occurrences."""
        self.languages = sorted({language for _, language, _ in counts})
        place = {language: at for at, language in enumerate(self.languages)}
        words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(place)))
        trigrams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(place)))
        letters = [Counter() for _ in place]
        for word, language, n in counts:
            at = place[language]
            words[word][at] += n
            for letter in _letters(word):
                letters[at][script(letter)] += n
            # Frequent words would drown what tells the shape of unknown ones.
            for trigram in _trigrams(word):
                trigrams[trigram][at] += 1.0 + math.log(n)
        self.words, self.word_scores = _log_shares(words, len(place))
        self.trigrams, self.trigram_scores = _log_shares(trigrams, len(place))
        self.written = [
            frozenset(name for name, n in count.items() if n >= SCRIPT_SHARE * sum(count.values())) for count in letters
        ]
        self.narrowed: dict[frozenset, np.ndarray | None] = {}

    def scores(self, word: str) -> np.ndarray:
        """Log scores by language, the best 0 and none below ``-WORST``."""
        at = self.words.get(word)
        if at is None:
            known = [self.trigrams[trigram] for trigram in _trigrams(word) if trigram in self.trigrams]
            found = self.trigram_scores[known].sum(axis=0)
        else:
            found = self.word_scores[at]
        scores = np.maximum(found - found.max(), -WORST)
        allowed = self.allowed(scripts_of(word))
        return scores if allowed is None else np.where(allowed, scores, -2 * WORST)

    def allowed(self, scripts: frozenset) -> np.ndarray | None:
        """The languages written in one of the scripts; None if that narrows nothing."""
        if scripts not in self.narrowed:
            allowed = np.array([bool(scripts & written) for written in self.written])
            self.narrowed[scripts] = None if allowed.all() or not allowed.any() else allowed
        return self.narrowed[scripts]


def _trigrams(word: str) -> list[str]:
    marked = f" {word} "
    return [marked[at : at + 3] for at in range(max(len(marked) - 2, 1))]


def _log_shares(counts: dict[str, np.ndarray], languages: int) -> tuple[dict[str, int], np.ndarray]:
    """The row of each key, and in the rows the logs of its shares by language, the best 0."""
    rows = {key: at for at, key in enumerate(counts)}
    table = np.array(list(counts.values())).reshape(len(rows), languages) + 0.2
    logs = np.log(table / table.sum(axis=0)) if len(rows) else table
    return rows, (logs - logs.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float32)


def train(
    documents: DataFrame,
    train_documents: int = TRAIN_DOCUMENTS,
    max_words: int = MAX_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
) -> Model:
    """Count words by language over about ``train_documents`` of the documents given."""
    usable = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language_column).alias("language")
    ).where("language IS NOT NULL AND text IS NOT NULL")
    drawn = F.xxhash64(F.lit("language"), "id")
    found = usable.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.min(drawn).alias("least")).collect()
    if not found:
        return Model([])
    # The same number of documents of each language, so that a rare one is learnt as well, and at least one of each.
    sizes = {row["language"]: row["n"] for row in found}
    cuts = hash_cuts(sizes, train_documents)
    chosen = F.lit(False)
    for language, _, least in sorted(found):
        chosen |= (F.col("language") == language) & (drawn <= max(cuts[language], least))
    ship()

    # The function that cuts the texts to be labelled, so that the words are the same.
    @F.arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([words_of(text.as_py()) for text in texts], pa.list_(pa.string()))

    counts = (
        usable.where(chosen)
        .select("language", F.explode(words("text")).alias("word"))
        .groupBy("language", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.col("n").desc(), "word"))
    kept = counts.withColumn("place", place).where(F.col("place") <= max_words).orderBy(F.col("n").desc(), "word", "language").collect()
    return Model([(row["word"], row["language"], row["n"]) for row in kept])


class WordRows(dict):
    """The row of each word in a table of scores, filled as words come up."""

    def __init__(self, model: Model):
        self.model = model
        self.scores = np.zeros((CACHED_WORDS + 1, len(model.languages)), np.float32)
        self.letters = np.zeros(len(self.scores), np.int64)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        if at == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.scores[at] = self.model.scores(word)
        self.letters[at] = len(_letters(word))
        return at


class Labeller:
    """Labels texts; remembers the scores of words."""

    def __init__(self, model: Model):
        self.model = model
        self.rows = WordRows(model)

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
        """Language, score and spans (language, first and last word) of each text."""
        languages = self.model.languages
        if not languages:
            return [(UNDETERMINED, 0.0, []) for _ in texts]
        if len(self.rows) > CACHED_WORDS:
            self.rows.clear()
        words = [words_of(text) for text in texts]
        rows = [np.fromiter(map(self.rows.__getitem__, found), np.int64, len(found)) for found in words]
        lengths = [self.rows.letters[row] for row in rows]
        paths = viterbi([self.rows.scores[row] for row in rows], SWITCH_PRICE)
        out = []
        for row, length, path in zip(rows, lengths, paths):
            if not len(row):
                out.append((UNDETERMINED, 0.0, []))
                continue
            letters = np.bincount(path, length, len(languages))
            best = int(letters.argmax())
            total = self.rows.scores[row[path == best]].sum(axis=0, dtype=np.float64)
            certain = 1.0 / np.exp(np.minimum(total - total[best], 700.0)).sum()
            starts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
            ends = np.r_[starts[1:], len(path)] - 1
            spans = [(languages[path[first]], int(first), int(last)) for first, last in zip(starts, ends)]
            out.append((languages[best], float(letters[best] / letters.sum() * certain), spans))
        return out


def viterbi(scores: list[np.ndarray], price: float) -> list[np.ndarray]:
    """The best path through each text's word scores; all texts advance together, the longest first."""
    sizes = np.array([len(s) for s in scores])
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes[order[0]]) if len(order) else 0
    if not longest:
        return [np.zeros(0, np.int64) for _ in scores]
    width = scores[0].shape[1]
    # Texts still running at each word, and where each text's words stand when all are put end to end.
    running = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    starts = np.r_[0, np.cumsum(sizes[order])[:-1]]
    flat = np.concatenate([scores[at] for at in order])
    kind = np.min_scalar_type(width)
    came_from = np.zeros((len(flat), width), kind)
    value = flat[starts[: running[0]]].copy()
    states = np.arange(width, dtype=kind)
    final = np.zeros(len(order), np.int64)
    for word in range(1, longest):
        n = running[word]
        final[n : len(value)] = value[n:].argmax(axis=1)
        value = value[:n]
        best = value.argmax(axis=1)
        change = value[np.arange(n), best][:, None] - price
        stay = value >= change
        at = starts[:n] + word
        came_from[at] = np.where(stay, states, best[:, None])
        value = np.where(stay, value, change) + flat[at]
    final[: len(value)] = value.argmax(axis=1)
    state = final[: running[0]].copy()
    path = np.zeros(len(flat), np.int64)
    for word in range(longest - 1, -1, -1):
        n = running[word]
        at = starts[:n] + word
        path[at] = state[:n]
        if word:
            state[:n] = came_from[at, state[:n]]
    pieces = np.split(path, np.cumsum(sizes[order])[:-1])
    out: list = [None] * len(order)
    for at, piece in zip(order, pieces):
        out[at] = piece
    return out


LABEL_TYPE = "struct<lang:string, score:double, spans:array<struct<lang:string, first_word:int, last_word:int>>>"


def label_language(text: Column, model: Model) -> Column:
    """A struct of ``lang``, ``score`` and ``spans`` for each text; words are counted from 0."""
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("last_word", pa.int32())])
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    ship()

    @F.arrow_udf(LABEL_TYPE)
    def labelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model)
        for batch in batches:
            out = []
            for first in range(0, len(batch), 500):
                out += labeller.label(batch[first : first + 500].to_pylist())
            yield pa.array(
                [
                    {"lang": lang, "score": score, "spans": [dict(zip(("lang", "first_word", "last_word"), s)) for s in spans]}
                    for lang, score, spans in out
                ],
                kind,
            )

    return labelled(text)
