"""Fingerprints of documents by consistent weighted sampling.

A text is a bag of words, each weighted by how often it occurs. For every sample each word draws, from a hash
of itself, two gamma variables (shape 2) and an offset; its weight, rounded down on a logarithmic grid that
these define, gives a value, and the word with the smallest one is the sample, with its grid cell. Two texts
agree in a sample with a probability equal to their generalised Jaccard similarity: the sum of the smaller
weights over the sum of the larger ones.

The draws depend on the word alone, so tasks need no common state, and equal texts have equal fingerprints.
What a word with its count draws is remembered up to a bound.

Neighbours: documents are dealt to buckets by ranges of their id, and the first document of each bucket is
sent to the bucket before as well, so every document meets its successor with one shuffle of the texts.

Defined results: a null text is an empty one; texts without words have the fingerprint of zeros, alike to each
other and to nothing else. A null id comes before all others; equal ids are ordered by their texts. The only
document of a table is its own successor. Further columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

SAMPLES = 128
#: Words with counts whose draws a worker keeps at a time.
CACHED_DRAWS = 80_000
#: Buckets a shuffle partition holds on average: enough to even out their sizes.
BUCKETS_PER_TASK = 8

_words = re.compile(r"\w+").findall
#: Fixed: the capital letter whose lower case depends on its surroundings.
FINAL_SIGMA = "\u03a3"


def _gamma_quantiles(bits: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, at the middles of 2 ** bits equal shares."""
    x = np.concatenate([np.geomspace(1e-8, 0.5, 200_000), np.linspace(0.5, 40, 200_000)[1:]])
    return np.interp((np.arange(2**bits) + 0.5) / 2**bits, -np.expm1(-x) - x * np.exp(-x), x)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Draws of r by 16 bits and of ln c by 20 bits of a hash."""
    return _gamma_quantiles(16).astype(np.float32), np.log(_gamma_quantiles(20)).astype(np.float32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits for each number, in its place, by the finaliser of splitmix64."""
    shifted = x >> np.uint64(30)
    x ^= shifted
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=shifted)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=shifted)
    return x


class Sampler:
    """Fingerprints of texts, with a bounded memory of draws."""

    def __init__(self, samples: int = SAMPLES, cached: int = CACHED_DRAWS):
        self.samples, self.half = samples, max(cached // 2, 1)
        #: Terms by row of their draws: what was met lately, and what was met before that and makes room next.
        self.rows: dict[tuple[str, int], int] = {}
        self.rows_before: dict[tuple[str, int], int] = {}
        #: By row and sample: the value a word competes with in the upper 32 bits, its grid cell in the lower.
        self.draws = self.draws_before = np.empty((0, samples), np.uint64)
        self.streams = np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def _draw(self, once: list[tuple[str, int]], often: list[tuple[str, int]], draws: np.ndarray) -> None:
        """Fill a row for each term; those that occur once have weight 1, so that their grid cell is always 0."""
        gamma, log_gamma = _tables()
        words = np.array([xxhash.xxh3_64_intdigest(word) for word, _ in once + often], np.uint64)[:, None]
        mixed = _mixed(words + self.streams)
        halves = mixed.view("<u4").reshape(len(words), self.samples, 2)
        drawn = draws.view("<u4").reshape(len(words), self.samples, 2)
        drawn[:, :, 0] = halves[:, :, 0]
        offset = mixed.view("<u2").reshape(len(words), self.samples, 4)[:, :, 2].astype(np.float32)
        offset *= np.float32(2.0**-16)
        r = gamma.take((mixed >> np.uint64(48)).view(np.int64))
        below = np.float32(1) - offset
        if often:
            first = len(once)
            log_weight = np.log(np.array([count for _, count in often], np.float64)).astype(np.float32)[:, None]
            step = np.floor(log_weight / r[first:] + offset[first:])
            below[first:] = step - offset[first:] + np.float32(1)
            drawn[first:, :, 0] ^= step.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)
        mixed >>= np.uint64(12)
        mixed &= np.uint64(0xFFFFF)
        value = log_gamma.take(mixed.view(np.int64))
        r *= below
        value -= r
        # As whole numbers, floats sort alike once the negative ones are turned round.
        order = value.view(np.int32)
        turned = order >> 31
        turned &= 0x7FFFFFFF
        order ^= turned
        np.bitwise_xor(order.view(np.uint32), np.uint32(0x80000000), out=drawn[:, :, 1])

    def _remember(self, terms: list[tuple[str, int]]) -> None:
        start, before = len(self.rows), list(map(self.rows_before.get, terms))
        known = [term for term, row in zip(terms, before) if row is not None]
        once = [term for term, row in zip(terms, before) if row is None and term[1] == 1]
        often = [term for term, row in zip(terms, before) if row is None and term[1] != 1]
        self.rows.update(zip(known + once + often, range(start, start + len(terms))))
        if len(self.rows) > len(self.draws):
            grown = np.empty((max(self.half, len(self.rows)), self.samples), np.uint64)
            grown[:start] = self.draws[:start]
            self.draws = grown
        if known:
            self.draws[start : start + len(known)] = self.draws_before[[row for row in before if row is not None]]
        at, new = start + len(known), len(once) + len(often)
        for first in range(0, new, 256):
            last, rest = first + 256, max(first - len(once), 0)
            some = often[rest : max(last - len(once), 0)]
            self._draw(once[first:last], some, self.draws[at + first : at + min(last, new)])

    def _rows(self, terms: list[tuple[str, int]]) -> np.ndarray:
        found = np.fromiter(map(self.rows.get, terms, repeat(-1)), np.int64, len(terms))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = dict.fromkeys([terms[at] for at in missing])
            if len(self.rows) + len(new) > self.half and self.rows:
                self.rows_before, self.draws_before = self.rows, self.draws
                self.rows, self.draws = {}, np.empty((0, self.samples), np.uint64)
                self._remember(list(dict.fromkeys(terms)))
                return np.fromiter(map(self.rows.__getitem__, terms), np.int64, len(terms))
            self._remember(list(new))
            found[missing] = [self.rows[terms[at]] for at in missing]
        return found

    def _smallest(self, rows: np.ndarray) -> np.ndarray:
        smallest = np.full(self.samples, 2**64 - 1, np.uint64)
        for first in range(0, len(rows), 4096):
            np.minimum(smallest, self.draws[rows[first : first + 4096]].min(axis=0), out=smallest)
        return smallest

    def fingerprint(self, text: str) -> np.ndarray:
        counts = Counter(_words(text.lower()))
        if not counts:
            return np.zeros(self.samples, np.uint32)
        return self._smallest(self._rows(list(counts.items()))).astype(np.uint32)

    def fingerprints(self, begin: str, one: str, other: str) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints of two texts that begin alike; what they share is looked at once."""
        if FINAL_SIGMA in begin or FINAL_SIGMA in one or FINAL_SIGMA in other:
            # In lower case it depends on what follows, also beyond the end of a word.
            return self.fingerprint(begin + one), self.fingerprint(begin + other)
        # The last word of the beginning may go on.
        last = len(begin)
        while last and (begin[last - 1].isalnum() or begin[last - 1] == "_"):
            last -= 1
        common = Counter(_words(begin[:last].lower()))
        mine = Counter(_words((begin[last:] + one).lower()))
        theirs = Counter(_words((begin[last:] + other).lower()))
        changed = mine.keys() | theirs.keys()
        # Asked for what it lacks, a Counter takes ten times as long as its get.
        before = common.get
        parts = (
            [term for term in common.items() if term[0] not in changed],
            *(
                [(word, before(word, 0) + count) for word, count in own.items()]
                + [(word, common[word]) for word in other if word in common and word not in own]
                for own, other in ((mine, theirs), (theirs, mine))
            ),
        )
        rows = self._rows([term for part in parts for term in part])
        cuts = np.cumsum([len(part) for part in parts])[:2]
        same, own, changed_to = np.split(rows, cuts)
        smallest = self._smallest(same)
        return tuple(
            np.minimum(smallest, self._smallest(more)).astype(np.uint32)
            if len(same) or len(more)
            else np.zeros(self.samples, np.uint32)
            for more in (own, changed_to)
        )


@lru_cache(maxsize=2)
def sampler(samples: int) -> Sampler:
    """One sampler per worker process, so that later tasks find what earlier ones drew."""
    return Sampler(samples)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def fingerprint_text(text: Column, samples: int = SAMPLES) -> Column:
    """The fingerprint of each text: its samples as 32-bit numbers."""

    ship()

    @F.arrow_udf("array<long>")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sampler(samples)
        for batch in batches:
            yield pa.array([own.fingerprint(text or "").astype(np.int64) for text in batch.to_pylist()], pa.list_(pa.int64()))

    return fingerprints(text)


def with_successors(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents in buckets of id ranges, sorted: ``bucket``, ``guest``, ``key``, ``doc_id``, ``text``.

    A bucket's documents are followed by guests, the first of which is the successor of its last document.
    """
    spark = documents.sparkSession
    slim = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text")
    ).withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = tasks * BUCKETS_PER_TASK
    cuts = slim.agg(
        F.min("key").alias("first"),
        F.percentile_approx("key", [i / wanted for i in range(1, wanted)], 10 * wanted).alias("cuts"),
    ).first()
    # Bounds are keys of the table, one list entry a bucket, so each bucket's first key is its bound.
    bounds = np.array(sorted({cuts["first"], *(cuts["cuts"] or [])} - {None}), np.int64)
    buckets = max(len(bounds), 1)

    @F.arrow_udf("array<int>")
    def places(keys: pa.Array) -> pa.Array:
        key = keys.to_numpy(zero_copy_only=False).astype(np.int64)
        own = np.searchsorted(bounds, key, side="right") - 1
        first = bounds[own] == key if len(bounds) else np.zeros(0, bool)
        return pa.array([[b, (b - 1) % buckets] if f else [b] for b, f in zip(own.tolist(), first.tolist())], pa.list_(pa.int32()))

    return (
        slim.withColumn("places", places("key"))
        .select("key", "doc_id", "text", F.posexplode("places").alias("guest", "bucket"))
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket", "guest", "key", "text")
        .select("bucket", "guest", "key", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the document that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compare_with_edits(
    documents: DataFrame, samples: int = SAMPLES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike it is to that and to its successor."""

    ship()

    def compared(batches):
        own = sampler(samples)
        # The last document of the bucket, and the row of the one before it, which waits for its successor's fingerprint.
        last = waiting = None
        for batch in batches:
            rows = []
            for bucket, guest, doc_id, text in zip(batch["bucket"], batch["guest"], batch["doc_id"], batch["text"]):
                if last is not None and last[0] == bucket:
                    if last[3]:
                        continue
                    mine, row = _compared(own, last, text)
                    if waiting is not None:
                        rows.append(_finished(*waiting, mine))
                    waiting = (mine, row)
                    if guest:
                        rows.append(_finished(*waiting, own.fingerprint(text)))
                        waiting = None
                last = (bucket, doc_id, text, bool(guest))
            frame = pd.DataFrame(rows, columns=COLUMNS)
            yield frame.astype({"doc_id": "Int64"})

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return with_successors(documents, id_column, text_column).mapInPandas(compared, schema)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(sampler: Sampler, document: tuple, following: str) -> tuple[np.ndarray, tuple]:
    """A document's fingerprint and its row but for the last column."""
    _, doc_id, text, _ = document
    kept = len(text) - len(text) // 4
    changed = following[: len(text) // 4]
    own, other = sampler.fingerprints(text[:kept], text[kept:], changed)
    return own, (
        doc_id,
        len(text),
        hashlib.sha256((text[:kept] + changed).encode()).hexdigest(),
        own.astype("<u4").tobytes().hex(),
        other.astype("<u4").tobytes().hex(),
        likeness(own, other),
    )


def _finished(own: np.ndarray, row: tuple, following: np.ndarray) -> tuple:
    return (*row, likeness(own, following))
