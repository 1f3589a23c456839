"""Periodic runs of words: where a text repeats itself word by word.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) of at least ``max(least, 2 * q)``
words that no neighbouring word extends with that period. It is found in two steps.

* Recursive frequency splitting. In a run of two periods or more every word comes up again within the run. A
  word that is alone in its segment is thus in no run, and the segment is split there; that makes other words alone,
  and so on until nothing changes. Segments shorter than ``least`` are given up. Each turn looks only at the words that
  the last splits may have parted from their like, namely those of all new pieces but the largest one, so all turns
  together touch each word about log(n) times.
* Lag scan. In what is left, a run of period ``q`` is a stretch of at least ``max(least - q, q)`` places whose word is
  that ``q`` places later. Such a stretch holds a whole block of half that length, of blocks laid end to end, so
  for each lag only the blocks are compared with what lies ``q`` later, by sums over powers (about 2 n / q
  comparisons a lag, n log n in all). Blocks that seem alike are extended word by word, shortest lag first. What
  a run explains (blocks inside it at a multiple of its period) is not looked at again, so each run is met once and
  with its smallest period.

Words are maximal pieces without U+0020 and U+0009 to U+000D. A text is handled as a whole inside one task; the
memory taken is a multiple of its length. The lags of a segment are scanned in portions of bounded size.

Defined results: a null or empty text, or one of blanks, has no words and no runs and collapses to the empty text. Rows,
repeated ones too, keep their number; further columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Fewest words of a run.
LEAST = 12
#: Comparisons of blocks made at a time.
PORTION = 1 << 20
#: From so many periods on a run is set against all lags left at once.
MANY_PERIODS = 8
#: Factor of the sums over powers, odd; sums are taken modulo 2^64 and only propose what is then compared word by word.
FACTOR = 0x9E3779B97F4A7C15

RUN = "struct<start:bigint, length:bigint, period:bigint>"
FOUND = f"struct<n_words:bigint, runs:array<{RUN}>, collapsed:string>"


def split_words(text: str) -> list[bytes]:
    return text.encode().split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    first = dict(zip(reversed(words), range(len(words) - 1, -1, -1)))
    return np.fromiter(map(first.__getitem__, words), np.int64, len(words))


def _like(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the one before and the one after it that has the same word; -1 and n where there is none."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    same = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    before[order[same + 1]] = order[same]
    after[order[same]] = order[same + 1]
    return before, after


def segments(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Segments (start, end) of at least ``least`` words in which no word is alone."""
    n = len(ids)
    if n < least:
        return []
    before, after = _like(ids)
    cuts, check = np.array([-1, n], np.int64), np.arange(n)
    while len(check):
        at = np.searchsorted(cuts, check)
        alone = check[(before[check] <= cuts[at - 1]) & (after[check] >= cuts[at])]
        if not len(alone):
            break
        split = np.searchsorted(cuts, alone)
        cuts = np.insert(cuts, split, alone)
        check = _parted(cuts, np.unique(split), alone, before, after, least)
    starts, ends = cuts[:-1] + 1, cuts[1:]
    kept = ends - starts >= least
    return list(zip(starts[kept].tolist(), ends[kept].tolist()))


def _parted(cuts, split, alone, before, after, least) -> np.ndarray:
    """Words that may have lost their like by new cuts: those of the new pieces and their like, without the largest pieces."""
    # Pieces next to a new cut, by the old segment they come from.
    old = np.cumsum(~np.isin(cuts, alone, assume_unique=True))
    starts, ends, owner = cuts[:-1] + 1, cuts[1:], old[:-1]
    touched = np.isin(owner, split)
    starts, ends, owner = starts[touched], ends[touched], owner[touched]
    by_size = np.lexsort((ends - starts, owner))
    largest = np.append(owner[by_size][1:] != owner[by_size][:-1], True)
    small = by_size[~largest]
    sizes = ends[small] - starts[small]
    places = np.repeat(starts[small] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    both = np.concatenate([places, before[places], after[places]])
    both = np.unique(both[(both >= 0) & (both < len(before))])
    at = np.searchsorted(cuts, both)
    # Cuts themselves are done, and so are segments too short for a run.
    return both[(cuts[at] != both) & (cuts[at] - cuts[at - 1] > least)]


def _sums(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over powers up to each place and the powers, modulo 2^64; words are scrambled first."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(FACTOR)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(FACTOR)
    mixed ^= mixed >> np.uint64(29)
    powers = np.full(len(ids) + 1, FACTOR, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers[:-1])])
    return sums, powers


def _lags(n: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Lags, first places and lengths of the blocks to compare, in portions, by lag and place."""
    lags = np.arange(1, n // 2 + 1)
    blocks = (np.maximum(least - lags, lags) + 1) // 2
    counts = np.maximum((n - lags) // blocks, 0)
    portion = np.cumsum(counts) // PORTION
    ends = np.flatnonzero(np.append(portion[1:] != portion[:-1], True)) + 1
    for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        count = counts[begin:end]
        lag, block = np.repeat(lags[begin:end], count), np.repeat(blocks[begin:end], count)
        turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        yield lag, turn * block, block


def scan(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of one segment."""
    n, runs = len(ids), []
    if n < least:
        return runs
    sums, powers = _sums(ids)
    # Starts and ends of the runs by period. Runs of one period do not nest, so both rise.
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    long: list[tuple[int, int, int]] = []
    for lag, place, block in _lags(n, least):
        here = (sums[place + block] - sums[place]) * powers[lag]
        hit = np.flatnonzero(here == sums[place + lag + block] - sums[place + lag])
        lag, place, block = lag[hit], place[hit], block[hit]
        fresh = long
        while len(lag):
            # A run of many periods explains many lags at once, others are looked up lag by lag.
            for start, end, period in fresh:
                left = ~((lag % period == 0) & (place >= start) & (place + block + lag <= end))
                lag, place, block = lag[left], place[left], block[left]
            if not len(lag):
                break
            q, size = int(lag[0]), int(np.searchsorted(lag, lag[0], side="right"))
            found = _runs_of_lag(ids, q, _unexplained(place[:size], int(block[0]) + q, q, known), int(block[0]), least)
            if found:
                known[q] = tuple(np.array(found).T)
                runs += [(start, end - start, q) for start, end in found]
            fresh = [(start, end, q) for start, end in found if end - start >= MANY_PERIODS * q]
            long += fresh
            lag, place, block = lag[size:], place[size:], block[size:]
    return runs


def _unexplained(places: np.ndarray, width: int, lag: int, known: dict) -> np.ndarray:
    """Places whose block and its image are not inside a known run of a period that divides the lag."""
    for period in [period for period in known if lag % period == 0]:
        starts, ends = known[period]
        at = np.searchsorted(starts, places, side="right") - 1
        places = places[(at < 0) | (ends[at] < places + width)]
    return places


def _runs_of_lag(ids: np.ndarray, lag: int, places: np.ndarray, block: int, least: int) -> list[tuple[int, int]]:
    """Starts and ends of the runs of one period around blocks that seem alike."""
    found, done = [], -1
    for at in places.tolist():
        if at < done:
            continue
        start, end = _stretch(ids, at, lag)
        if end < at + block:
            continue
        done = end
        if end - start + lag >= max(least, 2 * lag):
            found.append((start, end + lag))
    return found


def _stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The largest stretch around a place in which each word comes again ``lag`` places later; empty if it is not one."""
    if ids[at] != ids[at + lag]:
        return at, at
    last = len(ids) - lag
    end, step = at + 1, 64
    while end < last:
        odd = np.flatnonzero(ids[end : min(end + step, last)] != ids[end + lag : min(end + step, last) + lag])
        if len(odd):
            end += int(odd[0])
            break
        end, step = min(end + step, last), step * 2
    start, step = at, 64
    while start > 0:
        low = max(start - step, 0)
        odd = np.flatnonzero(ids[low:start] != ids[low + lag : start + lag])
        if len(odd):
            start = low + int(odd[-1]) + 1
            break
        start, step = low, step * 2
    return start, end


def periodic_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of numbered words, by start and period."""
    found = []
    for begin, end in segments(ids, least):
        found += [(begin + start, length, period) for start, length, period in scan(ids[begin:end], least)]
    return sorted((start, length, period) for start, length, period in found)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one blank, without those that a run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def find_runs(text: Column, least: int = LEAST) -> Column:
    """A struct of ``n_words``, the ``runs`` by start and period, and the text ``collapsed`` to first periods."""
    ship()

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, ends, flat, texts = [], [0], [], []
            for value in batch:
                words = split_words(value.as_py() or "")
                runs = periodic_runs(numbered(words), least)
                counts.append(len(words))
                flat += runs
                ends.append(len(flat))
                texts.append(collapse(words, runs))
            columns = list(zip(*flat)) or [(), (), ()]
            parts = [pa.array(column, pa.int64()) for column in columns]
            runs = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, ["start", "length", "period"])
            )
            collapsed = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), runs, collapsed], ["n_words", "runs", "collapsed"])

    return found(text)


def longest_run(runs: Column) -> Column:
    """The run of greatest length, of equal ones that with the smallest start, then period; null without runs."""
    order = F.transform(
        runs, lambda run: F.struct((-run["length"]).alias("l"), run["start"].alias("s"), run["period"].alias("p"), run.alias("run"))
    )
    return F.array_min(order)["run"]


def planted(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; for one id in ten a text that repeats a stretch of its own words to the end.

    Let ``h`` be the crc32 of the decimal id and ``g = h / 10``. If ``h`` is a multiple of ten and there are ``n > 0`` words, each word
    from place ``a = g % n`` on becomes word ``a + (i - a) % p`` with ``p = 1 + (n - a) / (3 + g % 8)`` (whole numbers).
    A document without an id keeps its text.
    """
    h, words = F.col("_h"), F.col("_words")
    chosen = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    cut = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_h")).select(
        "doc_id", "text", "_h", F.when(h % 10 == 0, F.coalesce(chosen, F.array().cast("array<string>"))).alias("_words")
    )
    g, n = F.floor(h / 10), F.size("_words")
    placed = cut.select("doc_id", "text", "_words", g.alias("_g"), n.alias("_n"), F.when(n > 0, (g % n).cast("int")).alias("_a"))
    rest = F.col("_n") - F.col("_a")
    period = (F.floor(rest / (3 + F.col("_g") % 8)) + 1).cast("int")
    placed = placed.select("doc_id", "text", "_words", "_n", "_a", period.alias("_p"))
    times = F.ceil(rest / F.col("_p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, F.col("_a") + 1, F.col("_p")), times)), F.lit(1), rest)
    made = F.when(F.col("_n") > 0, F.array_join(F.concat(F.slice(words, F.lit(1), F.col("_a")), tail), " ")).otherwise("")
    return placed.select("doc_id", F.when(words.isNull(), F.col("text")).otherwise(made).alias("text"))
