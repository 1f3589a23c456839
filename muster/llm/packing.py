"""Best-fit packing of documents into sequences of bounded length, in bulk-synchronous rounds.

A document's ids are those of a public tokenizer and one end id; only a document longer than a sequence is cut.
Each round range-sorts what is left, pieces and gaps alike, by size, largest first, and sweeps it:

* Every task sweeps its range from large to small: a piece takes the smallest gap that holds it among those
  met so far, and what remains of the gap is on offer again (successor search in the task).
* Pieces that found no gap in their range take gaps that no piece of an earlier range wanted. Ranges are
  bracketed by their counts alone (one row a range goes to the driver): the latest gaps are the smallest that
  fit. The n-th such piece takes the n-th such gap, so no two pieces want one gap (conflicts end by rank).
* The gaps shrink, and pieces larger than every gap open as many new sequences as they need, the largest first.

A round ends in a table, so a lost executor costs a task and not the rounds before. Ids never move: a row is
a piece's place in its document, its length and checksum. Rows of one length are dealt to several ranges.

Defined results: a null or empty text is its end id alone. Rows given twice are packed twice. An empty table
gives an empty result. Further columns of the input play no part.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, ship, tasks_for, written

SEQUENCE_TOKENS = 4096
#: Fixed by the query's contract: the id that ends each document.
END_ID = 1
ROWS_PER_TASK = 50_000
#: Pieces of which fewer than this fit a sequence open sequences before smaller ones do.
FEW = 4
#: Words whose ids a Python process keeps at a time; beyond that it forgets those that have not come up for long.
CACHED_WORDS = 500_000
_PUNCTUATION = (b".", b",", b";", b":", b"!", b"?")

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Marks that may melt into an ASCII letter when texts are normalised.
_melting = re.compile("[\u0300-\u036f]").search
#: A word of letters that normalising only lowers, one for one, and the ASCII punctuation after it.
_plain = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)").fullmatch


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


#: For ``str.translate`` of bytes read as Latin-1.
_BYTE_LETTERS = _byte_letters()
#: The normaliser and the way to cut texts with which a run of such letters is lowered, stays whole and goes to the model as bytes.
_STEPS = (
    r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])',
    r'''Sequence(pretokenizers=[Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), '''
    "behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])",
)


class WordIds(dict):
    """Ids of words as little-endian 32-bit numbers, filled as words come up.

    The tokenizer drops white space, never joins across it, and lowers all letters, so a text's ids are those of
    its words, and words that differ in the case of ASCII letters share theirs. Punctuation stands by itself.
    A special token written out in a text is that token, in its own letter case only.

    Words of Latin letters need none of the tokenizer's steps but its model, which gets them straight: most words that
    are met for the first time are such.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        #: How special tokens begin, up to the first letter; a text with that keeps its letter case.
        self.marker = re.match("[^A-Za-z]*", os.path.commonprefix(specials))[0] if specials else None
        #: The words before these; those that come up again are kept on.
        self.earlier: dict[bytes, bytes] = {}
        steps = (repr(self.tokenizer.normalizer), repr(self.tokenizer.pre_tokenizer))
        #: The model's own cut of a run of letters, if the tokenizer hands them over as they are.
        self.cut = self.tokenizer.model.tokenize if steps == _STEPS and not self.tokenizer.model.dropout else None

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.earlier.get(word)) is not None:
            pass
        elif self.cut and (plain := _plain(text := word.decode())):
            if plain[2]:
                split = len(word) - len(plain[2])
                ids = self[word[:split]] + self[word[split:]]
            else:
                letters = text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
                ids = array("I", [token.id for token in self.cut(letters)]).tobytes()
        elif word[-1:] in _PUNCTUATION and word[:-1].isalpha():
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            ids = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def of_text(self, text: str) -> bytes:
        if len(self) > CACHED_WORDS // 2:
            self.earlier = dict(self)
            self.clear()
        raw = text.encode()
        if not _melting(text) and (self.marker is None or self.marker not in text):
            raw = raw.lower()
        return b"".join(map(self.__getitem__, raw.split()))


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One for all tasks that a Python process runs, as they meet the same words."""
    return WordIds(path)


def token_pieces(
    documents: DataFrame,
    tokenizer_path: str,
    capacity: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32``."""
    ship()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        words = _word_ids(tokenizer_path)
        for batch in batches:
            rows = []
            # One text at a time becomes a Python string.
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = words.of_text(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = [field.split()[0] for field in PIECE.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    slim = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return slim.mapInArrow(cut, PIECE)


#: What a sweep leaves of a row: a placed piece, a piece without gap, a gap that was used, a gap that was not.
PLACED, WAITING, USED, UNUSED = 0, 1, 2, 3
#: Rows of a round: pieces have a length, gaps a sequence; ``size`` is the length or the room left.
STATE = f"is_piece int, size long, sequence_id long, offset long, {PIECE}"


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: no sequence is longer than ``capacity``, none has a hole."""
    ship()
    state = written(
        pieces.select(
            F.lit(1).alias("is_piece"),
            F.col("length").alias("size"),
            F.lit(None).cast("long").alias("sequence_id"),
            F.lit(None).cast("long").alias("offset"),
            *pieces.columns,
        ),
        "pieces",
    )
    names = [*pieces.columns, "sequence_id", "offset"]
    result = state.select(names).limit(0)
    rows_left = pieces_left = state.count()
    sequences, unpacked = 0, state
    while pieces_left:
        rows = written(_sweep(state, tasks_for(rows_left, rows_per_task)), "sweep")
        if unpacked is not None:
            removed(unpacked)
            unpacked = None
        ranges = _ranges(rows)
        runs = _brackets(ranges)
        crossed, waiting = sum(run[-1] for run in runs), sum(row["waiting"] for row in ranges)
        opened = _openings(rows, ranges, waiting - crossed, capacity)
        assigned = written(_assigned(rows, runs, ranges, opened, sequences, capacity), "assigned")
        placed, gaps = _crossed(assigned)
        sequences += opened
        for part in (rows.where(F.col("outcome") == PLACED), assigned.where("is_piece = 2"), placed):
            result = result.unionByName(part.select(names))
        state = assigned.where("is_piece < 2 AND match IS NULL").drop("match").unionByName(gaps)
        pieces_left = waiting - crossed - opened
        rows_left = pieces_left + sum(row["gaps"] for row in ranges) + opened
    return result


def _sweep(state: DataFrame, tasks: int) -> DataFrame:
    """Each range from large to small; the rows get their ``outcome`` and their ``place`` among those of it."""
    order = [F.col("size").desc(), F.col("is_piece"), F.xxhash64("sequence_id", "doc_id", "piece")]

    def best_fit(batches):
        frames = [batch for batch in batches if len(batch)]
        if frames:
            yield _sweep_range(pd.concat(frames, ignore_index=True))

    # What fits one task needs no ranges.
    ranged = state.repartitionByRange(tasks, *order) if tasks > 1 else state.coalesce(1)
    return (
        ranged.sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("range"))
        .mapInPandas(best_fit, f"{STATE}, range int, outcome int, place long")
    )


def _sweep_range(rows: pd.DataFrame) -> pd.DataFrame:
    size, is_piece = rows["size"].to_numpy(), rows["is_piece"].to_numpy() == 1
    outcome = np.where(is_piece, WAITING, UNUSED)
    room, sequence, offset = size.copy(), rows["sequence_id"].astype("Int64").fillna(-1).to_numpy(np.int64), rows["offset"].astype("Int64").fillna(-1).to_numpy(np.int64)
    # Gaps on offer by the room they have; the later in the order of rows, the smaller they were to begin with.
    offered: list[tuple[int, int]] = []
    for row in range(len(rows)):
        if not is_piece[row]:
            if room[row]:
                insort(offered, (int(room[row]), -row))
            continue
        found = bisect_left(offered, (int(size[row]), -len(rows)))
        if found == len(offered):
            continue
        gap = -offered.pop(found)[1]
        outcome[row], outcome[gap] = PLACED, USED
        sequence[row], offset[row] = sequence[gap], offset[gap]
        offset[gap] += size[row]
        room[gap] -= size[row]
        if room[gap]:
            insort(offered, (int(room[gap]), -gap))
    rows = rows.assign(size=np.where(is_piece, size, room), outcome=outcome)
    known = sequence >= 0
    rows["sequence_id"] = pd.array(np.where(known, sequence, 0), "Int64")
    rows["offset"] = pd.array(np.where(known, offset, 0), "Int64")
    rows.loc[~known, ["sequence_id", "offset"]] = pd.NA
    place = rows.groupby("outcome").cumcount()
    return rows.assign(place=place)


def _ranges(rows: DataFrame) -> list:
    """One row a range, in order: pieces that wait, gaps that nobody in it wanted, all gaps and the largest."""
    waits, free = F.col("outcome") == WAITING, F.col("outcome").isin(USED, UNUSED) & (F.col("size") > 0)
    return (
        rows.groupBy("range")
        .agg(
            F.count_if(waits).alias("waiting"),
            F.count_if((F.col("outcome") == UNUSED) & (F.col("size") > 0)).alias("unused"),
            F.count_if(free).alias("gaps"),
            F.coalesce(F.max(F.when(free, F.col("size"))), F.lit(0)).alias("largest_gap"),
        )
        .orderBy("range")
        .collect()
    )


def _brackets(ranges: list) -> list[tuple[int, int, int, int, int]]:
    """Runs of matches: range and first place of the pieces, range and last place of the gaps, how many."""
    runs, open_gaps = [], []
    for row in ranges:
        first, waiting = 0, row["waiting"]
        while waiting and open_gaps:
            gap_range, gaps = open_gaps.pop()
            n = min(waiting, gaps)
            runs.append((row["range"], first, gap_range, gaps - 1, n))
            first, waiting = first + n, waiting - n
            if gaps > n:
                open_gaps.append((gap_range, gaps - n))
        if row["unused"]:
            open_gaps.append((row["range"], row["unused"]))
    return runs


def _openings(rows: DataFrame, ranges: list, unmatched: int, capacity: int) -> int:
    """Sequences to open for pieces that are larger than every gap.

    Large pieces, of which fewer than ``FEW`` fit a sequence, come first: those of the largest kind get as many
    sequences as they need among themselves. Smaller ones get as many as their tokens fill.
    """
    largest_gap = max((row["largest_gap"] for row in ranges), default=0)
    too_large = rows.where((F.col("outcome") == WAITING) & (F.col("size") > largest_gap))
    fit = F.floor(F.lit(capacity) / F.col("size"))
    need = too_large.agg(
        F.sum("size").alias("tokens"), F.min(fit).alias("fit"), *(F.count_if(fit == n).alias(f"of_{n}") for n in range(1, FEW))
    ).first()
    if need["tokens"] is None:
        return 0
    opened = -(-need[f"of_{need['fit']}"] // need["fit"]) if need["fit"] < FEW else -(-need["tokens"] // capacity)
    return min(unmatched, opened)


def _assigned(rows: DataFrame, runs: list, ranges: list, opened: int, sequences: int, capacity: int) -> DataFrame:
    """What the sweep left, with what the runs and openings say of it, in one pass.

    A piece that opens a sequence is placed (``is_piece`` 2) and followed by the gap it leaves. Pieces and gaps of a
    run have the same ``match``; all other rows go on as they are.
    """
    # By outcome and range: first or last place, how many, first number, direction.
    spans: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    matched = dict.fromkeys((row["range"] for row in ranges), 0)
    number = 0
    for piece_range, first, gap_range, last, n in runs:
        spans.setdefault((WAITING, piece_range), []).append((first, n, number, 1))
        spans.setdefault((UNUSED, gap_range), []).append((last, n, number, -1))
        matched[piece_range] += n
        number += n
    # Matched pieces are the first ones of their range; the others, in order, open sequences while there are any to open.
    ranks, before = {}, 0
    for row in ranges:
        ranks[row["range"]] = before - matched[row["range"]]
        before += row["waiting"] - matched[row["range"]]
    piece_columns = [field.split()[0] for field in PIECE.split(", ")]

    def assign(batches):
        for batch in batches:
            match = pd.Series(pd.NA, batch.index, "Int64")
            for key, places in batch["place"].groupby([batch["outcome"], batch["range"]]):
                for start, n, first_number, sign in spans.get(key, ()):
                    step = (places - start) * sign
                    mine = step[(step >= 0) & (step < n)]
                    match[mine.index] = mine + first_number
            rank = batch["place"] + batch["range"].map(ranks).astype("int64")
            opens = ((batch["outcome"] == WAITING) & match.isna() & (rank < opened)).to_numpy()
            out = batch.drop(columns=["range", "outcome", "place"]).assign(match=match)
            for name in ("sequence_id", "offset", *piece_columns):
                out[name] = out[name].astype("Int64")
            out.loc[opens, "is_piece"] = 2
            out.loc[opens, "sequence_id"] = rank[opens] + sequences
            out.loc[opens, "offset"] = 0
            yield out
            gaps = out[opens & (out["size"] < capacity).to_numpy()].copy()
            gaps["is_piece"], gaps["offset"] = 0, gaps["size"]
            gaps["size"] = capacity - gaps["size"]
            gaps[piece_columns] = pd.NA
            yield gaps

    left = rows.where((F.col("outcome") != PLACED) & (F.col("size") > 0))
    return left.mapInPandas(assign, f"{STATE}, match long")


def _crossed(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces placed by matches between ranges, and the gaps these leave."""
    pieces = assigned.where("is_piece = 1 AND match IS NOT NULL").drop("sequence_id", "offset")
    gaps = assigned.where("is_piece = 0 AND match IS NOT NULL").select(
        "match", "sequence_id", "offset", F.col("size").alias("room")
    )
    placed = pieces.join(gaps, "match")
    left = placed.where("room > size").select(
        F.lit(0).alias("is_piece"),
        (F.col("room") - F.col("size")).alias("size"),
        "sequence_id",
        (F.col("offset") + F.col("size")).alias("offset"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in (field.split() for field in PIECE.split(", "))),
    )
    return placed, left


def pack_documents(
    documents: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    return pack(token_pieces(documents, tokenizer_path, capacity), capacity, rows_per_task)
