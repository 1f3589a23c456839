"""Byte-level BPE encoding by longest matches and backtracking, and decoding.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton of the vocabulary finds every token
at every place of a pretoken in one pass. From the left, the longest token is taken that is compatible with
the token before it; where none is, the last token is given up and the next shorter one tried. (Mostly the longest
matches are compatible throughout, which is tried first.) Two adjacent
tokens are compatible if the merges by rank would leave the border between them alone: undo their merges
one by one, latest first, and no pair across the border may have been merged before. Compatibility is memoised,
and a place from which no way led on is never entered again, so the work is linear in the text. The result
is exactly that of the merges by rank.

Vocabulary files are read where the task runs, by their path. Pretokens are memoised up to a bound in bytes, per worker process.

Defined results: a null or empty text has no ids; null ids decode to no bytes; ids that the vocabulary lacks
fail. Rows, repeated ones too, keep their number; further columns are not touched.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ship

#: Pretokens that a worker keeps with their ids: those up to so many characters, and so many bytes of them in all.
CACHED_CHARACTERS = 48
CACHED_BYTES = 80 << 20
#: Ids decoded at a time.
GATHERED = 1 << 18
#: About what an entry takes besides its characters and ids.
ENTRY_BYTES = 150


@lru_cache(maxsize=2)
def tokens_of(path: str) -> dict[int, bytes]:
    """The tokens of a vocabulary file by rank."""
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens by rank, how each token is merged, and which tokens may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick

        self.tokens = tokens_of(path)
        self.ranks = {token: rank for rank, token in self.tokens.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.by_text = {token.decode("latin-1"): rank for token, rank in self.ranks.items()}
        self.lengths = {rank: len(token) for token, rank in self.ranks.items()}
        self.most = max(self.lengths.values())
        self.shorter = {rank: self._shorter(text) for text, rank in self.by_text.items()}
        self.halves = {rank: self._last_merge(token) for token, rank in self.ranks.items() if len(token) > 1}
        self.merged = {halves: rank for rank, halves in self.halves.items()}
        self.compatible = lru_cache(maxsize=200_000)(self._compatible)

    def _last_merge(self, token: bytes) -> tuple[int, int]:
        """The two tokens whose merge makes this one."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.ranks.get(a + b, len(self.ranks)) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] >= self.ranks[token]:
                raise ValueError(f"no merges lead to {token!r}")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _compatible(self, left: int, right: int) -> bool:
        # Merges across the border count only if they come before the merge undone last on either side.
        before = len(self.ranks)
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                return False
            # The later merge is undone first; of equal ones the right side's, as merges go from the left.
            if left > right and left in self.halves:
                before, left = left, self.halves[left][1]
            elif right in self.halves:
                before, right = right + 1, self.halves[right][0]
            elif left in self.halves:
                before, left = left, self.halves[left][1]
            else:
                return True

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one pretoken."""
        size = len(piece)
        if size < 2:
            return (self.ranks[piece],) if piece else ()
        if piece in self.ranks:
            return (self.ranks[piece],)
        latin = piece.decode("latin-1")
        longest = [rank for _, rank in self.automaton.iter_long(latin)]
        for at, fits in enumerate(map(self.compatible, longest, longest[1:]), 1):
            if not fits:
                return self._backtracked(latin, longest[:at], self.shorter[longest[at]])
        return tuple(longest)

    def _shorter(self, text: str) -> int:
        """The next shorter token that a token starts with; -1 for a single byte."""
        return next((self.by_text[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.by_text), -1)

    def _longest(self, piece: str, at: int) -> int:
        """The longest token that stands at a place; every byte is a token."""
        rest = piece[at : at + self.most]
        length = self.automaton.longest_prefix(rest)
        while rest[:length] not in self.by_text:
            length -= 1
        return self.by_text[rest[:length]]

    def _backtracked(self, piece: str, ids: list[int], token: int) -> tuple[int, ...]:
        """The ids of a pretoken, given compatible ones that it may start with and what to try next, -1 for nothing."""
        size, dead = len(piece), bytearray(len(piece) + 1)
        lengths, shorter, compatible = self.lengths, self.shorter, self.compatible
        at = sum([lengths[i] for i in ids])
        while True:
            while token >= 0:
                if not dead[at + lengths[token]] and (not ids or compatible(ids[-1], token)):
                    break
                token = shorter[token]
            else:
                dead[at] = 1
                token = ids.pop()
                at -= lengths[token]
                token = shorter[token]
                continue
            ids.append(token)
            at += lengths[token]
            if at == size:
                return tuple(ids)
            token = self._longest(piece, at)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _ranges(pattern: str) -> str:
    """The characters of 16 bits that a pattern of one character fits, as ranges inside brackets."""
    import regex

    fits = regex.compile(pattern).fullmatch
    points = [c for c in range(1 << 16) if not 0xD800 <= c < 0xE000 and fits(chr(c))]
    firsts = [c for c, before in zip(points, [-2, *points]) if c != before + 1]
    lasts = [c for c, after in zip(points, [*points[1:], -2]) if after != c + 1]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(firsts, lasts))


def _narrow(pattern: str) -> re.Pattern | None:
    """The pattern for the faster standard module, right for texts of 16-bit characters; None if it says what that cannot."""
    out, inside = [], False
    for part in re.findall(r"\\[pP]\{\^?\w+\}|\\.|.", pattern, re.S):
        if part in (r"\p{L}", r"\p{N}", r"\s"):
            out.append(_ranges(part) if inside else f"[{_ranges(part)}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{_ranges(chr(92) + 's')}]")
        elif part.startswith("\\") and part[1].isalnum():
            return None
        else:
            inside = part == "[" or (inside and part != "]")
            out.append(part)
    return re.compile("".join(out))


@lru_cache(maxsize=4)
def _pretokens(pattern: str):
    """A function that cuts a text into pretokens."""
    import regex

    wide, narrow = regex.compile(pattern).findall, _narrow(pattern)
    if narrow is None:
        return wide
    return lambda text: (narrow.findall if len(text.encode("utf-16-le")) == 2 * len(text) else wide)(text)


class Encoder:
    """Ids of texts as 32-bit numbers; those of pretokens are kept as they come up."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = vocabulary(path)
        self.pretokens = _pretokens(pattern)
        # What was met lately, and what was met before that; the latter makes room when the former is full.
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.kept_bytes = 0

    def _ids(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = array("i", self.vocabulary.encode(piece.encode())).tobytes()
        if len(piece) <= CACHED_CHARACTERS:
            self.kept_bytes += ENTRY_BYTES + 2 * len(piece) + len(ids)
            if self.kept_bytes > CACHED_BYTES // 2:
                self.before, self.kept, self.kept_bytes = self.kept, {}, 0
            self.kept[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, each pretoken encoded on its own."""
        pieces = self.pretokens(text)
        found = list(map(self.kept.get, pieces))
        if None in found:
            found = [self._ids(piece) if ids is None else ids for piece, ids in zip(pieces, found)]
        return b"".join(found)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per vocabulary and worker process, so that later tasks find what earlier ones kept."""
    return Encoder(path, pattern)


def _as_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))


class Decoder:
    """Gathers the bytes of ids from one table of all tokens."""

    def __init__(self, path: str):
        tokens = tokens_of(path)
        size = max(tokens) + 1
        self.lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self.known = np.array([i in tokens for i in range(size)])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)

    def decode(self, ids: pa.Array) -> pa.Array:
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.known) or not self.known[flat].all()):
            raise KeyError("an id is not in the vocabulary")
        parts = [self._bytes(flat[at : at + GATHERED]) for at in range(0, len(flat), GATHERED)]
        data = np.concatenate(parts) if parts else np.empty(0, np.uint8)
        ends = np.concatenate([[0], np.cumsum(self.lengths[flat])])
        counts = np.array([length or 0 for length in ids.value_lengths().to_pylist()], np.int64)
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def _bytes(self, flat: np.ndarray) -> np.ndarray:
        lengths = self.lengths[flat]
        before = np.cumsum(lengths) - lengths
        return self.table[np.repeat(self.starts[flat] - before, lengths) + np.arange(lengths.sum())]


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode_text(text: Column, path: str, pattern: str) -> Column:
    """The ids of each text as an array."""

    ship()

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(path, pattern).encode
        for batch in batches:
            yield _as_lists([encode(text.as_py() or "") for text in batch])

    return encoded(text)


def decode_ids(ids: Column, path: str) -> Column:
    """The bytes that the ids stand for."""

    ship()

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield decoder(path).decode(batch)

    return decoded(ids)


def encode_and_decode(text: Column, path: str, pattern: str) -> Column:
    """A struct of the ``ids`` of each text and the bytes they are ``decoded`` to, by one Python process a task."""

    ship()

    @F.arrow_udf("struct<ids:array<int>, decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, decode = encoder(path, pattern).encode, decoder(path).decode
        for batch in batches:
            ids = _as_lists([encode(text.as_py() or "") for text in batch])
            yield pa.StructArray.from_arrays([ids, decode(ids)], ["ids", "decoded"])

    return both(text)
