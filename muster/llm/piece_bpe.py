"""Encoding by the merges of a SentencePiece BPE model, by longest matches and backtracking, and decoding.

The library's own rule is: start from single characters and keep merging the two neighbours whose union is the piece
of highest score, the leftmost of equal ones. Its result is the one sequence of pieces in which every two neighbours
are compatible, that is, merging the text of the two anew gives these two again. So an Aho-Corasick automaton finds the
pieces that stand at every place; from the left the longest one is taken that is compatible with the piece before it, and
where none is, the last piece is given up for the next shorter one. (Mostly the longest matches are compatible
throughout, which is tried first.) A place can be reached in one way only, so one from which no way led on is marked in
a bitfield and never entered again. Compatibility is memoised; the work is linear in the text.

The text is first normalised by the library (white space to U+2581, one put before the text). Then it is cut where no
piece of the model reaches across: before white space, and around control characters that are in no longer piece. The
parts are encoded one by one and memoised up to a bound in bytes, per worker process. A character that no piece
has becomes one piece for each of its UTF-8 bytes.

Models: BPE with byte fallback that put a blank before the text and keep repeated blanks, without symbols defined by
the user; any other fails at loading where that can be told. The model is read where the task runs, by its path.

Defined results: a null or empty text has no ids, and null ids decode to the empty text; ids that the model lacks
fail; byte pieces that are no UTF-8 decode to one U+FFFD each; control pieces to nothing. Rows, repeated ones too,
keep their number; further columns are not touched.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ship

#: Fixed: the character that stands for a blank, what an unknown piece and a wrong byte are shown as.
BLANK, UNKNOWN, REPLACEMENT = "▁", " ⁇ ", "�"
#: Parts of a text that are kept with their ids: those up to so many characters, and so many bytes of them in all.
CACHED_CHARACTERS = 48
CACHED_BYTES = 80 << 20
#: About what an entry takes besides its characters and ids.
ENTRY_BYTES = 150


class Pieces:
    """The pieces of a model, how they merge, and which may stand side by side.

    A character that has no piece of its own is numbered beyond the pieces, by its code point.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = library.normalize
        if self.normalize(" a  b ") != f"{BLANK}{BLANK}a{BLANK}{BLANK}b{BLANK}":
            raise ValueError("the model does not keep blanks as they are behind one put first")
        self.size = library.get_piece_size()
        self.names = [library.id_to_piece(i) for i in range(self.size)]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(self.size) if library.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte fallback")
        self.control = frozenset(i for i in range(self.size) if library.is_control(i))
        self.unknown = library.unk_id()
        inert = self.control | {self.unknown, *self.bytes.values()}
        plain = [i for i in range(self.size) if i not in inert and not library.is_unused(i)]
        self.scores = {self.names[i]: library.get_score(i) for i in plain}
        self.ids = {self.names[i]: i for i in plain}
        self.compatible = lru_cache(maxsize=200_000)(self._compatible)
        # A piece that its own characters do not merge to never comes out.
        self.whole = {name: i for name, i in self.ids.items() if len(name) == 1 or self.merge(name) == [name]}
        self.automaton = ahocorasick.Automaton()
        for name, i in self.whole.items():
            self.automaton.add_word(name, i)
        self.automaton.make_automaton()
        self.lengths = [len(name) for name in self.names]
        self.most = max(map(len, self.whole))
        self.shorter = [self._shorter(name) for name in self.names]
        self.pairs = {pair for name in self.ids for pair in zip(name, name[1:])}
        self.parts = self._parts_pattern().findall

    def _parts_pattern(self) -> re.Pattern:
        longer = [name for name in self.ids if len(name) > 1]
        used = set("".join(longer))
        alone = "".join(c for c in "\n\t\r" if c not in used)
        if any(BLANK in name.lstrip(BLANK) for name in longer):
            return re.compile(f"[{alone}]|[^{alone}]+" if alone else "(?s).+")
        return re.compile((f"[{alone}]|" if alone else "") + f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+")

    def _shorter(self, name: str) -> int:
        """The next shorter piece that a piece starts with; a character without a piece of its own; else -1."""
        for length in range(len(name) - 1, 0, -1):
            if name[:length] in self.whole:
                return self.whole[name[:length]]
        return self.size + ord(name[0]) if len(name) > 1 else -1

    def merge(self, text: str) -> list[str]:
        """The pieces that the characters of a text merge to, found step by step."""
        score, lowest = self.scores.get, float("-inf")
        parts = list(text)
        scores = [score(a + b, lowest) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == lowest:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], lowest)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], lowest)
        return parts

    def cut(self, part: str) -> list[str]:
        """The part cut between characters that stand side by side in no piece, where no merge can lead across."""
        if part[1:].isalpha():
            # Mostly there is no such place inside a word.
            return [part]
        cuts = [i for i, pair in enumerate(zip(part, part[1:]), 1) if pair not in self.pairs]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])] if cuts else [part]

    def name(self, piece: int) -> str:
        return self.names[piece] if piece < self.size else chr(piece - self.size)

    def _compatible(self, left: int, right: int) -> bool:
        two = [self.name(left), self.name(right)]
        return self.merge("".join(two)) == two

    def encode(self, part: str) -> list[int]:
        """The ids of a part of a normalised text."""
        whole = self.whole.get(part)
        if whole is not None:
            return [whole]
        longest = [piece for _, piece in self.automaton.iter_long(part)]
        lengths = self.lengths
        if sum([lengths[piece] for piece in longest]) < len(part):
            # Some characters have no piece.
            longest = self._backtracked(part, [], self._longest(part, 0))
            return [i for piece in longest for i in self._shown(piece)]
        for at, fits in enumerate(map(self.compatible, longest, longest[1:]), 1):
            if not fits:
                return self._backtracked(part, longest[:at], self.shorter[longest[at]])
        return longest

    def _shown(self, piece: int) -> list[int]:
        """The ids of a piece; a character without one is spelled in bytes."""
        return [piece] if piece < self.size else [self.bytes[byte] for byte in chr(piece - self.size).encode()]

    def _longest(self, part: str, at: int) -> int:
        """The longest piece that stands at a place."""
        rest = part[at : at + self.most]
        for length in range(self.automaton.longest_prefix(rest), 0, -1):
            piece = self.whole.get(rest[:length])
            if piece is not None:
                return piece
        return self.size + ord(rest[0])

    def _backtracked(self, part: str, pieces: list[int], piece: int) -> list[int]:
        """The pieces of a part, given compatible ones that it may start with and what to try next, -1 for nothing."""
        size, failed = len(part), bytearray(len(part) // 8 + 1)
        names, compatible, shorter = self.size, self.compatible, self.shorter
        at = sum([self.lengths[i] for i in pieces])
        while True:
            while piece >= 0:
                then = at + (self.lengths[piece] if piece < names else 1)
                if not failed[then >> 3] >> (then & 7) & 1 and (not pieces or compatible(pieces[-1], piece)):
                    break
                piece = shorter[piece] if piece < names else -1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                last = pieces.pop()
                at -= self.lengths[last] if last < names else 1
                piece = shorter[last] if last < names else -1
                continue
            pieces.append(piece)
            at = then
            if at == size:
                return pieces
            piece = self._longest(part, at)


class Coder:
    """Encodes and decodes whole texts, and keeps the ids of parts as 32-bit numbers."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        # What was met lately, and what was met before that; the latter makes room when the former is full.
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.kept_bytes = 0
        size, names = self.pieces.size, self.pieces.names
        self.shown = [name.replace(BLANK, " ").encode() for name in names]
        self.byte_of = {i: byte for byte, i in self.pieces.bytes.items()}
        for i, byte in self.byte_of.items():
            self.shown[i] = bytes([byte])
        self.shown[self.pieces.unknown] = UNKNOWN.encode()
        for i in self.pieces.control:
            self.shown[i] = b""
        self.opens = frozenset(i for i in range(size) if names[i].startswith(BLANK))

    def _ids(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            cut = self.pieces.cut(part)
            if len(cut) > 1:
                ids = b"".join([self.kept.get(piece) or self._ids(piece) for piece in cut])
            else:
                ids = array("i", self.pieces.encode(part)).tobytes()
        if len(part) <= CACHED_CHARACTERS:
            self.kept_bytes += ENTRY_BYTES + 4 * len(part) + len(ids)
            if self.kept_bytes > CACHED_BYTES // 2:
                self.before, self.kept, self.kept_bytes = self.kept, {}, 0
            self.kept[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        parts = self.pieces.parts(self.pieces.normalize(text))
        found = list(map(self.kept.get, parts))
        if None in found:
            found = [self._ids(part) if ids is None else ids for part, ids in zip(parts, found)]
        return b"".join(found)

    def decode(self, ids: list[int]) -> str:
        """The text that the ids stand for; the blank that was put first goes."""
        if not ids:
            return ""
        if min(ids) < 0:
            raise IndexError("negative id")
        if ids[0] in self.opens:
            try:
                return b"".join(map(self.shown.__getitem__, ids))[1:].decode()
            except UnicodeDecodeError:
                pass
        return self._decode_slowly(ids)

    def _decode_slowly(self, ids: list[int]) -> str:
        out, spelled = [], bytearray()
        opening = True
        for i in [*ids, None]:
            if i in self.byte_of:
                spelled.append(self.byte_of[i])
                continue
            if spelled:
                out.append(_spelled(bytes(spelled)))
                spelled.clear()
            if i is None:
                break
            text = self.shown[i].decode()
            # One blank goes, if nothing has been shown before it.
            opening = opening and not any(out)
            drops = opening and i in self.opens
            out.append(text[1:] if drops else text)
            opening = opening and not drops
        return "".join(out)


def _spelled(data: bytes) -> str:
    """UTF-8 bytes as text, each byte that is part of no character as one sign."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(REPLACEMENT)
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder per model and worker process, so that later tasks find what earlier ones kept."""
    return Coder(path)


def _as_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode_text(text: Column, path: str) -> Column:
    """The ids of each text as an array."""
    ship()

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = coder(path).encode
        for batch in batches:
            yield _as_lists([encode(text.as_py() or "") for text in batch])

    return encoded(text)


def decode_ids(ids: Column, path: str) -> Column:
    """The text that the ids stand for."""
    ship()

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = coder(path).decode
        for batch in batches:
            yield pa.array([decode(row.as_py() or []) for row in batch], pa.string())

    return decoded(ids)


def encode_and_decode(text: Column, path: str) -> Column:
    """A struct of the ``ids`` of each text and the text they are ``decoded`` to, by one Python process a task."""
    ship()

    @F.arrow_udf("struct<ids:array<int>, decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = coder(path)
        for batch in batches:
            ids = [own.encode(text.as_py() or "") for text in batch]
            texts = pa.array([own.decode(np.frombuffer(row, np.int32).tolist()) for row in ids], pa.string())
            yield pa.StructArray.from_arrays([_as_lists(ids), texts], ["ids", "decoded"])

    return both(text)
