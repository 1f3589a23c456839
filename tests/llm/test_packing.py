import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from muster.llm import packing
from muster.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WORDS = tokenizer_path("word_bpe_49k.json")


def check_sequences(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def plain_best_fit(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [gap for gap in gaps if gap >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("rows_per_task", [40, 10_000])
def test_as_few_sequences_as_best_fit(spark, rows_per_task):
    random.seed(2)
    lengths = [random.choice([1, 3, 7, 33, 50, random.randint(1, 100)]) for _ in range(600)] + [100, 100, 51]
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.PIECE)
    rows = packing.pack(pieces, 100, rows_per_task).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == sorted(enumerate(lengths))
    assert check_sequences(rows, 100) <= plain_best_fit(lengths, 100) * 1.02


def test_pieces_that_share_nothing(spark):
    pieces = spark.createDataFrame([(i, 0, 0, 60, 0) for i in range(30)], packing.PIECE)
    assert check_sequences(packing.pack(pieces, 100, 7).collect(), 100) == 30


def test_rows_given_twice_and_ties(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 10, 5)] * 25 + [(None, 0, 0, 10, 5)] * 5, packing.PIECE)
    rows = packing.pack(pieces, 100, 6).collect()
    assert len(rows) == 30 and check_sequences(rows, 100) == 3


def test_odd_texts(documents):
    texts = [None, "", " \n", "a", "a b\tc. D", "word " * 9000, "É J̌ don't <|endoftext|>"]
    frame = documents([(i, text) for i, text in enumerate(texts)] + [(None, "a")])
    rows = packing.pack_documents(frame, WORDS).collect()
    check_sequences(rows, 4096)
    tokenizer = packing._tokenizer(WORDS)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(p, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for p, at in enumerate(range(0, len(ids), 4096))]
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i)
        assert mine == want
    assert sum(r["doc_id"] is None for r in rows) == 1


def test_ids_are_the_tokenizers():
    random.seed(3)
    tokenizer, words = packing._tokenizer(WORDS), packing.WordIds(WORDS)
    kinds = ["ab", "aB C.,'s", "J̌j é́ Å", "İßΣς σ", "日本 \u200b\ufeff", "\x85\x1c\x00  a", "<|endoftext|> 1", "don't I'LL. a!", " \t\n"]
    for _ in range(3000):
        text = "".join(random.choice(random.choice(kinds)) for _ in range(random.randint(0, 20)))
        assert words.of_text(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_special_tokens_written_out():
    random.seed(4)
    plain, words = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    kinds = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>.", "<|", "|>", "aB", "É", "\u0301", " ", "."]
    for _ in range(3000):
        text = "".join(random.choice(kinds) for _ in range(random.randint(0, 9)))
        assert words.of_text(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    assert words.of_text("<|endoftext|>") == np.array([49407], "<u4").tobytes()


def test_plain_words_go_straight_to_the_model(monkeypatch):
    plain, words = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    texts = ["Inonedtien geschachsch hantheeao", "ßÀÖØöøÿß él$$$ rouge'; ÉQUEÊ.\u00a0Çà (ü]^`{~", "K\u0130 ªº ×a÷ a\u0301 \u0178 \u212a don't l'eau x's' 7a <|endoftext|>a"]
    for text in texts:
        assert words.of_text(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    met = []

    class Counted:
        def encode(self, text, **how):
            met.append(text)
            return plain.encode(text, **how)

    monkeypatch.setattr(words, "tokenizer", Counted())
    words.of_text("unbekanntes ßÀÖØöøÿ gehörtes, nirgends")
    assert met in ([], [","])


def test_empty_table(documents):
    assert packing.pack_documents(documents([]), WORDS).collect() == []


def test_query(spark):
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    tokens = sum(row["length"] for row in rows)
    assert check_sequences(rows, 4096) <= -(-tokens // 4096) + 1
    assert {row["doc_id"] for row in rows} == set(range(200))
