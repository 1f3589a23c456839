import hashlib
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from muster.llm import fingerprints
from muster.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def jaccard(a, b):
    a, b = (Counter(re.findall(r"\w+", text.lower())) for text in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def test_collisions_follow_generalised_jaccard():
    sampler, draw = fingerprints.Sampler(2048), np.random.default_rng(2)
    for repeats in (1, 2, 5):
        words = [f"w{i}" for i in range(60)]
        a = " ".join(word for word in words for _ in range(draw.integers(1, 9)))
        b = " ".join(word for word in words[20:] for _ in range(repeats)) + " " + a[: len(a) // 2]
        found = fingerprints.likeness(sampler.fingerprint(a), sampler.fingerprint(b))
        assert abs(found - jaccard(a, b)) < 0.05


def test_equal_texts_have_equal_fingerprints():
    texts = ["a b c", "x " * 5000, " ".join(f"w{i}" for i in range(9000))]
    small, large = fingerprints.Sampler(cached=5), fingerprints.Sampler()
    for text in texts + texts[::-1]:
        assert (small.fingerprint(text) == large.fingerprint(text)).all()
    assert not small.fingerprint("").any() and not small.fingerprint(" !").any()


def plain(pairs):
    """(id, characters, edited text's digest) of every row."""
    rows = sorted(((doc_id is not None, doc_id, text or "") for doc_id, text in pairs), key=lambda r: (r[0], r[1] or 0, r[2]))
    out = []
    for at, (_, doc_id, text) in enumerate(rows):
        following, n = rows[(at + 1) % len(rows)][2], len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    rows = fingerprints.compare_with_edits(frame).collect()
    assert all(0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1 for row in rows)
    return sorted(((row["doc_id"], row["n_chars"], row["edited_sha256"]) for row in rows), key=repr)


def test_successors(documents):
    pairs = [(i * 3 - 50, f"text {i} " * (i % 7 + 1)) for i in range(120)]
    assert got(documents(pairs)) == plain(pairs)


def test_odd_rows(documents):
    pairs = [(1, None), (2, ""), (2, ""), (3, "éà日本 text" * 9), (3, "b" * 40), (None, "null id"), (4, "long " * 40_000), (9, "abcd")]
    assert got(documents(pairs)) == plain(pairs)
    assert got(documents([(5, "alone here")])) == plain([(5, "alone here")])
    assert got(documents([])) == []


def test_column_and_query_agree(spark):
    rows = {row["doc_id"]: row for row in QUERIES["op8_fingerprints"](spark, SF).collect()}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(row["doc_id"], row["text"], row["f"]) for row in frame.select("doc_id", "text", fingerprints.fingerprint_text(F.col("text")).alias("f")).collect()]
    assert got(frame) == plain([(doc_id, text) for doc_id, text, _ in texts])
    order = sorted(texts)
    sampler = fingerprints.Sampler()
    for (doc_id, text, found), (_, following, _) in zip(order, order[1:] + order[:1]):
        own, row = sampler.fingerprint(text), rows[doc_id]
        assert own.tolist() == found and row["fingerprint"] == own.astype("<u4").tobytes().hex()
        assert row["near_next"] == fingerprints.likeness(own, sampler.fingerprint(following))
        changed = sampler.fingerprint(fingerprints.edited(text, following))
        assert row["near_edited"] == fingerprints.likeness(own, changed)


def test_two_texts_that_begin_alike():
    draw = np.random.default_rng(5)
    kinds = ["ab cd", "a_1 é-", "ΑΣ σ.ς'", "İi ß", " ", "日本 語", "x"]
    few, many = fingerprints.Sampler(64, cached=8), fingerprints.Sampler(64)
    for _ in range(1500):
        begin, one, other = ("".join(draw.choice(list(kinds[draw.integers(len(kinds))]), draw.integers(0, 15))) for _ in range(3))
        for sampler in (few, many):
            got = sampler.fingerprints(begin, one, other)
            assert (got[0] == many.fingerprint(begin + one)).all() and (got[1] == many.fingerprint(begin + other)).all(), (begin, one, other)


def test_draws_are_bounded():
    sampler = fingerprints.Sampler(16, cached=100)
    for i in range(50):
        sampler.fingerprint(" ".join(f"w{i * 7 + j} common" for j in range(20)))
        assert len(sampler.rows) <= 50 and len(sampler.draws) + len(sampler.draws_before) <= 100


def plain_draws(sampler, word, count):
    """The draws of one term, number by number."""
    gamma, log_gamma = fingerprints._tables()
    rows = []
    for stream in sampler.streams.tolist():
        x = (xxhash.xxh3_64_intdigest(word) + stream) % 2**64
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        x ^= x >> 31
        high, low = x >> 32, x % 2**32
        r, offset = gamma[high >> 16], np.float32(high % 2**16) * np.float32(2.0**-16)
        step = np.floor(np.float32(np.log(np.float64(count))) / r + offset)
        value = log_gamma[low >> 12] - r * (step - offset + np.float32(1))
        order = int(value.view(np.uint32))
        order = order ^ 0xFFFFFFFF if order >> 31 else order ^ 0x80000000
        rows.append(order << 32 | low ^ int(step) * 0x9E3779B1 % 2**32)
    return rows


def test_draws_equal_plain_ones_and_no_lookup_misses(monkeypatch):
    class Strict(fingerprints.Counter):
        def __missing__(self, word):
            raise AssertionError(word)

    monkeypatch.setattr(fingerprints, "Counter", Strict)
    for cached in (6, 1000):
        sampler, terms = fingerprints.Sampler(16, cached), [("a", 1), ("b", 3), ("c", 1), ("d", 700), ("b", 1), ("a", 2)]
        for some in (terms, terms[::-1], terms[2:4], [(f"w{i}", 1 + i % 3 // 2) for i in range(600)], terms):
            rows = sampler._rows(some + some[:1])
            assert rows[0] == rows[-1]
            assert sampler.draws[rows[:-1]].tolist() == [plain_draws(sampler, *term) for term in some]
        sampler.fingerprints("one two two ", "three two", "four one")
