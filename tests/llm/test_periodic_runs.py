import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from muster.llm import periodic_runs
from muster.llm.periodic_runs import find_runs, longest_run, planted, segments
from muster.llm.queries import QUERIES


def brute(words, least=12):
    """Every lag and place tried; of equal stretches the smallest period counts."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start < len(words) - period:
            end = start
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(least, 2 * period):
                found.setdefault((start, length), period)
            start = max(end, start + 1)
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_of(words, least=12):
    return periodic_runs.periodic_runs(np.array(words, np.int64), least)


def test_equals_brute_force(monkeypatch):
    draw, met = random.Random(5), 0
    for turn in range(1500):
        monkeypatch.setattr(periodic_runs, "PORTION", 1 << 20 if turn % 2 else 7)
        words = [draw.randrange(draw.choice([1, 2, 3, 20])) for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 4)):
            unit = [draw.randrange(draw.choice([2, 3, 50])) for _ in range(draw.randint(1, 15))]
            at = draw.randint(0, len(words))
            words[at:at] = (unit * draw.randint(2, 6))[: draw.randint(len(unit), 6 * len(unit))]
        least = draw.choice([12, 12, 1, 2, 5])
        want = brute(words, least)
        assert runs_of(words, least) == want, (words, least)
        met += len(want)
    assert met > 4_000


def test_sums_that_clash(monkeypatch):
    """The runs are right even if the sums tell no blocks apart."""
    monkeypatch.setattr(periodic_runs, "_sums", lambda ids: (np.zeros(len(ids) + 1, np.uint64), np.ones(len(ids) + 1, np.uint64)))
    draw = random.Random(6)
    for _ in range(100):
        words = [draw.randrange(3) for _ in range(60)]
        assert runs_of(words, 5) == brute(words, 5)


def test_splitting_is_stable():
    draw = random.Random(7)
    for _ in range(500):
        words = [draw.randrange(60) for _ in range(draw.randint(0, 150))]

        def plain(start, end):
            here = words[start:end]
            alone = [start + i for i, word in enumerate(here) if here.count(word) == 1]
            if not alone:
                return [(start, end)] if end - start >= 4 else []
            cuts = [start - 1, *alone, end]
            return [s for a, b in zip(cuts, cuts[1:]) for s in plain(a + 1, b)]

        assert segments(np.array(words, np.int64), 4) == plain(0, len(words))


def test_long_texts_take_little_time():
    a, b = [0], [0, 1]
    while len(b) < 200_000:
        a, b = b, b + a
    nested = [0]
    for i in range(1, 16):
        nested = nested + [i] + nested
    draw = np.random.default_rng(1)
    texts = [b, np.zeros(500_000, int), draw.integers(0, 2, 200_000), np.tile(np.arange(999), 500), nested]
    texts += [np.concatenate([np.arange(100_000), np.arange(100_000)[::-1]]), draw.integers(0, 2000, 500_000)]
    began = time.perf_counter()
    assert runs_of(texts[1]) == [(0, 500_000, 1)]
    assert runs_of(texts[3]) == [(0, 499_500, 999)]
    assert all(length >= max(12, 2 * period) for words in texts for _, length, period in runs_of(words))
    assert time.perf_counter() - began < 60


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    runs = brute([numbers[word] for word in words])
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


PLANTED = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
ODD = [None, "", " \n\t", "a", "a " * 11, "a " * 12, "a\x0bb\x85c \xa0d " * 9, "x y z " * 7 + "x y q", "é\x1cü " * 6, "ab " * 2_000]


def test_odd_rows(documents):
    pairs = [(1000 + i, text) for i, text in enumerate(ODD)]
    pairs += list(zip(PLANTED, [*ODD[:7], "one two three four five six seven eight nine ten", "q"])) + [(None, "a " * 12), (3, "b"), (3, "b")]
    frame = documents(pairs).withColumns({"runs": F.lit(1), "found": F.lit(2), "start": F.lit(3)})
    assert frame.select("n_lines", find_runs(F.col("text"))).count() == len(pairs)
    found = planted(frame).select("doc_id", find_runs(F.col("text")).alias("got"))
    rows = found.select("doc_id", "got", longest_run(F.col("got.runs")).alias("best")).collect()
    assert len(rows) == len(pairs)
    got = sorted(
        (str(row["doc_id"]), [tuple(run) for run in row["got"]["runs"]], row["got"]["collapsed"], tuple(row["best"] or (None,) * 3)) for row in rows
    )
    assert [row[0] for row in got] == sorted(str(doc_id) for doc_id, _ in pairs)
    want = {str(doc_id): plain_row(doc_id, text) for doc_id, text in pairs if doc_id is not None}
    for doc_id, runs, collapsed, best in got:
        if doc_id == "None":
            assert (runs, collapsed, best) == ([(0, 12, 1)], "a", (0, 12, 1))
            continue
        assert (len(runs), *best) == want[doc_id][1:5]
        assert hashlib.sha256(collapsed.encode()).hexdigest() == want[doc_id][-1]


def test_empty_table(documents):
    assert documents([]).select(find_runs(F.col("text"))).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    frame = QUERIES["op12_periodic_runs"](spark, sf)
    assert dict(frame.dtypes) == {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
        "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    }
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {row["doc_id"]: plain_row(row["doc_id"], row["text"]) for row in texts if len(row["text"] or "") < 8_000}
    assert len(want) > 0.8 * len(texts)
    got = {row["doc_id"]: tuple(row) for row in frame.collect()}
    assert len(got) == len(texts)
    assert {doc_id: got[doc_id] for doc_id in want} == want
    assert any(row[1] for row in want.values())


@pytest.mark.parametrize("rows", [3, 50])
def test_batches_of_any_size(spark, documents, rows):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        frame = documents([(i, f"w{i} " + "a b c " * (i % 7)) for i in range(100)])
        got = frame.select("doc_id", find_runs(F.col("text"))["runs"]).collect()
    finally:
        spark.conf.set(setting, before)
    assert all([tuple(run) for run in runs] == brute((f"w{i} " + "a b c " * (i % 7)).split()) for i, runs in got)
