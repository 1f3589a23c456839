import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from muster.llm import near_dup
from muster.llm.queries import QUERIES


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(pairs, size, percent=80):
    """(id, set size, component, kept) of every row, all pairs compared."""
    sets = [shingles(text, size) for _, text in pairs]
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    first = {}
    for i, (doc_id, _) in enumerate(pairs):
        if sets[i] and doc_id is not None:
            first[root(i)] = min(first.get(root(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(pairs):
        component = first.get(root(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, component == doc_id))
    return sorted(out, key=repr)


def got(frame, size):
    found = near_dup.near_duplicates(frame, shingle_words=size)
    rows = found.select("document.doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted((tuple(row) for row in rows), key=repr)


def edited(words, n, draw):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return words


def test_equals_all_pairs(documents):
    draw = random.Random(4)
    pairs = []
    for group in range(12):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.choice([5, 12, 60, 200]))]
        for _ in range(draw.choice([1, 2, 9])):
            pairs.append((len(pairs), " ".join(edited(base, draw.choice([0, 0, 1, 2, 4]), draw))))
    assert got(documents(pairs), 4) == plain(pairs, 4)
    assert got(documents(pairs), 5) == plain(pairs, 5)


def test_chain_whose_ends_differ(documents):
    words = [f"w{i}" for i in range(400)]
    pairs = [(i, " ".join(words[i * 12 : i * 12 + 200])) for i in range(14)]
    assert got(documents(pairs), 4) == plain(pairs, 4)
    assert {row[2] for row in got(documents(pairs), 4)} == {0}


def test_odd_rows(documents):
    long = " ".join(f"w{i % 9001}" for i in range(60_000))
    pairs = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "a b c d"), (6, "a b c d"), (None, "a  B\tc d")]
    pairs += [(None, "only here you see"), (8, long), (9, long + " end"), (10, "É a"), (11, "é a"), (12, "a\x0bb\x85c\x1cd e f g")]
    assert got(documents(pairs, clashing=False), 4) == plain(pairs, 4)
    assert got(documents(pairs), 4) == plain(pairs, 4)


def test_empty_table_and_columns(documents):
    assert got(documents([]), 4) == []
    frame = documents([(1, "a b c d e f"), (2, "a b c d e f")])
    assert near_dup.near_duplicates(frame).select("document.*").columns == frame.columns


def test_signatures_agree_as_often_as_sets(spark):
    signer, draw = near_dup.Signer(32, 4), np.random.default_rng(1)
    for size in (8, 60, 2000):
        same = []
        for _ in range(60):
            every = draw.integers(0, 2**63, size + size // 4, np.uint64)
            a, b = every[: size + size // 8], np.r_[every[: size - size // 8 + size // 8], every[size + size // 8 :]]
            jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            same.append((signer.band_keys(a) == signer.band_keys(b)).mean() - jaccard**4)
        assert abs(np.mean(same)) < 0.06


def test_contracted(spark):
    edges = [(i, i + 1) for i in range(40) if i != 20] + [(100, 7), (50, 60), (60, 50), (3, 3)]
    found = near_dup._contracted(spark.createDataFrame(edges, "a int, b int"))
    roots = {row["node"]: row["root"] for row in found.collect()}
    want = {**{i: 0 for i in range(1, 21)}, **{i: 21 for i in range(22, 41)}, 100: 0, 60: 50}
    assert roots == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    pairs = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op3_minhash_near_dedup"](spark, sf).select("doc_id", "n_shingles", "component_id", F.col("kept")).collect()
    assert sorted((tuple(row) for row in rows), key=repr) == plain(pairs, 4)


def test_blocks_are_bounded_by_shingles(spark):
    """300 classes of 100,000 shingles: every two meet, and no task holds more than a few million shingles."""
    names = F.sha2(F.col("id").cast("string"), 256).cast("binary")
    buckets = spark.range(300).select(F.lit(1).alias("band"), F.lit(7).alias("key"), names.alias("class"), F.lit(100_000).cast("long").alias("n"), names.alias("component"))
    groups = {}
    for row in near_dup._dealt(buckets).collect():
        groups.setdefault((row["low"], row["high"]), []).append(bytes(row["class"]))
    assert max(len(set(group)) for group in groups.values()) * 100_000 < 6_000_000
    assert all(len(set(group)) == len(group) for group in groups.values())
    met = {frozenset((a, b)) for group in groups.values() for a in group for b in group if a != b}
    assert len(met) == 300 * 299 // 2


def block(sets, bands, components=None):
    """Classes of one block of a bucket of band 1, as a task gets them."""
    names = [f"c{i:05d}".encode() for i in range(len(sets))]
    return pd.DataFrame({
        "band": 1, "low": 0, "high": 0, "block": 0, "class": names, "n": [len(s) for s in sets], "component": components or names,
        "bands": [np.array(b, np.int64) for b in bands], "shingles": [np.array(sorted(s), np.int64) for s in sets],
    })


def test_keys_that_are_alike_in_their_low_bits_are_other_keys():
    sets = [set(range(100)), set(range(5, 105))]
    apart = block(sets, [[7, 1], [7 + (1 << 40), 1]])
    assert len(near_dup._alike(apart, 80)) == 1
    # A pair that shares an earlier bucket is left to that one.
    assert near_dup._alike(block(sets, [[7, 1], [7, 1]]), 80) == []
    # So are shingles.
    assert near_dup._alike(block([set(range(100)), {x + (1 << 33) for x in range(100)}], [[1, 1], [2, 1]]), 80) == []


def test_links_of_a_block_are_a_forest():
    n = 600
    sets = [set(range(1000)) - {i} for i in range(n)]
    found = near_dup._alike(block(sets, [[i, 1] for i in range(n)]), 80)
    assert len(found) == n - 1
    chain = [set(range(i * 10, i * 10 + 100)) for i in range(300)]
    assert len(near_dup._alike(block(chain, [[i, 1] for i in range(300)]), 80)) == 299
    joined = [b"x" if i < 150 else b"y" for i in range(300)]
    assert len(near_dup._alike(block(chain, [[i, 1] for i in range(300)], joined), 80)) == 1


def test_groups_are_read_one_after_another_from_batches():
    """Groups of sorted rows come out whole wherever batches are cut, empty batches among them."""
    rows = pa.table({
        "band": pa.array([0, 0, 0, 0, 1, 1, 1], pa.int32()), "key": [5, 5, 5, -6, -6, -6, 1 << 60],
        "low": pa.array([0, 0, 0, 0, 0, 0, 0], pa.int32()), "high": pa.array([0, 0, 1, 1, 1, 1, 1], pa.int32()),
        "class": pa.array([b"a", b"b", b"c", b"d", b"e", b"f", b"g"]), "n": [1, 2, 0, 3, 1, 1, 2],
        "component": pa.array([b"a", b"b", b"c", b"d", b"e", b"f", b"g"]), "block": pa.array([0] * 7, pa.int32()),
        "bands": [[i, i + 1] for i in range(7)], "shingles": [[1], [1, 2], [], [4, 5, 6], [7], [8], [9, 10]],
    })
    for size in (1, 2, 3, 4, 7):
        batches = rows.to_batches(max_chunksize=size)
        found = list(near_dup._groups(iter([batches[0].slice(0, 0), *batches, batches[0].slice(0, 0)])))
        assert [group["class"] for group in found] == [[b"a", b"b"], [b"c"], [b"d"], [b"e", b"f"], [b"g"]], size
        assert [x.tolist() for group in found for x in group["shingles"]] == rows["shingles"].to_pylist()
        assert [x.tolist() for group in found for x in group["bands"]] == rows["bands"].to_pylist()
    assert list(near_dup._groups(iter([]))) == []


def test_blocks_are_compared_as_streams(spark):
    """One Python call a batch and not one a bucket: what stars leave are mostly buckets of a few classes."""
    same = [[i * 1000 + x for x in range(100)] for i in range(40)]
    sets, buckets = [], []
    for i, one in enumerate(same):
        for copy in range(3):
            name = f"{i:03d}{copy}".encode()
            sets.append((name, [i, copy], one[copy:] if copy < 2 else [x + 500 for x in one]))
            buckets.append((0, i, name, len(sets[-1][2]), 1, name))
    small = spark.createDataFrame(sets, "class binary, bands array<long>, shingles array<long>")
    live = spark.createDataFrame(buckets, "band int, key long, class binary, n long, copies long, component binary")
    found = near_dup._block_pairs(live, small, 80)
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert {frozenset((bytes(r["class"]), bytes(r["centre"]))) for r in found.collect()} == {
        frozenset((f"{i:03d}0".encode(), f"{i:03d}1".encode())) for i in range(40)
    }


def test_hot_buckets_and_roots_are_split(spark):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in low}
    for name, value in low.items():
        spark.conf.set(name, value)
    try:
        name = F.sha2(F.col("id").cast("string"), 256)
        hot = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
        live = spark.range(20_000).select(
            F.lit(1).alias("band"), hot.alias("key"), name.alias("class"), F.lit(9).alias("n"), F.lit(1).alias("copies"), name.alias("component"), F.lit(1).alias("size")
        )
        edges = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") + 100_000).alias("a"), F.col("id").alias("b"))
        for frame in (near_dup._with_centres(live, 0), near_dup._star(edges, larger=True), near_dup._dealt(live)):
            frame.collect()
            assert "SortMergeJoin(skew=true)" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
