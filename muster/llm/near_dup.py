"""Near-duplicate documents by one-permutation MinHash, star-shaped candidates and exact confirmation.

1. A text becomes its set of shingles (hashed to 64 bits). One pass over the set fills the bins of a signature
   with the smallest hash that falls into each; an empty bin borrows from the first filled one in an order of its
   own (optimal densification). Equal sets form a class, which goes on as one.
2. The signature is cut into bands; classes that agree in a band share a bucket. A bucket of n classes gives n - 1
   candidate pairs, a star: each class with the bucket's centre.
3. A pair is confirmed on its full sets. Links make components, by alternating star contractions on tables.
4. Two classes of a bucket may be alike though neither is like the centre. So a second star is drawn, with another
   centre, in buckets whose classes are not all in one component yet, and only to classes of other components. The
   first centres are the classes of most copies, the likely originals of the others; later ones are classes of the
   smallest components.
5. What two stars leave is compared exactly: buckets that still have several components are cut into blocks of
   bounded size, and the classes of two blocks are compared inside a task, each pair in the first bucket it
   shares. Only links that join two components come out, a forest at most. So no two classes that share a bucket and are
   alike end in different components.

With the defaults a pair at the threshold of 0.8 shares a bucket with probability 1 - (1 - 0.8^5)^40 > 0.9999998,
and 13 buckets on average. No bucket, class or component is capped. Classes, buckets, pairs and components live in
tables; the driver sees counts only.

Defined results: a text without words, an empty or a null one has an empty set, which is linked with nothing. A text of
fewer words than a shingle is one shingle. A component's id is its smallest document id (ids that are null are
left out; a component of such documents alone has none). Rows given twice, or sharing an id, are each returned.
An empty table gives an empty result. Further columns come back inside ``document``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import removed, ship, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 40
ROWS_PER_BAND = 5
STAR_ROUNDS = 2
#: Classes that are compared with each other in a task, at most twice as many.
BLOCK_CLASSES = 512
#: Shingles of the classes of a block, about; a class is not cut.
BLOCK_SHINGLES = 1_000_000

class Shingler:
    """Sets of shingle hashes of texts."""

    def __init__(self, words: int):
        self.words = words

    def shingles(self, text: str | None) -> np.ndarray:
        """The distinct shingles' hashes in ascending order."""
        # Without arguments bytes are split at, and lowered in, ASCII alone.
        found = (text or "").encode().lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        if len(found) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
        # To look up a word's hash takes as long as to hash it.
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        n = len(words) - self.words + 1
        value = np.zeros(n, np.uint64)
        for at in range(self.words):
            value = (value ^ words[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(32)
        value.sort()
        first = np.ones(n, bool)
        np.not_equal(value[1:], value[:-1], out=first[1:])
        return value[first]


class Signer:
    """Band keys of sets."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, bins = bands, rows, bands * rows
        draws = np.random.Generator(np.random.PCG64(20))
        self.bins = bins
        self.donors = np.argsort(draws.random((bins, bins)), axis=1)
        self.weights = draws.integers(1, 2**63, (rows,), np.uint64) * np.uint64(2) + np.uint64(1)

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        mixed = shingles * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        bins = (mixed % np.uint64(self.bins)).astype(np.int64)
        signature = np.full(self.bins, 2**64 - 1, np.uint64)
        np.minimum.at(signature, bins, mixed // np.uint64(self.bins))
        filled = np.zeros(self.bins, bool)
        filled[bins] = True
        if not filled.all():
            empty = np.flatnonzero(~filled)
            order = self.donors[empty]
            signature[empty] = signature[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
        keys = (signature.reshape(self.bands, self.rows) * self.weights).sum(axis=1, dtype=np.uint64)
        keys ^= keys >> np.uint64(29)
        return (keys * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


SKETCH_TYPE = "struct<n:long, class:binary, bands:array<long>>"


def sketch(text: Column, shingle_words: int, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> Column:
    """Size of the set, a 128-bit digest of it, and the key of each band; no digest for the empty set."""
    kind = pa.struct([("n", pa.int64()), ("class", pa.binary()), ("bands", pa.list_(pa.int64()))])

    ship()

    @F.arrow_udf(SKETCH_TYPE)
    def sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingler, signer = Shingler(shingle_words), Signer(bands, rows)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for value in batch:
                found = shingler.shingles(value.as_py())
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(signer.band_keys(found) if len(found) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                fields=list(kind),
            )

    return sketches(text)


def shingle_sets(text: Column, shingle_words: int) -> Column:
    """The shingles' hashes of each text."""

    ship()

    @F.arrow_udf("array<long>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingler = Shingler(shingle_words)
        for batch in batches:
            yield pa.array([shingler.shingles(v.as_py()).view(np.int64) for v in batch], pa.list_(pa.int64()))

    return sets(text)


def near_duplicates(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows_per_band: int = ROWS_PER_BAND,
    star_rounds: int = STAR_ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``document`` (the row as given), ``n_shingles``, ``component_id`` and ``kept``: it is its component's first."""
    percent = round(threshold * 100)
    row = F.xxhash64(id_column, text_column)
    sketches = written(
        documents.select(
            F.col(id_column).alias("id"), row.alias("row"), sketch(F.col(text_column), shingle_words, bands, rows_per_band).alias("s")
        ).select("id", "row", "s.n", "s.class", "s.bands"),
        "sketches",
    )
    classes = written(
        sketches.where("n > 0")
        .groupBy("class")
        .agg(
            F.min("id").alias("first_id"),
            F.min("row").alias("row"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    members = _bucket_members(classes, percent)
    sets = _member_sets(documents, classes, members, row, shingle_words, text_column)
    components = _linked(members, sets, percent, star_rounds)
    firsts = (
        classes.select("class", "first_id")
        .join(components, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = _aside(firsts.where("first_id IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("component_id")))
    by_class = firsts.select("class", "component").join(smallest, "component", "left").select("class", "component_id")
    judged = sketches.select("id", "row", "n", "class").join(by_class, "class", "left")
    judged = judged.select(
        "id", "row", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )
    # Rows of one id and text have one result, and it finds them again.
    found = judged.groupBy("row").agg(F.first("n").alias("n"), F.first("component_id").alias("component_id"))
    slim = all(name in (id_column, text_column) for name in documents.columns)
    if slim:
        return judged.select(
            F.struct(F.col("id").alias(id_column)).alias("document"), *_verdict(F.col("id"))
        )
    whole = documents.select(F.struct("*").alias("document"), row.alias("row"))
    return whole.join(found, "row").select("document", *_verdict(F.col(f"document.{id_column}")))


def _verdict(id_: Column) -> list[Column]:
    kept = F.coalesce(F.col("component_id") == id_, F.col("component_id").isNull() & id_.isNull())
    return [F.col("n").alias("n_shingles"), F.col("component_id"), kept.alias("kept")]


def _aside(aggregate: DataFrame) -> DataFrame:
    """An aggregate that is to meet the rows it was made from, as a table of its own.

    A table joined with an aggregate of its own key keeps that key's partitioning, so all rows of a hot key would stay on one
    task. With the aggregate written first they are dealt out anew, and Spark splits the join where it is hot.
    """
    return written(aggregate, "aggregate")


def _bucket_members(classes: DataFrame, percent: int) -> DataFrame:
    """Band buckets that hold more than one class: ``band``, ``key``, ``class``, ``n``, ``copies``."""
    everyone = classes.select("class", "n", "copies", F.posexplode("bands").alias("band", "key"))
    members = everyone.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members"))
    shared = _aside(members.where("members > 1").select("band", "key"))
    return written(everyone.join(shared, ["band", "key"], "left_semi"), "members")


def _member_sets(
    documents: DataFrame, classes: DataFrame, members: DataFrame, row: Column, shingle_words: int, text_column: str
) -> DataFrame:
    """The full sets of the classes that have candidates, each from one document of the class."""
    wanted = members.select("class").distinct().join(classes.select("class", "row", "bands"), "class")
    texts = documents.select(row.alias("row"), F.col(text_column).alias("text"))
    # A row given several times is found several times, by the same task.
    found = texts.join(wanted, "row").dropDuplicates(["row"])
    return written(found.select("class", "bands", shingle_sets(F.col("text"), shingle_words).alias("shingles")), "sets")


def _with_centres(live: DataFrame, turn: int) -> DataFrame:
    """The classes of each bucket that has several components, with a centre for it.

    The first centre is the class of most copies. Later it is one by chance among the classes of the smallest
    components: those have found the fewest links so far, and a centre is compared with its whole bucket.
    """
    chance = F.xxhash64(F.lit(turn), "band", "class")
    weight = F.col("copies") if turn == 0 else -F.col("size")
    centres = live.groupBy("band", "key").agg(
        F.max(F.struct(weight.alias("weight"), chance.alias("chance"), "class", "n", "component")).alias("centre"),
        F.min("component").alias("one"),
        F.max("component").alias("other"),
    )
    return live.join(_aside(centres.where("one != other").drop("one", "other")), ["band", "key"])


def _linked(members: DataFrame, sets: DataFrame, percent: int, star_rounds: int) -> DataFrame:
    """Components of the classes in ``members``: ``class``, ``component`` and its ``size`` in classes."""
    single = members.select("class").distinct()
    components = written(single.withColumns({"component": F.col("class"), "size": F.lit(1).cast("long")}), "components")
    buckets, before = members, None
    for turn in range(star_rounds + 1):
        # Buckets that have become one component are done with.
        now = written(_with_centres(buckets.join(components, "class"), turn), "buckets")
        if before is not None:
            removed(before)
        buckets, before = now.select("band", "key", "class", "n", "copies"), now
        pairs = _star_pairs(now, percent) if turn < star_rounds else _block_pairs(now, sets, percent)
        links = written(_confirmed(pairs, sets, percent), "links")
        if links.limit(1).count():
            after = written(_merged(components, links), "components")
            removed(components)
            components = after
        removed(links)
    return components


def _star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Each class with its bucket's centre, if they are of different components and of like size."""
    return (
        buckets.where("component != centre.component")
        .select("class", "n", F.col("centre.class").alias("centre"), F.col("centre.n").alias("centre_n"))
        .where(100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n"))
        .distinct()
    )


def _block_pairs(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What stars have left: links between different components in a bucket whose sets are alike.

    A bucket is cut into blocks of about as many classes and shingles as a task can hold, and two blocks at a time are compared inside a task.
    What comes out of a task is a forest: a pair that earlier links of the task have joined is not looked at. A pair is compared in the
    first bucket that it shares. Most of these groups are of a few classes, so a task reads them one after another from sorted rows.
    """
    ship()
    small = sets.select("class", "bands", "shingles")
    kind = pa.schema([("class", pa.binary()), ("n", pa.int64()), ("centre", pa.binary()), ("centre_n", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if links := _alike(group, percent):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*links), kind.types)], schema=kind)

    return (
        _dealt(buckets).join(small, "class")
        .select(*GROUP, "class", "n", "component", "block", "bands", "shingles")
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInArrow(compare, "class binary, n long, centre binary, centre_n long")
        .distinct()
    )


#: What the rows that a task compares with each other have in common.
GROUP = ["band", "key", "low", "high"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The columns of one group of sorted rows after another; a group may go on in the next batch."""
    name, group = None, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch[column].to_numpy().astype(np.int64) for column in GROUP])
        starts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        columns = {column: batch[column].to_pylist() for column in (*GROUP, "class", "n", "component", "block")}
        for column in ("bands", "shingles"):
            ends, values = batch[column].offsets.to_numpy(), batch[column].values.to_numpy()
            columns[column] = [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for first, last in zip(starts[:-1], starts[1:]):
            part = {column: values[first:last] for column, values in columns.items()}
            if (here := tuple(at[:, first].tolist())) == name:
                group = {column: group[column] + part[column] for column in part}
                continue
            if group:
                yield group
            name, group = here, part
    if group:
        yield group


def _dealt(buckets: DataFrame) -> DataFrame:
    """The classes of each bucket, once for every two blocks, ``low`` and ``high``, of which one is theirs."""
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_CLASSES, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = buckets.groupBy("band", "key").agg(blocks.alias("blocks"))
    placed = buckets.select("band", "key", "class", "n", "component").join(_aside(sizes), ["band", "key"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "key", "class", "n", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def _alike(group: pd.DataFrame | dict[str, list], percent: int) -> list[tuple]:
    """Links of a block, or between two blocks, that join different components whose sets are alike, and no circle of them."""
    band, low, high = (int(list(group[name])[0]) for name in ("band", "low", "high"))
    rows, bands = list(group["shingles"]), list(group["bands"])
    order = sorted(range(len(rows)), key=lambda row: len(rows[row]))
    keys = np.stack([bands[row] for row in order])[:, :band]
    sizes = np.array([len(rows[row]) for row in order])
    blocks = np.array(list(group["block"]))[order]
    numbers: dict[bytes, int] = {}
    components = np.array([numbers.setdefault(component, len(numbers)) for component in group["component"]])[order]
    # Of most classes no pair is left to compare, so a set is made when it is met.
    sets: list[frozenset | None] = [None] * len(rows)

    def set_of(row: int) -> frozenset:
        if (made := sets[row]) is None:
            made = sets[row] = frozenset(rows[row].tolist())
        return made

    # Sorted by size, so those that may be alike follow up to a size.
    ends = np.searchsorted(sizes, 100 * sizes / percent + 1, side="right").tolist()
    found = []
    for at, (row, end) in enumerate(zip(order, ends)):
        if end == at + 1:
            continue
        wanted = components[at + 1 : end] != components[at]
        if low != high:
            wanted &= blocks[at + 1 : end] != blocks[at]
        if not wanted.any():
            continue
        wanted &= ~(keys[at + 1 : end] == keys[at]).any(axis=1)
        for other in np.flatnonzero(wanted) + at + 1:
            if components[other] == components[at]:
                continue
            mine, theirs = set_of(row), set_of(order[other])
            common = len(mine & theirs)
            if 100 * common >= percent * (len(mine) + len(theirs) - common):
                found.append((row, order[other]))
                components[components == components[other]] = components[at]
    names, n = list(group["class"]), list(group["n"])
    return [(names[a], int(n[a]), names[b], int(n[b])) for a, b in found]


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components after the links between them."""
    others = components.select(F.col("class").alias("centre"), F.col("component").alias("b"))
    edges = links.join(components.withColumnRenamed("component", "a"), "class").join(others, "centre").select("a", "b")
    roots = _contracted(edges)
    found = components.join(roots, components["component"] == roots["node"], "left").select(
        "class", F.coalesce("root", "component").alias("component")
    )
    found = written(found, "found")
    return found.join(_aside(found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))), "component")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    one = pairs.join(sets.select("class", F.col("shingles").alias("mine")), "class")
    both = one.join(sets.select(F.col("class").alias("centre"), F.col("shingles").alias("theirs")), "centre")
    common = F.size(F.array_intersect("mine", "theirs"))
    return (
        both.select("class", "centre", "n", "centre_n", common.alias("common"))
        .where(100 * F.col("common") >= percent * (F.col("n") + F.col("centre_n") - F.col("common")))
        .select("class", "centre")
    )


def _contracted(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for each node of a graph: the smallest node of its component.

    Large stars link the larger neighbours of a node to its smallest one, small stars the smaller ones;
    taking turns, they turn every component into one star.
    """
    now = written(_directed(edges).distinct(), "edges")
    while True:
        large = _star(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = written(_star(large, larger=False).distinct(), "edges")
        same = now.count() == small.count() and not small.join(now, ["a", "b"], "left_anti").limit(1).count()
        removed(now)
        now = small
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _directed(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges of each node's neighbours to the smallest of them and itself; result from larger to smaller."""
    around = edges if larger else _directed(edges)
    root = _aside(around.groupBy("a").agg(F.min("b").alias("root")).withColumn("root", F.least("a", "root")))
    met = around.join(root, "a")
    if larger:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a != b").distinct()
    linked = met.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(
        root.select("a", F.col("root").alias("b"))
    )
    return linked.where("a != b")
