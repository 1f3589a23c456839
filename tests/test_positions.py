import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from muster.operators import position
from muster.operators.position import SPLIT_BYTES, count_splits, number_by_key, number_by_split
from muster.operators.validate import valid_rows
from muster.sources.lists import scan_lists
from tests.reference_loop import clean, valid


def messy_cells(count, seed):
    rand = random.Random(seed)
    cells = []
    for i in range(count):
        number = f"255{rand.randrange(10**9):09d}"
        cells.append(rand.choice([number, number, f" {number}\t", "bad", "", f"+{number}"]))
    return cells


@pytest.fixture
def lists_on_disk(put):
    inputs = {name: messy_cells(count, count) for name, count in (("b.csv", 3_000), ("a.csv", 9_000), ("c.csv", 40))}
    paths = [put(name, "MSISDN,N\n" + "".join(f"{c},{i}\n" for i, c in enumerate(cells))) for name, cells in inputs.items()]
    expected = [
        (ordinal, pos, number)
        for ordinal, cells in enumerate(inputs.values(), start=1)
        for pos, number in enumerate(n for n in map(clean, cells) if valid(n))
    ]
    return paths, expected


@pytest.mark.parametrize("size", [2_000, 7_777, 60_000, 10_000_000])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_split_positions_equal_reading_in_order(spark, lists_on_disk, split_size, size, broadcast_bytes):
    paths, expected = lists_on_disk
    split_size(size)
    scan = scan_lists(spark, paths)
    rows = number_by_split(valid_rows(scan.rows), scan.files, broadcast_bytes=broadcast_bytes)
    got = rows.orderBy("list_pos").collect()
    assert [(r.file_ordinal, r.pos, r.msisdn) for r in got] == expected
    assert [r.list_pos for r in got] == list(range(len(expected)))
    assert {(r.file_ordinal, r.file_rows) for r in got} == {(i, sum(e[0] == i for e in expected)) for i in (1, 2, 3)}


def test_split_positions_survive_shuffles_and_pruning_above(spark, lists_on_disk, split_size):
    paths, expected = lists_on_disk
    split_size(5_000)
    scan = scan_lists(spark, paths)
    rows = number_by_split(valid_rows(scan.rows), scan.files)
    got = rows.filter("file_name = 'a.csv' and pos % 7 = 3").select("pos", "msisdn").repartition(5).collect()
    assert sorted(map(tuple, got)) == [(p, n) for o, p, n in expected if o == 2 and p % 7 == 3]


def test_changed_splits_fail_the_job(spark, lists_on_disk, split_size):
    paths, _ = lists_on_disk
    split_size(5_000)
    scan = scan_lists(spark, paths)
    splits = count_splits(scan.rows).withColumn("_split", F.col("_split") + 1)
    with pytest.raises(SparkRuntimeException, match="split changed"):
        number_by_split(scan.rows, scan.files, splits).collect()


def test_files_left_out_of_the_file_table_are_left_out_of_the_rows(spark, lists_on_disk):
    paths, expected = lists_on_disk
    scan = scan_lists(spark, paths)
    kept = scan.files.filter("file_name <> 'a.csv'").withColumn("message", F.lit("m"))
    got = number_by_split(valid_rows(scan.rows), scan.files, bound=kept).orderBy("list_pos").collect()
    assert [(r.file_ordinal, r.pos, r.msisdn) for r in got] == [e for e in expected if e[0] != 2]
    assert [r.list_pos for r in got] == [i for i, e in enumerate(expected) if e[0] != 2]
    assert {r.message for r in got} == {"m"}


def test_rows_of_an_unlisted_file_fail_the_job(spark, lists_on_disk):
    paths, _ = lists_on_disk
    scan = scan_lists(spark, paths)
    with pytest.raises(SparkRuntimeException, match="not in the list of files"):
        number_by_split(scan.rows, scan.files.filter("file_name <> 'a.csv'")).collect()


def test_entries_of_splits_repeated_for_a_file_are_counted(spark, lists_on_disk):
    paths, _ = lists_on_disk
    scan = scan_lists(spark, paths[:1] * 60)
    rows = number_by_split(scan.rows, scan.files, broadcast_bytes=50 * SPLIT_BYTES)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert "strategy=broadcast" in number_by_split(scan.rows, scan.files)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("ranges", [1, 2, 7, 200, None])
def test_key_positions_equal_the_rank(spark, ranges):
    rand = random.Random(ranges)
    keys = {"hot": rand.sample(range(-5_000, 9_000), 3_000), "small": [3, 1, 2], "sparse": [10**15, -(10**15), 0, 5]}
    rows = [(name, key) for name, values in keys.items() for key in values]
    rand.shuffle(rows)
    frame = spark.createDataFrame(rows, "file_name string, row_key long")
    got = number_by_key(frame, ranges=ranges).collect()
    expected = {(n, k): i for n, values in keys.items() for i, k in enumerate(sorted(values))}
    assert {(r.file_name, r.row_key): r.pos for r in got} == expected
    assert len(got) == len(rows)
    assert {(r.file_name, r.file_rows) for r in got} == {(n, len(v)) for n, v in keys.items()}


def test_key_positions_shuffle_the_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name = (F.col("id") % 3).cast("string").alias("file_name")
        frame = spark.range(1_000).select(name, F.col("id").alias("row_key"))
        plan = number_by_key(frame, ranges=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows are dealt out once, by file and piece; the others carry a row per piece: partial counts
    # (for the groups and for the pieces) and the starts on their way back.
    by_row = [line for line in plan.splitlines() if "Exchange hashpartitioning(file_name" in line and "_piece" in line]
    assert len(by_row) == 4 and plan.count("SortMergeJoin") == 2


def test_gaps_between_keys_make_no_more_pieces(spark):
    frame = spark.range(20_000).select(F.lit("f").alias("file_name"), (F.col("id") * 1_000_003).alias("row_key"))
    seen = []
    original = position._piece_starts

    def watched(sizes, file):
        seen.append(sizes)
        return original(sizes, file)

    position._piece_starts = watched
    try:
        got = number_by_key(frame, ranges=1_600)
    finally:
        position._piece_starts = original
    sizes = [row["_size"] for row in seen[0].collect()]
    assert 1_400 < len(sizes) <= 1_600 and max(sizes) < 40
    assert got.filter("pos <> row_key / 1000003").count() == 0
    # Pieces of one file are summed up in groups: none has all of them.
    groups = seen[0].groupBy((F.col("_piece") / position.PIECES_PER_GROUP).cast("int")).count().collect()
    assert len(groups) == 4


@pytest.mark.parametrize("row", [(None, 1), ("f", None)])
def test_rows_without_file_or_key_fail_the_job(spark, row):
    frame = spark.createDataFrame([("f", 0), row], "file_name string, row_key long")
    with pytest.raises(SparkRuntimeException, match="no file or no key"):
        number_by_key(frame).collect()
