import pytest
from pyspark.sql import functions as F

from muster.operators import lookup
from muster.operators.lookup import attach


@pytest.fixture
def rows(spark):
    data = [("hot" if i % 3 else f"k{i % 5}", i) for i in range(300)] + [(None, -1)]
    return spark.createDataFrame(data, "key string, n long")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_broadcast_join(spark, rows, how):
    table = spark.createDataFrame([("hot", "H"), ("hot", "H2"), ("k0", "K"), ("zz", "Z")], "key string, v string")
    small = attach(rows, table, "key", how)
    spread = attach(rows, table, "key", how, broadcast_bytes=2)
    assert small.columns == spread.columns
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, spread.collect()), key=repr)


def test_messages_and_known_types(spark):
    typed = spark.createDataFrame([("a", "sms"), ("b", "ivr"), ("c", None), ("d", "p02")], "f string, file_type string")
    messages = {"sms": "S", "ivr": "I"}
    bound = lookup.bind_messages(typed, messages).collect()
    assert {(r.f, r.message) for r in bound} == {("a", "S"), ("b", "I")}
    assert {r.f for r in lookup.known_types(typed, messages).collect()} == {"a", "b"}
    assert {r.f for r in lookup.known_types(typed, messages, known=False).collect()} == {"c", "d"}


def test_equal_rows_meet_several_salts(spark):
    rows = spark.range(4_000, numPartitions=16).select(F.lit("hot").alias("key"))
    assert rows.select(lookup.row_salt(rows).alias("s")).distinct().count() == 16


def test_size_of_a_table_counts_its_text(spark):
    few = spark.createDataFrame([("a", "x" * 10_000)], "key string, v string")
    many = spark.createDataFrame([("a", None)] * 10, "key string, v string")
    assert 10_000 < lookup.table_bytes(few) < 10_200 and 900 < lookup.table_bytes(many) < 1_100
    assert lookup.table_bytes(few.limit(0)) == 0
