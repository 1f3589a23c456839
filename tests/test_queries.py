import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.queries()) >= set(QUERIES) and set(contract.oracle_sql()) >= set(ORACLE)


def test_flagship(spark):
    assert contract.entry(spark).columns == ["file_name", "msisdn", "pos", "chunk_no", "chunk_pos", "batch_no", "port"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    same, note = compare(spark, con, name, SF)
    assert same, note
