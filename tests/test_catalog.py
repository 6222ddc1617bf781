import pytest

import __spark_entry__ as contract
from compare import differences, oracle
from weirflow.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    found, rows = differences(spark, con, SF, QUERIES[name], ORACLE_SQL[name])
    assert found == []
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
