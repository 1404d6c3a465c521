import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, db, name):
    assert difference(spark, db, name, SF) is None


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).columns == ["id", "abs_words", "published", "split"]
