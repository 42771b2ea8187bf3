import pytest

import __spark_entry__ as entry
from seqloom.catalog.oracle import ORACLE
from seqloom.catalog.spark_queries import QUERIES
from tests.compare import difference, open_oracle

SF_DIR = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    found = entry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(found, oracle.sql(entry.oracle_sql()[name]).df()) is None
    assert len(found)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 4 * 996
