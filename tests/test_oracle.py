"""Every query of the gap library against its expected SQL, on the smallest test tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import oracle, registry
from checks.compare import database, difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_expected_sql():
    assert registry.queries().keys() == oracle.oracle_sql().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert len(registry.queries()) == 93


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, con, name):
    made = registry.queries()[name](spark, SF)
    assert difference(made, con, oracle.oracle_sql()[name]) is None


def test_a_wrong_order_is_found(spark, con):
    made = registry.queries()["order_result"](spark, SF)
    turned = made.withColumn("position", made.count() + 1 - F.col("position"))
    assert "position" in difference(turned, con, oracle.oracle_sql()["order_result"])


def test_entry(spark):
    got = contract.entry(spark)
    assert len(got.columns) == 51 and got.count() > 0
