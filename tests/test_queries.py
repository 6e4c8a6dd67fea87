"""Every registered query against its DuckDB counterpart."""

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as contract
from dimweave.plans.registry import registered, samples
from oracle import ORACLE_SQL as ORACLE

QUERIES = registered()


@pytest.fixture(scope="module")
def con(spark, sf_dir):
    samples(spark, sf_dir).after(3, "FactOrders_Error")  # all batches at once, steps side by side
    return oracle_connection(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


def test_entry_is_not_empty(spark):
    assert contract.entry(spark).count() > 0
