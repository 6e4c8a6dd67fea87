"""The paths taken on large tables give the same rows as a plain join."""

import pytest
from compare import difference, oracle_connection
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimweave.operators import facts, joins
from dimweave.operators.joins import hot_keys, lookup_join, pair_join
from dimweave.plans import registry
from dimweave.plans.samples import WINDOWS
from oracle import _query


@pytest.fixture
def rows(spark):
    """A third of the rows on one key, a sixth without a key."""
    key = (F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 200))
    return spark.range(6000).select(key.alias("k"), F.col("id").alias("row"))


@pytest.fixture
def lookup(spark):
    return spark.range(0, 150).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def _sorted(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_hot_keys_and_parts(rows, shuffled):
    found = hot_keys(rows, "k")
    assert set(found) == {7} and found[7] >= 15


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join(rows, lookup, shuffled, how):
    assert _sorted(lookup_join(rows, lookup, "k", how, "row")) == _sorted(rows.join(lookup, "k", how))


def test_salted_rows_are_spread(spark, rows, lookup, shuffled):
    spread = joins._spread(rows.where("k = 7 or k is null"), "k", hot_keys(rows, "k"), "row", "_salt")
    sizes = [r["count"] for r in spread.groupBy("k", "_salt").count().collect()]
    assert len(sizes) > 60 and max(sizes) < 200


@pytest.mark.parametrize("how", ["left", "left_anti"])
@pytest.mark.parametrize("hot", [True, False])
def test_null_keys_are_spread_by_the_shuffle(spark, rows, lookup, shuffled, monkeypatch, how, hot):
    """The salt stays a shuffle key, with and without hot keys, so no task gets all NULL keys."""
    monkeypatch.setattr(shuffled, "HOT_SHARE", 0.02 if hot else 0.5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = lookup_join(rows, lookup.where("k is not null"), "k", how, "row")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(k#") == 2 and plan.count("_salt#") > 2
    assert all("_salt" in part.split("]")[0] for part in plan.split("hashpartitioning(k#")[1:])
    assert _sorted(joined) == _sorted(rows.join(lookup, "k", how))


def test_pair_join_with_hot_keys_on_both_sides(spark, rows, shuffled):
    right = spark.range(300).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("other"))
    assert _sorted(pair_join(rows, right, "k", "row", "other")) == _sorted(rows.join(right, "k"))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=30),
       right=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=30))
def test_pair_join_property(spark, shuffled, left, right):
    a = spark.createDataFrame(list(zip(left, range(len(left)))), "k long, a long")
    b = spark.createDataFrame(list(zip(right, range(len(right)))), "k long, b long")
    want = sorted((k, x, y) for x, k in enumerate(left) for y, j in enumerate(right) if k is not None and k == j)
    assert sorted(tuple(r) for r in pair_join(a, b, "k", "a", "b").select("k", "a", "b").collect()) == want


@pytest.fixture(scope="module")
def loads(spark, sf_dir):
    return registry.samples(spark, sf_dir)


@pytest.mark.parametrize("name", [
    "fact_valid_rows", "fact_rejects", "error_reason", "dedupe_order_lines", "order_lines", "orders_left_lines",
    "orphan_order_lines", "fact_key_lookup", "vanished_keys", "new_keys", "product_fk_lookup", "check_fk_orphans"])
def test_large_paths_match_duckdb(spark, sf_dir, loads, shuffled, name):
    assert difference(registry.QUERIES[name](loads), oracle_connection(sf_dir), registry_sql(name)) is None


def registry_sql(name):
    from oracle import ORACLE_SQL

    return ORACLE_SQL[name]


def test_hot_order_is_deduplicated_apart(spark, sf_dir, loads, shuffled):
    """A third of the lines moved to one order: same rows as the window rule over the plain join."""
    hot_id = loads.staged(1, "Orders").where(WINDOWS[1].contains()).selectExpr("min(OrderID)").first()[0]
    moved = F.when(F.col("staging_raw_id_sk") % 3 == 0, F.lit(hot_id)).otherwise(F.col("OrderID"))
    lines = loads.staged(1, "OrderDetails").withColumn("OrderID", moved)
    orders = facts.newest_orders(facts.orders_in_window(loads.staged(1, "Orders"), WINDOWS[1]))
    assert hot_id in hot_keys(lines.where("OrderID is not null"), "OrderID")
    got = facts.newest_order_lines(orders, lines).select("OrderID", "ProductID", facts.LINES_ROW)
    joined = lines.where("ProductID is not null").join(orders.select("OrderID"), "OrderID")
    want = joined.groupBy("OrderID", "ProductID").agg(F.max("staging_raw_id_sk").alias(facts.LINES_ROW))
    assert _sorted(got) == _sorted(want)


def test_group_limit_comes_before_the_shuffle(spark, loads):
    plan = facts.newest_orders(loads.staged(1, "Orders"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_oracle_expressions_are_ordered():
    assert _query("select * from fact_1").count("fact_1 as (") == 1
