"""Registered queries over tables whose keys are large, and over tables of more rows than a sketch of keys has items."""

import contextlib
import datetime

import pytest
from pyspark.sql import functions as F

from dimweave.operators import joins
from dimweave.plans.registry import registered
from dimweave.plans.samples import BEYOND, NEW_KEYS

QUERIES = registered()
DAY = datetime.datetime(1995, 1, 1)


def _tables(spark, folder, parts, suppliers, customers, orders):
    """The order tables as files, with a line for each of two products of an order; ``parts`` and ``suppliers`` are frames of keys."""
    day = F.date_add(F.lit(DAY).cast("date"), (F.col("id") % 1095).cast("int")).cast("timestamp")
    order = spark.range(orders)
    tables = {
        "region": spark.range(5).select(F.col("id").cast("int").alias("r_regionkey"), F.concat(F.lit("R"), "id").alias("r_name")),
        "nation": spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), "id").alias("n_name"),
                                         (F.col("id") % 5).cast("int").alias("n_regionkey")),
        "customer": spark.range(customers).select(
            F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), "id").alias("c_name"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
            F.lit(1.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")),
        "supplier": suppliers.select(F.col("id").alias("s_suppkey"), F.concat(F.lit("Supplier#"), "id").alias("s_name"),
                                     (F.col("id") % 25).cast("int").alias("s_nationkey"), F.lit(1.0).alias("s_acctbal")),
        "part": parts.select(
            F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
            F.concat(F.lit("TYPE"), F.col("id") % 6).alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"), F.lit(9.5).alias("p_retailprice")),
        "orders": order.select(
            F.col("id").alias("o_orderkey"), (F.col("id") % customers).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
            F.lit(10.0).alias("o_totalprice"), day.alias("o_orderdate"), F.concat((F.col("id") % 5 + 1), F.lit("-P")).alias("o_orderpriority")),
        "lineitem": order.select("id", F.explode(F.array(F.lit(0), F.lit(1))).alias("n")).select(
            F.col("id").alias("l_orderkey"), (F.col("id") % 60 + F.col("n") * NEW_KEYS).alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
            (F.col("n") + 1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(7.5).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
            F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate")),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def large_keys(spark, tmp_path_factory):
    """60 products and 20 suppliers whose raised keys are all taken, as on tables with over a million of them."""
    def both(n):
        return spark.range(n).union(spark.range(NEW_KEYS, NEW_KEYS + n))

    return _tables(spark, tmp_path_factory.mktemp("large-keys"), both(60), both(20), 30, 700)


def _added(n, modulo, rest):
    """Keys of ``n`` products or suppliers and their copies that the second batch adds: free ones raised, the others moved beyond all."""
    keys = [*range(n), *range(NEW_KEYS, NEW_KEYS + n)]
    kept = {k for k in keys if k % modulo != rest}
    every = 11 if modulo == 17 else 10
    return {k + (BEYOND if k + NEW_KEYS in kept else NEW_KEYS) for k in keys if k % every == 0}, kept


def _keys(rows, column):
    return sorted(r[column] for r in rows)


def _new_versions(rows):
    added, kept = _added(60, 17, 3)
    changed = {k for k in kept if k % 5 == 1}
    assert added & set(_keys(rows, "ProductID_NK")) == added
    assert changed <= set(_keys(rows, "ProductID_NK")) and any(k >= BEYOND for k in added)


def _second_products(rows):
    added, kept = _added(60, 17, 3)
    current = [r["ProductID_NK"] for r in rows if r["IsCurrent"]]
    assert sorted(current) == sorted(added | kept)


def _first_products_again(rows):
    current = [r["ProductID_NK"] for r in rows if r["IsCurrent"]]
    assert sorted(current) == [*range(60), *range(NEW_KEYS, NEW_KEYS + 60)]


def _one_row_a_key(rows):
    added, _ = _added(60, 17, 3)
    assert _keys(rows, "ProductID_NK") == sorted({*range(60), *range(NEW_KEYS, NEW_KEYS + 60)} | added)


def _reappeared(rows):
    # What the second batch removed is back, beside the products that it changed or that were added under another's key.
    _, kept = _added(60, 17, 3)
    lost = {*range(60), *range(NEW_KEYS, NEW_KEYS + 60)} - kept
    assert lost <= set(_keys(rows, "ProductID_NK"))


def _nothing_dangles(rows):
    assert {r["check_name"] for r in rows} <= {"Orders.CustomerID"}


def _no_key_twice(rows):
    assert {r["check_name"] for r in rows} <= {"OrderDetails"}


def _one_current(rows):
    assert {r["check_name"] for r in rows} <= {"DimCustomers versions", "DimProducts versions"} and rows


def _no_nulls(rows):
    targets = {r["column_name"]: r["n_nulls"] for r in rows if "." in r["column_name"]}
    assert targets and not any(targets.values())


def _rejects(rows):
    assert rows and all(r["ErrorReason"] for r in rows)


def _suppliers(rows):
    assert _keys(rows, "SupplierID_NK") == [*range(20), *range(NEW_KEYS, NEW_KEYS + 20)]


def _categories(rows):
    assert sorted(r["CategoryName"] for r in rows) == [f"TYPE{i}" for i in range(6)]


@pytest.mark.parametrize(("name", "holds"), {
    "check_fk_orphans": _nothing_dangles, "check_one_current": _one_current, "check_not_null": _no_nulls, "check_unique_keys": _no_key_twice,
    "latest_version_per_key": _one_row_a_key, "fact_rejects": _rejects, "scd1_delete_categories_returning": _categories,
    "scd2_new_versions": _new_versions, "scd2_products": _second_products, "scd2_products_returning": _first_products_again,
    "scd2_reappear": _reappeared, "scd4_suppliers_current_returning": _suppliers,
}.items())
def test_queries_hold_where_raised_keys_are_taken(spark, large_keys, name, holds):
    holds(QUERIES[name](spark, large_keys).collect())


@pytest.fixture(scope="module")
def many_rows(spark, tmp_path_factory):
    """More orders, customers and products than a sketch has items."""
    return _tables(spark, tmp_path_factory.mktemp("many-rows"), spark.range(120_000), spark.range(1000), 100_000, 150_000)


@contextlib.contextmanager
def _results_of(spark, monkeypatch, limit, partitions=None):
    """The tasks of a stage may send ``limit`` at most, and broadcasts are small."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 2**20)
    given = {"spark.sql.autoBroadcastJoinThreshold": "1m"} | ({"spark.sql.shuffle.partitions": partitions} if partitions else {})
    before = {name: spark.conf.get(name) for name in given}
    conf = spark.sparkContext._jsc.sc().conf()
    conf.set("spark.driver.maxResultSize", limit)
    for name, value in given.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        conf.set("spark.driver.maxResultSize", "1g")
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("name", ["check_lengths", "load_audit", "orders_left_lines"])
def test_queries_send_no_sketches_to_the_driver(spark, many_rows, monkeypatch, name):
    """A sketch of a key column has up to 50,000 items, and each task had its own."""
    with _results_of(spark, monkeypatch, "2m"):
        QUERIES[name](spark, many_rows).write.format("noop").mode("overwrite").save()


def test_clearing_references_sends_no_paths_of_sorted_rows(spark, many_rows, monkeypatch):
    """The sample of a range sort grows with the partitions up to 100 rows for each; most of its bytes were the rows' paths."""
    with _results_of(spark, monkeypatch, "3m", "64"):
        QUERIES["clear_product_fk"](spark, many_rows).write.format("noop").mode("overwrite").save()
