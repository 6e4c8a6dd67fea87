"""Registered queries: every operator over the whole sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.functions.changes import any_differs
from dimweave.operators import checks, dimensions, facts, keys
from dimweave.operators.joins import newest_per_key
from dimweave.plans.job import read_audit, run_load
from dimweave.plans.samples import AS_OF, WINDOWS, SampleLoads, all_sources, load_time
from dimweave.plans.steps import fact_dimensions
from dimweave.sources import ingest
from dimweave.sources.schemas import (
    FACT_GRAIN, FACT_TABLE, LINE_KEYS, LINES_ROW, MONEY, ORDER_KEYS, ORDERS_ROW, POLICIES, RATE, REJECT_TABLE, ROW_ID,
    SOR, SOR_TABLE, SOURCES, sor_rows,
)
from dimweave.sources.scratch import materialize, scratch_root

# Columns that are NULL in every row of the samples are left out of the results.
LIVE = {
    "Categories": ["CategoryID", "CategoryName"],
    "Customers": ["CustomerID", "CompanyName", "ContactTitle"],
    "Employees": ["EmployeeID", "LastName"],
    "OrderDetails": ["OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"],
    "Orders": ["OrderID", "CustomerID", "EmployeeID", "OrderDate", "RequiredDate", "ShippedDate", "ShipVia", "Freight", "ShipName",
               "ShipAddress", "ShipCity", "ShipRegion", "ShipPostalCode", "ShipCountry", "TerritoryID"],
    "Products": ["ProductID", "ProductName", "SupplierID", "CategoryID", "QuantityPerUnit", "UnitPrice",
                 "UnitsInStock", "Discontinued"],
    "Region": ["RegionID", "RegionDescription"],
    "Shippers": ["ShipperID", "CompanyName"],
    "Suppliers": ["SupplierID", "CompanyName", "Country"],
    "Territories": ["TerritoryID", "TerritoryDescription", "TerritoryCode", "RegionID"],
}
_samples: dict[tuple[str, str], SampleLoads] = {}


def samples(spark: SparkSession, sf_dir: str) -> SampleLoads:
    """The loads of one data folder, shared by the queries of one Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _samples:
        _samples[key] = SampleLoads(spark, sf_dir)
    return _samples[key]


def _staged(s: SampleLoads, batch: int, source: str) -> DataFrame:
    return s.staged(batch, source).select(ROW_ID, *LIVE[source])


def _dimension(df: DataFrame, table: str) -> DataFrame:
    policy = next(p for p in POLICIES.values() if table in (p.target, p.history))
    shown = {policy.renames.get(c, f"{c}_NK" if c == policy.key else c) for c in LIVE[policy.source]}
    dead = {f.name for f in policy.attributes} - shown - {r.fk for r in policy.references}
    return df.drop(*dead)


def _fact(df: DataFrame) -> DataFrame:
    # Fact keys follow no order, so they are checked by themselves in check_fact_keys.
    return df.drop("FactOrder_SK")


def _after(batch: int, table: str) -> Callable[[SampleLoads], DataFrame]:
    return lambda s: _dimension(s.frame(batch, table), table)


def _dims(s: SampleLoads, batch: int) -> dict[str, DataFrame]:
    return fact_dimensions(s.before(batch, FACT_TABLE))


def _ingest_row_counts(s: SampleLoads) -> DataFrame:
    staged = s.stage_all(1, SOURCES)
    counts = None
    for source in SOURCES:
        row = staged[source].agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(source).alias("sheet"), F.lit(source).alias("table_name"), "n_rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def _dim_sor(s: SampleLoads) -> DataFrame:
    """The system-of-record table with the staged rows of each source; an empty sheet keeps its row."""
    seed = s.spark.createDataFrame(sor_rows(), SOR)
    counts = _ingest_row_counts(s).select(F.col("table_name").alias("staging_raw_table_name"), "n_rows")
    joined = seed.join(counts, "staging_raw_table_name", "left")
    return joined.select("SOR_SK", "staging_raw_table_name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def _stage_sheet(fmt: str) -> Callable[[SampleLoads], DataFrame]:
    """The order lines as sheet files in a known order, staged by their position."""
    def run(s: SampleLoads) -> DataFrame:
        lines = s.spark.read.parquet(f"{s.sf_dir}/lineitem.parquet")
        sheet = lines.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount").select(
            F.col("l_orderkey").alias("Order ID"), F.col("l_partkey").alias("Product ID"), F.col("l_extendedprice").cast(MONEY).alias("Unit Price"),
            F.col("l_quantity").cast("int").alias("Quantity"), F.col("l_discount").cast(RATE).alias("Discount"))
        path = f"{scratch_root(s.spark)}/sheet-{uuid.uuid4().hex}"
        sheet.write.option("header", True).format(fmt).save(path)
        return ingest.stage_sheet(s.spark, path, "OrderDetails", fmt)

    return run


def _normalize_columns(s: SampleLoads) -> DataFrame:
    raw = s.spark.read.parquet(f"{s.sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias(" Customer ID "), F.col("c_name").alias("Company  Name"),
        F.col("c_acctbal").alias("Unnamed: 12"), F.col("c_nationkey").alias("nan"),
        F.col("c_mktsegment").alias("ContactTitle"))
    return ingest.normalize_columns(raw)


def _normalize_nulls(s: SampleLoads) -> DataFrame:
    price = F.when(F.col("l_partkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    raw = s.spark.read.parquet(f"{s.sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_linenumber", price.alias("price"))
    return ingest.normalize_nulls(raw)


def _changed_customers(s: SampleLoads) -> DataFrame:
    policy = POLICIES["DimCustomers"]
    new = dimensions.prepare_source(s.staged(2, "Customers"), policy, {})
    paired = dimensions.pair(s.frame(1, "DimCustomers"), new, policy.nk)
    return (paired.where(any_differs("old", "new", policy.attributes)
                         & F.col("old").isNotNull() & F.col("new").isNotNull())
            .select("new.CustomerID_NK", F.col("old.CompanyName").alias("old_name"),
                    F.col("new.CompanyName").alias("new_name")))


def _windowed(s: SampleLoads) -> DataFrame:
    return facts.orders_in_window(s.staged(1, "Orders"), WINDOWS[1])


def _laid_out(s: SampleLoads):
    """Orders of the window and all lines, as they are laid out by order."""
    return facts.orders_in_window(s.apart(1, "Orders"), WINDOWS[1]), s.apart(1, "OrderDetails")


def _order_lines(s: SampleLoads) -> DataFrame:
    joined = facts.order_lines(*_laid_out(s))
    return joined.select("OrderID", "ProductID", ORDERS_ROW, LINES_ROW, "OrderDate", "Quantity")


def _orders_left_lines(s: SampleLoads) -> DataFrame:
    joined = facts.orders_left_lines(*_laid_out(s))
    return joined.select("OrderID", "ProductID", ORDERS_ROW, LINES_ROW, "OrderDate", "Quantity")


def _fact_key_lookup(s: SampleLoads) -> DataFrame:
    dims = _dims(s, 1)
    orders = facts.resolve(_windowed(s), ORDER_KEYS, dims, "left")
    lines = facts.resolve(s.staged(1, "OrderDetails"), LINE_KEYS, dims, "left")
    joined = facts.order_lines(orders, lines)
    return joined.select(ORDERS_ROW, LINES_ROW, *[k.fk for k in (*ORDER_KEYS, *LINE_KEYS)])


def _dedupe(s: SampleLoads) -> DataFrame:
    orders, lines = _laid_out(s)
    newest = facts.newest_order_lines(facts.newest_orders(orders), lines)
    return newest.select("OrderID", "ProductID", ORDERS_ROW, LINES_ROW, "Quantity")


def _sales_amount(s: SampleLoads) -> DataFrame:
    return s.staged(1, "OrderDetails").select(ROW_ID, facts.sales_amount().alias("SalesAmount"))


def _fact_valid(s: SampleLoads) -> DataFrame:
    return facts.fact_source(s.apart(1, "Orders"), s.apart(1, "OrderDetails"), _dims(s, 1), WINDOWS[1])


def _fact_rejects(s: SampleLoads) -> DataFrame:
    return facts.reject_source(s.apart(2, "Orders"), s.apart(2, "OrderDetails"), _dims(s, 2), WINDOWS[2])


def _error_reason(s: SampleLoads) -> DataFrame:
    rows = facts.reject_source(s.apart(1, "Orders"), s.apart(1, "OrderDetails"), _dims(s, 1), WINDOWS[1])
    return rows.select(ORDERS_ROW, LINES_ROW, "ErrorReason")


def _vanished(s: SampleLoads) -> DataFrame:
    found = None
    for table in ("DimCategories", "DimEmployees", "DimProducts", "DimSuppliers"):
        policy = POLICIES[table]
        stored = s.frame(1, table)
        if policy.method == "versions":
            stored = stored.where("IsCurrent")
        rows = dimensions.vanished_rows(stored, s.staged(2, policy.source), policy).select(
            F.lit(table).alias("dimension"), F.col(policy.nk).alias("natural_key"),
            F.col(policy.surrogate).alias("surrogate_key"))
        found = rows if found is None else found.unionByName(rows)
    return found


def _new_keys(s: SampleLoads) -> DataFrame:
    stored = s.frame(1, "DimCustomers").select(F.col("CustomerID_NK").alias("CustomerID")).distinct()
    rows = s.staged(2, "Customers").where("CustomerID is not null")
    return dimensions.lookup_join(rows, stored, "CustomerID", "left_anti", ROW_ID).select(ROW_ID, "CustomerID")


def _latest_versions(s: SampleLoads) -> DataFrame:
    newest = newest_per_key(s.frame(3, "DimProducts"), ["ProductID_NK"], [F.col("ProductID_TABLE_SK").desc()])
    return newest.select("ProductID_NK", "ProductID_TABLE_SK", "ProductID_DURABLE_SK", "ValidFrom", "IsCurrent")


def _not_null_keys(s: SampleLoads) -> DataFrame:
    found = None
    for policy in POLICIES.values():
        dims = {r.dimension: s.frame(1, r.dimension) for r in policy.references}
        rows = dimensions.prepare_source(s.staged(2, policy.source), policy, dims).select(
            F.lit(policy.target).alias("dimension"), F.col(policy.nk).cast("string").alias("natural_key"),
            "SOR_SK", "staging_raw_id_nk")
        found = rows if found is None else found.unionByName(rows)
    return found


def _reference_lookup(source: str, table: str, columns: list[str]) -> Callable[[SampleLoads], DataFrame]:
    def run(s: SampleLoads) -> DataFrame:
        policy = POLICIES[table]
        dims = {r.dimension: s.frame(2, r.dimension) for r in policy.references}
        return dimensions.prepare_source(s.staged(2, source), policy, dims).select(*columns)

    return run


def _closed(s: SampleLoads) -> DataFrame:
    before = F.date_sub(F.lit(AS_OF[2]), 1)
    rows = s.frame(2, "DimCustomers").where((F.col("ValidTo") == before) & ~F.col("IsCurrent"))
    return rows.select("CustomerID_TABLE_SK", "CustomerID_NK", "ValidFrom", "ValidTo", "IsCurrent")


def _new_versions(s: SampleLoads) -> DataFrame:
    rows = s.frame(2, "DimProducts").where(F.col("ValidFrom") == F.lit(AS_OF[2]))
    return rows.select("ProductID_TABLE_SK", "ProductID_DURABLE_SK", "ProductID_NK", "UnitPrice", "SupplierID_SK_FK",
                       "CategoryID_SK_FK")


def _reappeared(s: SampleLoads) -> DataFrame:
    """Products added in batch 3, with the number of versions each now has."""
    table = s.frame(3, "DimProducts")
    versions = table.groupBy("ProductID_NK").agg(F.count(F.lit(1)).alias("n_versions"))
    added = table.where(F.col("ValidFrom") == F.lit(AS_OF[3]))
    return added.join(versions, "ProductID_NK").select("ProductID_NK", "ProductID_TABLE_SK", "n_versions")


def _durable(s: SampleLoads) -> DataFrame:
    return (s.frame(3, "DimCustomers").groupBy("CustomerID_NK", "CustomerID_DURABLE_SK")
            .agg(F.count(F.lit(1)).alias("n_versions"), F.max("CustomerID_TABLE_SK").alias("latest_sk")))


def _cleared(s: SampleLoads) -> DataFrame:
    """Products after vanished categories and suppliers are gone, before products are loaded."""
    return s.frame(2, "DimProducts", "DimSuppliers").select(
        "ProductID_TABLE_SK", "CategoryID_NK", "CategoryID_SK_FK", "SupplierID_NK", "SupplierID_SK_FK")


def _cascade(s: SampleLoads) -> DataFrame:
    return s.frame(2, FACT_TABLE, "DimEmployees").select(*FACT_GRAIN, "EmployeeID_SK_FK", "OrderDate")


def _allocate(s: SampleLoads) -> DataFrame:
    """Every line numbered from 1001 in part and order, copies told apart by place."""
    lines = materialize(s.spark.read.parquet(f"{s.sf_dir}/lineitem.parquet").select(
        "l_partkey", "l_orderkey", "l_quantity"), "allocate")
    return keys.number_in_order(lines, "line_sk", 1000, ["l_partkey", "l_orderkey", "l_quantity"])


def _fact_keys(s: SampleLoads) -> DataFrame:
    """Fact keys of the first load are 1 .. n without gaps or repeats."""
    sk = F.col("FactOrder_SK")
    return s.frame(1, FACT_TABLE).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(sk).alias("first_key"), F.max(sk).alias("last_key"),
        F.count_distinct(sk).alias("n_keys"))


def _as_text(df: DataFrame, check: str, key: str) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.col(key).cast("string").alias("key_value"), "n_rows")


def _unique_keys(s: SampleLoads) -> DataFrame:
    """Repeated surrogate and natural keys of every stored table, natural ones of versions among current rows (none), and
    repeated pairs of the staged lines, where they are allowed."""
    found = None
    for policy in POLICIES.values():
        table = s.frame(2, policy.target)
        by_nk = checks.several_current(table, policy.nk) if policy.method == "versions" else checks.repeated_keys(table, [policy.nk])
        for key, repeated in ((policy.surrogate, checks.repeated_keys(table, [policy.surrogate])), (policy.nk, by_nk)):
            bad = _as_text(repeated, f"{policy.target}.{key}", key)
            found = bad if found is None else found.unionByName(bad)
    sheets = s.spark.createDataFrame(sor_rows(), SOR)
    for key in SOR.names:
        found = found.unionByName(_as_text(checks.repeated_keys(sheets, [key]), f"{SOR_TABLE}.{key}", key))
    fact = s.frame(2, FACT_TABLE)
    found = found.unionByName(_as_text(checks.repeated_keys(fact, ["FactOrder_SK"]), f"{FACT_TABLE}.FactOrder_SK", "FactOrder_SK"))
    pairs = checks.repeated_keys(fact, FACT_GRAIN).withColumn("pair", F.concat_ws("-", *FACT_GRAIN))
    found = found.unionByName(_as_text(pairs, f"{FACT_TABLE}.{'-'.join(FACT_GRAIN)}", "pair"))
    for table, key, step in ((REJECT_TABLE, "FactOrder_Error_SK", REJECT_TABLE), ("DimSuppliers_History", "SupplierHistoryID_SK", "DimSuppliers")):
        found = found.unionByName(_as_text(checks.repeated_keys(s.frame(2, table, step), [key]), f"{table}.{key}", key))
    lines = s.staged(2, "OrderDetails").withColumn("pair", F.concat_ws("-", "OrderID", "ProductID"))
    return found.unionByName(_as_text(checks.repeated_keys(lines, ["pair"]), "OrderDetails", "pair"))


def _one_current(s: SampleLoads) -> DataFrame:
    """Keys with several current versions (none), then keys with several versions of any kind."""
    found = None
    for table in ("DimCustomers", "DimProducts"):
        nk, rows = POLICIES[table].nk, s.frame(3, table)
        current = _as_text(checks.several_current(rows, nk), f"{table} current", nk)
        any_kind = _as_text(checks.repeated_keys(rows, [nk]), f"{table} versions", nk)
        both = current.unionByName(any_kind)
        found = both if found is None else found.unionByName(both)
    return found


def _fact_grain(s: SampleLoads) -> DataFrame:
    """Repeated fact keys (none) and repeated pairs among the joined order lines."""
    stored = checks.repeated_keys(s.frame(2, FACT_TABLE), FACT_GRAIN).select(
        F.lit("FactOrders").alias("table_name"), *FACT_GRAIN, "n_rows")
    joined = _order_lines(s).where("ProductID is not null").select(
        F.col("OrderID").alias("OrderID_NK"), F.col("ProductID").alias("ProductID_NK"))
    lines = checks.repeated_keys(joined, FACT_GRAIN).select(
        F.lit("order lines").alias("table_name"), *FACT_GRAIN, "n_rows")
    return stored.unionByName(lines)


def _fk_orphans(s: SampleLoads) -> DataFrame:
    """Dangling fact keys (none), and natural keys of staged orders that no current customer has."""
    fact, found = s.frame(2, FACT_TABLE), None
    for k in (*ORDER_KEYS, *LINE_KEYS):
        target = s.frame(2, k.dimension)
        bad = checks.orphan_references(fact, k.fk, target, POLICIES[k.dimension].surrogate)
        bad = _as_text(bad, f"{FACT_TABLE}.{k.fk}", k.fk)
        found = bad if found is None else found.unionByName(bad)
    for policy in POLICIES.values():
        for ref in policy.references:
            key = POLICIES[ref.dimension].surrogate
            bad = checks.orphan_references(s.frame(2, policy.target), ref.fk, s.frame(2, ref.dimension), key)
            found = found.unionByName(_as_text(bad, f"{policy.target}.{ref.fk}", ref.fk))
    current = s.frame(2, "DimCustomers").where("IsCurrent")
    lost = checks.orphan_references(s.staged(2, "Orders"), "CustomerID", current, "CustomerID_NK")
    return found.unionByName(_as_text(lost, "Orders.CustomerID", "CustomerID"))


def _not_null(s: SampleLoads) -> DataFrame:
    """NULLs of the staged orders, where they are allowed, and of the required columns of every target (none)."""
    found = checks.null_counts(s.staged(1, "Orders"), [ROW_ID, *LIVE["Orders"]])
    for policy in POLICIES.values():
        required = [policy.surrogate, policy.nk, "SOR_SK", "staging_raw_id_nk", *(["ValidFrom", "IsCurrent"] if policy.method == "versions" else [])]
        nulls = checks.null_counts(s.frame(2, policy.target), required)
        found = found.unionByName(nulls.withColumn("column_name", F.concat(F.lit(f"{policy.target}."), "column_name")))
    keys_of_fact = [*FACT_GRAIN, *[k.fk for k in (*ORDER_KEYS, *LINE_KEYS)], "SnapshotDate", "LoadDate"]
    nulls = checks.null_counts(s.frame(2, FACT_TABLE), keys_of_fact)
    return found.unionByName(nulls.withColumn("column_name", F.concat(F.lit(f"{FACT_TABLE}."), "column_name")))


def _lengths(s: SampleLoads) -> DataFrame:
    """Texts longer than allowed: none in any staged sheet, some in customers whose ids are widened to overflow."""
    schema = s.staged(2, "Customers").schema
    wide = s.staged(2, "Customers").withColumn("CustomerID", F.repeat("CustomerID", 4))
    wide = wide.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])
    found = checks.too_long_counts(wide.select(*LIVE["Customers"])).withColumn("sheet", F.lit("wide customers"))
    for source in SOURCES:
        texts = s.staged(2, source).select(*LIVE[source])
        if any("max_length" in f.metadata for f in texts.schema.fields):
            found = found.unionByName(checks.too_long_counts(texts).withColumn("sheet", F.lit(source)))
    return found


def _audit(s: SampleLoads) -> DataFrame:
    """A whole job run on the first batch, as recorded; execution ids differ by run."""
    root = f"{scratch_root(s.spark)}/audited-{uuid.uuid4().hex}"
    result = run_load(s.spark, all_sources(s.spark, s.sf_dir, 1), root, WINDOWS[1], AS_OF[1], load_time(1))
    if not result["success"]:
        raise RuntimeError(result["error"])
    return read_audit(s.spark, root).select("step_no", "step", "source_table", "target_table", "n_rows", "status")


QUERIES: dict[str, Callable[[SampleLoads], DataFrame]] = {
    "stage_orders": lambda s: _staged(s, 1, "Orders"),
    "stage_order_details": lambda s: _staged(s, 1, "OrderDetails"),
    "stage_sheet_csv": _stage_sheet("csv"),
    "stage_sheet_parquet": _stage_sheet("parquet"),
    "ingest_row_counts": _ingest_row_counts,
    "normalize_columns": _normalize_columns,
    "normalize_nulls": _normalize_nulls,
    "dim_sor": _dim_sor,
    "orders_in_window": lambda s: _windowed(s).select(ROW_ID, *LIVE["Orders"]),
    "source_rows_not_null_key": _not_null_keys,
    "fact_valid_rows": _fact_valid,
    "fact_rejects": _fact_rejects,
    "changed_rows_sentinel": _changed_customers,
    "order_lines": _order_lines,
    "orders_left_lines": _orders_left_lines,
    "fact_key_lookup": _fact_key_lookup,
    "territory_region_lookup": _reference_lookup(
        "Territories", "DimTerritories", ["TerritoryID_NK", "RegionID_NK", "RegionID_SK_FK"]),
    "product_fk_lookup": _reference_lookup(
        "Products", "DimProducts",
        ["ProductID_NK", "SupplierID_NK", "SupplierID_SK_FK", "CategoryID_NK", "CategoryID_SK_FK"]),
    "vanished_keys": _vanished,
    "orphan_order_lines": lambda s: facts.orphan_lines(
        s.apart(1, "OrderDetails"), s.apart(1, "Orders")).select(ROW_ID, *LIVE["OrderDetails"]),
    "new_keys": _new_keys,
    "latest_version_per_key": _latest_versions,
    "dedupe_order_lines": _dedupe,
    "sales_amount": _sales_amount,
    "error_reason": _error_reason,
    "scd1_region": _after(2, "DimRegion"),
    "scd1_shippers": _after(2, "DimShippers"),
    "scd1_delete_categories": _after(2, "DimCategories"),
    "scd1_delete_categories_returning": _after(3, "DimCategories"),
    "scd1_delete_employees": _after(2, "DimEmployees"),
    "scd1_delete_employees_returning": _after(3, "DimEmployees"),
    "scd2_customers": _after(2, "DimCustomers"),
    "scd2_customers_returning": _after(3, "DimCustomers"),
    "scd2_close": _closed,
    "scd2_new_versions": _new_versions,
    "scd2_products": _after(2, "DimProducts"),
    "scd2_products_returning": _after(3, "DimProducts"),
    "scd2_reappear": _reappeared,
    "scd2_durable_key": _durable,
    "scd3_territories": _after(2, "DimTerritories"),
    "scd3_territories_returning": _after(3, "DimTerritories"),
    "scd4_suppliers_current": _after(2, "DimSuppliers"),
    "scd4_suppliers_current_returning": _after(3, "DimSuppliers"),
    "scd4_suppliers_history": lambda s: _dimension(
        s.frame(3, "DimSuppliers_History", "DimSuppliers"), "DimSuppliers_History"),
    "clear_product_fk": _cleared,
    "fact_cascade_employees": _cascade,
    "fact_initial_load": lambda s: _fact(s.frame(1, FACT_TABLE)),
    "fact_merge": lambda s: _fact(s.frame(2, FACT_TABLE)),
    "fact_merge_returning": lambda s: _fact(s.frame(3, FACT_TABLE)),
    "fact_error_initial_load": lambda s: s.frame(1, REJECT_TABLE),
    "fact_error_refresh": lambda s: s.frame(2, REJECT_TABLE),
    "fact_error_refresh_returning": lambda s: s.frame(3, REJECT_TABLE),
    "allocate_surrogate_keys": _allocate,
    "check_unique_keys": _unique_keys,
    "check_one_current": _one_current,
    "check_fact_grain": _fact_grain,
    "check_fact_keys": _fact_keys,
    "check_fk_orphans": _fk_orphans,
    "check_not_null": _not_null,
    "check_lengths": _lengths,
    "load_audit": _audit,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, q=query: q(samples(spark, sf_dir))) for name, query in QUERIES.items()}
