"""The driver's order tables as source sheets, in batches, and the loads built on them.

Batch 1 plants defects by key arithmetic, batch 2 changes, adds and removes rows, batch 3 is
batch 1 again so that vanished keys return.
"""

from __future__ import annotations

import contextlib
import datetime
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as SqlWindow
from pyspark.sql import functions as F

from dimweave.operators.facts import Window
from dimweave.plans.steps import StepResult, dimension_step, fact_step, reject_step
from dimweave.sources.ingest import stage_frame
from dimweave.sources.schemas import COLOCATED, FACT_TABLE, MONEY, POLICIES, RATE, REJECT_TABLE, SOURCES
from dimweave.sources.scratch import released, scratch_root
from dimweave.sources.warehouse import Change, Snapshot, Warehouse

# Fixed values of the sample batches.
AS_OF = {1: datetime.date(2024, 1, 1), 2: datetime.date(2024, 2, 1), 3: datetime.date(2024, 3, 1)}
WINDOWS = {1: Window.parse("1995-01-01", "1997-06-30"), 2: Window.parse("1997-01-01", "1997-12-31"),
           3: Window.parse("1997-01-01", "1997-12-31")}

NEW_KEYS, LOST_KEYS = 1000000, 10000000  # added to keys for a key that is new, for one that is in no dimension
BEYOND = 10**9  # a multiple of it is added where that key is taken


def load_time(batch: int) -> datetime.datetime:
    return datetime.datetime.combine(AS_OF[batch], datetime.time(6))


def _every(key: str, n: int, rest: int = 0) -> Column:
    return F.col(key) % n == rest


def _starred(column: str, when: Column) -> Column:
    return F.when(when, F.concat(column, F.lit("*"))).otherwise(F.col(column)).alias(column)


def _ranked(df: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct values of a column with few values, numbered in order; one task sorts the distinct values only."""
    values = df.select(column).distinct()
    return values.select(column, F.row_number().over(SqlWindow.orderBy(column)).cast("long").alias(key))


def _under_new_keys(rows: DataFrame, kept: DataFrame, key: str, n: int) -> DataFrame:
    """Every ``n``-th row with its key raised by ``NEW_KEYS``, or beyond all keys where a row of ``kept`` has the raised key.

    Keys exceed ``NEW_KEYS`` on large tables, and a key that comes twice would fail the load.
    """
    taken = kept.select((F.col(key) - NEW_KEYS).alias(key)).distinct().withColumn("_taken", F.lit(True))
    highest = rows.agg(F.max(key).alias("_highest"))
    beyond = (F.floor((F.col("_highest") + LOST_KEYS) / BEYOND) + 1) * BEYOND
    added = rows.where(_every(key, n)).join(taken, key, "left").crossJoin(F.broadcast(highest))
    return added.withColumn(key, F.col(key) + F.when(F.col("_taken"), beyond).otherwise(NEW_KEYS)).select(*rows.columns)


def first_batch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
            for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    o, li = read["orders"], read["lineitem"]
    categories = _ranked(read["part"], "p_type", "CategoryID").select(
        "CategoryID", F.col("p_type").alias("CategoryName"))
    shippers = _ranked(o, "o_orderpriority", "ShipperID").select(
        "ShipperID", F.col("o_orderpriority").alias("CompanyName"))
    employee = (F.col("o_orderkey") % 9).cast("int")
    key = F.col("o_orderkey")
    order_rows = (o.join(read["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_name"), "o_custkey")
                  .join(shippers.withColumnRenamed("CompanyName", "o_orderpriority"), "o_orderpriority"))
    part = read["part"].join(categories.withColumnRenamed("CategoryName", "p_type"), "p_type")
    return {
        "Categories": categories,
        "Customers": read["customer"].select(
            F.col("c_custkey").cast("string").alias("CustomerID"), F.col("c_name").alias("CompanyName"),
            F.when(~_every("c_custkey", 7, 2), F.col("c_mktsegment")).alias("ContactTitle")),
        "Employees": o.select(employee.alias("EmployeeID")).distinct().withColumn(
            "LastName", F.concat(F.lit("Employee#"), F.col("EmployeeID").cast("string"))),
        "OrderDetails": li.select(
            F.when(_every("l_orderkey", 151), None).when(_every("l_orderkey", 149), F.col("l_orderkey") + LOST_KEYS)
            .otherwise(F.col("l_orderkey")).alias("OrderID"),
            F.when(_every("l_partkey", 157), None).when(_every("l_partkey", 163), F.col("l_partkey") + LOST_KEYS)
            .otherwise(F.col("l_partkey")).alias("ProductID"),
            F.col("l_extendedprice").cast(MONEY).alias("UnitPrice"), F.col("l_quantity").cast("int").alias("Quantity"),
            F.col("l_discount").cast(RATE).alias("Discount"), "l_suppkey", "l_linenumber"),
        "Orders": order_rows.select(
            key.alias("OrderID"),
            F.when(_every("o_orderkey", 101), None).when(_every("o_orderkey", 103), F.lit("X"))
            .otherwise(F.col("o_custkey").cast("string")).alias("CustomerID"),
            F.when(_every("o_orderkey", 107), None).when(_every("o_orderkey", 109), F.lit(99))
            .otherwise(employee).alias("EmployeeID"),
            F.when(~_every("o_orderkey", 139), F.col("o_orderdate").cast("date")).alias("OrderDate"),
            F.when(~_every("o_orderkey", 11), F.date_add(F.col("o_orderdate").cast("date"), (key % 40).cast("int"))).alias("RequiredDate"),
            F.when(~_every("o_orderkey", 13), F.date_add(F.col("o_orderdate").cast("date"), (key % 15 + 1).cast("int"))).alias("ShippedDate"),
            F.when(_every("o_orderkey", 113), None).when(_every("o_orderkey", 127), F.lit(99))
            .otherwise(F.col("ShipperID")).alias("ShipVia"),
            F.col("o_totalprice").cast(MONEY).alias("Freight"),
            F.when(~_every("o_orderkey", 17), F.concat(F.lit("For "), "c_name")).alias("ShipName"),
            F.concat(key.cast("string"), F.lit(" Street")).alias("ShipAddress"),
            F.concat(F.lit("City "), (F.col("o_custkey") % 50).cast("string")).alias("ShipCity"),
            F.when(~_every("o_orderkey", 19), F.concat(F.lit("Region "), (key % 7).cast("string"))).alias("ShipRegion"),
            F.concat(F.lit("P"), (key % 1000).cast("string")).alias("ShipPostalCode"),
            F.concat(F.lit("Country "), F.col("c_nationkey").cast("string")).alias("ShipCountry"),
            F.when(_every("o_orderkey", 131), None).when(_every("o_orderkey", 137), F.lit("ZZ"))
            .otherwise(F.col("c_nationkey").cast("string")).alias("TerritoryID")),
        "Products": part.select(
            F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("ProductName"),
            (F.col("p_partkey") % 10).alias("SupplierID"), "CategoryID", F.col("p_brand").alias("QuantityPerUnit"),
            F.col("p_retailprice").cast(MONEY).alias("UnitPrice"), F.col("p_size").alias("UnitsInStock"),
            _every("p_partkey", 20).alias("Discontinued")),
        "Region": read["region"].select(F.col("r_regionkey").alias("RegionID"),
                                        F.col("r_name").alias("RegionDescription")),
        "Shippers": shippers,
        "Suppliers": read["supplier"].select(
            F.col("s_suppkey").alias("SupplierID"), F.col("s_name").alias("CompanyName"),
            F.col("s_nationkey").cast("string").alias("Country")),
        "Territories": read["nation"].select(
            F.col("n_nationkey").cast("string").alias("TerritoryID"), F.col("n_name").alias("TerritoryDescription"),
            F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("TerritoryCode"),
            F.col("n_regionkey").alias("RegionID")),
    }


def second_batch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    b = first_batch(spark, sf_dir)
    customer, territory = F.col("CustomerID").cast("int"), F.col("TerritoryID").cast("int")
    later = F.when(_every("OrderID", 29), F.date_add("OrderDate", 365)).otherwise(F.col("OrderDate"))
    added_customers = b["Customers"].where(customer % 11 == 0).withColumn(
        "CustomerID", F.concat(F.lit("N"), "CustomerID"))
    suppliers = b["Suppliers"].where(~_every("SupplierID", 10, 3))
    added_suppliers = _under_new_keys(b["Suppliers"], suppliers, "SupplierID", 10)
    products = b["Products"].where(~_every("ProductID", 17, 3))
    added_products = _under_new_keys(b["Products"], products, "ProductID", 11)
    raised = F.when(_every("ProductID", 5, 1), (F.col("UnitPrice") + 1).cast(MONEY)).otherwise(F.col("UnitPrice"))
    more = F.when(_every("OrderID", 23), F.col("Quantity") + 1).otherwise(F.col("Quantity"))
    return {
        "Categories": b["Categories"].where("CategoryID <> 2")
        .withColumn("CategoryName", _starred("CategoryName", F.col("CategoryID") == 3))
        .unionByName(spark.createDataFrame([(100, "NEW")], "CategoryID long, CategoryName string")),
        "Customers": b["Customers"].where(customer % 17 != 3)
        .withColumn("CompanyName", _starred("CompanyName", customer % 5 == 1))
        .withColumn("ContactTitle", F.coalesce("ContactTitle", F.lit(""))).unionByName(added_customers),
        "Employees": b["Employees"].where("EmployeeID <> 8")
        .withColumn("LastName", _starred("LastName", F.col("EmployeeID") == 1)),
        "OrderDetails": b["OrderDetails"].withColumn("Quantity", more),
        "Orders": b["Orders"].where(~_every("OrderID", 31)).withColumns({
            "OrderDate": later,
            "RequiredDate": F.when(_every("OrderID", 47), F.date_add("RequiredDate", 1)).otherwise(F.col("RequiredDate")),
            "ShippedDate": F.when(~_every("OrderID", 53), F.col("ShippedDate")),
            "ShipName": F.coalesce("ShipName", F.lit("")),  # as good as NULL to the change test
            **{c: _starred(c, _every("OrderID", n)) for c, n in _MOVED.items()}}),
        "Products": products.withColumn("UnitPrice", raised)
        .unionByName(added_products),
        "Region": b["Region"].where("RegionID <> 4")
        .withColumn("RegionDescription", _starred("RegionDescription", F.col("RegionID") == 1)),
        "Shippers": b["Shippers"].where("ShipperID <> 4")
        .withColumn("CompanyName", _starred("CompanyName", F.col("ShipperID") == 1)),
        "Suppliers": suppliers
        .withColumn("CompanyName", _starred("CompanyName", _every("SupplierID", 5, 1))).unionByName(added_suppliers),
        "Territories": b["Territories"].where(territory % 5 != 3)
        .withColumn("TerritoryDescription", _starred("TerritoryDescription", territory % 5 == 2))
        .withColumn("TerritoryCode", _starred("TerritoryCode", territory % 5 == 1)),
    }


_MOVED = {"ShipAddress": 37, "ShipCity": 41, "ShipRegion": 43, "ShipPostalCode": 59, "ShipCountry": 61}

BATCHES = {1: first_batch, 2: second_batch, 3: first_batch}

# Steps in load order and the steps whose tables each one reads: of the previous and of the same batch.
_DIMENSIONS = list(POLICIES)
STEPS = [*_DIMENSIONS, FACT_TABLE, REJECT_TABLE]
_BEFORE = {
    "DimCategories": ["DimCategories", "DimProducts"], "DimSuppliers": ["DimSuppliers", "DimProducts"],
    "DimEmployees": ["DimEmployees", FACT_TABLE], "DimProducts": [], FACT_TABLE: [], REJECT_TABLE: [REJECT_TABLE],
}
_SAME = {
    "DimSuppliers": ["DimCategories"], "DimTerritories": ["DimRegion"], "DimProducts": ["DimSuppliers"],
    FACT_TABLE: _DIMENSIONS, REJECT_TABLE: _DIMENSIONS,
}


def _at_once(calls: list) -> list:
    """Results of independent driver-side calls, made from several threads."""
    with ThreadPoolExecutor(max(len(calls), 1)) as pool:
        return list(pool.map(lambda call: call(), calls))


class SampleLoads:
    """Loads of the sample batches, run step by step as they are asked for and kept as snapshots."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.warehouse = Warehouse(spark, f"{scratch_root(spark)}/samples")
        self._done: dict[tuple, tuple[Snapshot, dict]] = {}
        self._locks: dict[tuple, threading.Lock] = {}
        self._large = threading.Lock()  # one of the large sheets is staged at a time, as each needs several times its size on disk

    def staged(self, batch: int, source: str) -> DataFrame:
        return self._stage(batch, source)[0].frame(source)

    def apart(self, batch: int, source: str):
        """A staged table as it is laid out."""
        return self._stage(batch, source)[0].apart(source)

    def frame(self, batch: int, table: str, step: str | None = None) -> DataFrame:
        """A table after its step of a batch, or after an earlier step that also changed it."""
        return self.after(batch, step or table).frame(table)

    def after(self, batch: int, step: str) -> Snapshot:
        return self._run(batch, step)[0]

    def before(self, batch: int, step: str) -> Snapshot:
        """Everything a step reads."""
        return self._base(batch, step)[0]

    def _empty(self):
        return Snapshot(self.spark, self.warehouse.root), {}

    def _merge(self, parts):
        """Union of snapshots, the later load of each table winning."""
        base, when = self._empty()
        tables, keys, stats, gone = {}, {}, {}, {}
        for snap, stamps in parts:
            stats |= snap.stats
            for name, stamp in stamps.items():
                if stamp > when.get(name, (0, -1)):
                    tables[name], when[name] = snap.tables[name], stamp
                    gone[name] = snap.gone.get(name, {})
            for column, last in snap.last_keys.items():
                keys[column] = max(last, keys.get(column, 0))
        return Snapshot(self.spark, base.root, 0, tables, keys, stats, {t: m for t, m in gone.items() if m}), when

    def _once(self, name: tuple, run):
        """Run a step at most once; steps that do not depend on each other may run at the same time."""
        with self._locks.setdefault(name, threading.Lock()):
            if name not in self._done:
                self._done[name] = run()
            return self._done[name]

    def _stage(self, batch: int, source: str):
        def run():
            df = BATCHES[batch](self.spark, self.sf_dir)[source]
            extra = ("l_suppkey", "l_linenumber") if source == "OrderDetails" else ()
            with self._large if source in COLOCATED else contextlib.nullcontext(), released():
                staged = Change(source, stage_frame(df, source, extra))
                return self.warehouse.write(self._empty()[0], [staged], {}), {source: (batch, 0)}

        return self._once((batch, "stage", source), run)

    def stage_all(self, batch: int, sources: list[str]) -> dict[str, DataFrame]:
        return dict(zip(sources, _at_once([lambda s=s: self.staged(batch, s) for s in sources])))

    def _base(self, batch: int, step: str):
        sources = [POLICIES[step].source] if step in POLICIES else ["Orders", "OrderDetails"]
        needed = [(batch - 1, s) for s in _BEFORE.get(step, [step])] if batch > 1 else []
        needed += [(batch, s) for s in _SAME.get(step, [])]
        return self._merge(_at_once([lambda n=n: self._run(*n) for n in needed]
                                    + [lambda s=s: self._stage(batch, s) for s in sources]))

    def _run(self, batch: int, step: str):
        def run():
            base, when = self._base(batch, step)
            with released():
                result = self.load(base, batch, step)
                snap = self.warehouse.write(base, result.changes, result.last_keys)
            stamp = (batch, STEPS.index(step) + 1)
            return snap, {**when, **{c.table: stamp for c in result.changes}}

        return self._once((batch, step), run)

    def load(self, base: Snapshot, batch: int, step: str) -> StepResult:
        if step in POLICIES:
            return dimension_step(base, POLICIES[step], AS_OF[batch])
        run = fact_step if step == FACT_TABLE else reject_step
        return run(base, WINDOWS[batch], load_time(batch))


def all_sources(spark: SparkSession, sf_dir: str, batch: int) -> dict[str, DataFrame]:
    """Sheets of a batch as the job takes them, without the columns only used to order rows."""
    sheets = BATCHES[batch](spark, sf_dir)
    return {s: sheets[s].drop("l_suppkey", "l_linenumber") for s in SOURCES}
