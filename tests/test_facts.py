"""Hand-written cases for the fact and reject rules, and for the job."""

import datetime
import decimal
import time

import pytest
from pyspark.sql import functions as F

from dimweave.functions import reasons
from dimweave.operators import facts
from dimweave.operators.facts import Window
from dimweave.plans.job import _Run, main, read_audit, run_load
from dimweave.sources.schemas import FACT_TABLE, POLICIES, REJECT_TABLE, SOURCES, STAGING, table_schema
from dimweave.sources.scratch import materialize
from dimweave.sources.warehouse import Change, Warehouse

JAN, FEB, MAR = (datetime.date(2024, m, 15) for m in (1, 2, 3))
WINDOW = Window(datetime.date(2024, 1, 1), datetime.date(2024, 1, 31))
NOW = datetime.datetime(2024, 6, 1, 12, 30, 5, 999)


@pytest.fixture
def dims(table):
    """One current row per dimension; customer B and product 8 have no current version."""
    return {
        "DimCustomers": table("DimCustomers", [
            {"CustomerID_TABLE_SK": 1, "CustomerID_NK": "A", "IsCurrent": True},
            {"CustomerID_TABLE_SK": 2, "CustomerID_NK": "B", "IsCurrent": False}]),
        "DimEmployees": table("DimEmployees", [{"EmployeeID_SK": 3, "EmployeeID_NK": 1}]),
        "DimShippers": table("DimShippers", [{"ShipperID_SK": 4, "ShipperID_NK": 1}]),
        "DimTerritories": table("DimTerritories", [{"TerritoryID_SK": 5, "TerritoryID_NK": "T"}]),
        "DimProducts": table("DimProducts", [
            {"ProductID_TABLE_SK": 6, "ProductID_NK": 7, "IsCurrent": True},
            {"ProductID_TABLE_SK": 9, "ProductID_NK": 8, "IsCurrent": False}]),
    }


def order(row, order_id, **changes):
    return {"staging_raw_id_sk": row, "OrderID": order_id, "CustomerID": "A", "EmployeeID": 1, "ShipVia": 1,
            "TerritoryID": "T", "OrderDate": JAN, **changes}


def line(row, order_id, product_id=7, **changes):
    return {"staging_raw_id_sk": row, "OrderID": order_id, "ProductID": product_id,
            "UnitPrice": decimal.Decimal("2.5"), "Quantity": 4, "Discount": decimal.Decimal("0.1"), **changes}


@pytest.fixture
def source(table, dims):
    def build(orders, lines):
        return facts.fact_source(table("Orders", orders), table("OrderDetails", lines), dims, WINDOW)

    return build


@pytest.fixture
def rejects(table, dims):
    def build(orders, lines):
        found = facts.reject_source(table("Orders", orders), table("OrderDetails", lines), dims, WINDOW)
        return sorted(((r["OrderID_NK"], r["ProductID_NK"], r["ErrorReason"]) for r in found.collect()), key=repr)

    return build


def test_sales_amount_treats_null_as_zero(source):
    rows = source([order(1, 1), order(2, 2)], [line(1, 1), line(2, 2, Discount=None, UnitPrice=None)]).collect()
    assert {r["OrderID_NK"]: r["SalesAmount"] for r in rows} == {1: decimal.Decimal("9.0000"), 2: 0}


def test_newest_duplicate_decides_even_when_it_is_invalid(source, rejects):
    orders = [order(1, 1), order(2, 1, CustomerID="B")]
    lines = [line(1, 1)]
    assert source(orders, lines).count() == 0
    assert rejects(orders, lines) == [(1, 7, "Invalid CustomerID_NK; ")]


def test_newest_pair_is_newest_order_with_newest_line(source):
    rows = source([order(1, 1), order(5, 1)], [line(9, 1), line(4, 1)]).collect()
    assert [(r[facts.ORDERS_ROW], r[facts.LINES_ROW]) for r in rows] == [(5, 9)]


def test_invalid_duplicates_are_all_rejected(rejects):
    found = rejects([order(1, 1, CustomerID=None)], [line(1, 1), line(2, 1)])
    assert found == [(1, 7, "Missing CustomerID; ")] * 2


def test_null_order_date_disappears(source, rejects):
    orders, lines = [order(1, 1, OrderDate=None, CustomerID=None)], [line(1, 1)]
    assert source(orders, lines).count() == 0 and rejects(orders, lines) == []


def test_reasons_in_order(rejects):
    orders = [order(1, None, CustomerID=None, EmployeeID=2, ShipVia=None, TerritoryID="?"), order(2, 2)]
    lines = [line(1, 2, None), line(2, 2, 8)]
    assert rejects(orders, lines) == sorted([
        (None, None, "Missing OrderID; Missing OrderDetails row for OrderID; Missing CustomerID; "
         "Invalid EmployeeID_NK, employee is missing; Missing ShipVia/ShipperID; Invalid TerritoryID_NK; "),
        (2, None, "Missing ProductID; "),
        (2, 8, "Invalid ProductID_NK, product is missing or not current; ")], key=repr)


def test_order_without_lines_and_orphans_of_any_date(rejects):
    orders = [order(1, 1), order(2, 2, OrderDate=MAR)]
    lines = [line(1, 2), line(2, None, 7), line(3, 99, None)]
    assert rejects(orders, lines) == sorted([
        (1, None, reasons.NO_LINE), (None, 7, reasons.LINE_WITHOUT_ORDER_ID),
        (99, None, reasons.LINE_WITHOUT_ORDER + reasons.NO_PRODUCT)], key=repr)


@pytest.mark.parametrize("large", [False, True])
def test_collation_reaches_the_fact_lookups(request, table, dims, large):
    if large:
        request.getfixturevalue("shuffled")
    orders = table("Orders", [order(1, 1, CustomerID="a "), order(2, 2, TerritoryID="t"), order(3, 3, CustomerID=None)])
    lines = table("OrderDetails", [line(1, 1), line(2, 2), line(3, 3)])
    assert facts.fact_source(orders, lines, dims, WINDOW).count() == 0
    found = facts.fact_source(orders, lines, dims, WINDOW, "UTF8_LCASE_RTRIM")
    assert sorted(r["OrderID_NK"] for r in found.collect()) == [1, 2]
    bad = facts.reject_source(orders, lines, dims, WINDOW, "UTF8_LCASE_RTRIM")
    assert [(r["OrderID_NK"], r["ErrorReason"]) for r in bad.collect()] == [(3, "Missing CustomerID; ")]


def test_large_paths_give_the_same_rejects(rejects, source, shuffled):
    test_reasons_in_order(rejects)


def test_merge_moves_updates_and_deletes(table, source):
    fresh = materialize(source([order(i, i) for i in (1, 2, 3)], [line(i, i) for i in (1, 2, 3)]), "fresh")
    start = facts.merge_fact(None, fresh, WINDOW, NOW, 0)
    stored = {r["OrderID_NK"]: r.asDict() for r in start.rows.collect()}
    assert start.last_key == 3 and sorted(r["FactOrder_SK"] for r in stored.values()) == [1, 2, 3]
    assert stored[1]["LoadDate"] == datetime.datetime(2024, 6, 1, 12, 30, 5)
    stored[2]["OrderDate"] = FEB  # stored outside the window, in the source inside: updated where it is
    stored[3]["OrderID_NK"] = 33  # in the window without a source row: deleted
    stored[4] = {**stored[1], "OrderID_NK": 44, "OrderDate": FEB, "FactOrder_SK": 4}  # outside: kept
    later = NOW + datetime.timedelta(days=1)
    merged = facts.merge_fact(table(FACT_TABLE, stored.values()), fresh, WINDOW, later, 4)
    rows = {r["OrderID_NK"]: r for r in merged.rows.collect()}
    assert sorted(rows) == [1, 2, 3, 44] and merged.last_key == 5
    assert rows[1]["LoadDate"] == stored[1]["LoadDate"] and rows[1]["FactOrder_SK"] == stored[1]["FactOrder_SK"]
    assert rows[2]["OrderDate"] == JAN and rows[2]["FactOrder_SK"] == stored[2]["FactOrder_SK"]
    assert rows[2]["SnapshotDate"] == later.date() and rows[3]["FactOrder_SK"] == 5
    assert facts.months_to_merge(table(FACT_TABLE, stored.values()), fresh, WINDOW) == ["2024-02"]


def test_rejects_of_other_sources_survive_a_refresh(table):
    def reject(key, date, sor):
        return {"FactOrder_Error_SK": key, "OrderDate": date, facts.ORDERS_SOURCE: sor, facts.LINES_SOURCE: 4}

    stored = table(REJECT_TABLE, [reject(1, JAN, 5), reject(2, None, 5), reject(3, FEB, 5), reject(4, JAN, 1),
                                  reject(5, JAN, None)])
    new = table(REJECT_TABLE, [{"OrderDate": JAN}]).drop("FactOrder_Error_SK", "RejectedDate")
    out = facts.refresh_rejects(stored, new, WINDOW, NOW, 5)
    assert sorted(r["FactOrder_Error_SK"] for r in out.rows.collect()) == [3, 4, 5, 6]


def test_window_is_checked():
    with pytest.raises(ValueError):
        Window(FEB, JAN)
    with pytest.raises(ValueError):
        Window.parse("2024-13-01", "2024-12-31")
    with pytest.raises(ValueError):
        Window(None, JAN)


@pytest.fixture
def sheets(table, spark):
    """A small set of source sheets, without row ids."""
    rows = {
        "Categories": [{"CategoryID": 1}], "Customers": [{"CustomerID": "A"}],
        "Employees": [{"EmployeeID": 1}, {"EmployeeID": 2}], "Products": [{"ProductID": 7, "CategoryID": 1}],
        "Region": [{"RegionID": 1}], "Shippers": [{"ShipperID": 1}], "Suppliers": [{"SupplierID": 1}],
        "Territories": [{"TerritoryID": "T", "RegionID": 1}],
        "Orders": [order(1, 1), order(2, 2, EmployeeID=2, OrderDate=FEB), order(3, 3, CustomerID="?")],
        "OrderDetails": [line(1, 1), line(2, 2), line(3, 3)],
    }
    return {s: table(s, rows[s], schema=STAGING[s]) for s in SOURCES}


def test_job_runs_fails_safely_and_cascades(spark, sheets, tmp_path):
    root, year = str(tmp_path / "warehouse"), Window.parse("2024-01-01", "2024-12-31")
    first = run_load(spark, sheets, root, year, JAN, NOW)
    assert first["success"] and first["status"] == "Completed"
    warehouse = Warehouse(spark, root)
    state = warehouse.snapshot()
    assert sorted(r["OrderID_NK"] for r in state.frame(FACT_TABLE).collect()) == [1, 2]
    assert state.months(FACT_TABLE) == ["2024-01", "2024-02"]
    assert [r["ErrorReason"] for r in state.frame(REJECT_TABLE).collect()] == ["Invalid CustomerID_NK; "]

    # A duplicate key fails the categories step; earlier steps stay, later ones do not run.
    broken = {**sheets, "Categories": sheets["Categories"].union(sheets["Categories"]),
              "Region": sheets["Region"].limit(0)}
    second = run_load(spark, broken, root, year, FEB)
    assert not second["success"] and "duplicate natural keys" in second["error"]
    now = warehouse.snapshot()
    assert now.tables["DimCategories"] == state.tables["DimCategories"]
    assert now.tables[FACT_TABLE] == state.tables[FACT_TABLE]
    assert now.frame("Region").count() == 0 and state.frame("Region").count() == 1
    audit = read_audit(spark, root).where(f"execution_id = '{second['execution_id']}'").orderBy("step_no").collect()
    assert (audit[-1]["step"], audit[-1]["status"], audit[-1]["n_rows"]) == ("update_DimCategories", "Failed", None)

    # Employee 2 vanishes: the February row goes although the window is January, and is not rejected.
    fewer = {**sheets, "Employees": sheets["Employees"].where("EmployeeID = 1")}
    assert run_load(spark, fewer, root, WINDOW, MAR)["success"]
    last = warehouse.snapshot()
    assert [r["OrderID_NK"] for r in last.frame(FACT_TABLE).collect()] == [1]
    assert last.months(FACT_TABLE) == ["2024-01"]
    assert last.tables[FACT_TABLE] != state.tables[FACT_TABLE]
    assert last.frame("DimEmployees").count() == 1


def test_ingest_stops_at_the_first_bad_sheet(spark, sheets, tmp_path):
    """Sheets before the bad one are replaced, the others are not, and nothing is loaded."""
    root = str(tmp_path / "w")
    bad = {**sheets, "Employees": sheets["Employees"].withColumnRenamed("Title", "Rank")}
    result = run_load(spark, bad, root, WINDOW, JAN)
    assert not result["success"] and "Rank" in result["error"]
    assert sorted(Warehouse(spark, root).snapshot().tables) == ["Categories", "Customers", "Dim_SOR", "LoadAudit"]
    assert [r["status"] for r in read_audit(spark, root).orderBy("step_no").collect()] == [
        "Completed", "Completed", "Failed"]


def test_over_long_text_fails_its_step(spark, sheets, tmp_path):
    root = str(tmp_path / "w")
    long = sheets["Categories"].withColumn("CategoryName", F.lit("x" * 101))
    result = run_load(spark, {**sheets, "Categories": long}, root, WINDOW, JAN)
    assert not result["success"] and "longer than 100" in result["error"]
    assert sorted(Warehouse(spark, root).snapshot().tables) == ["Dim_SOR", "LoadAudit"]


def test_sources_are_listed_whatever_the_sheets_hold(spark, sheets, tmp_path):
    root = str(tmp_path / "w")
    assert run_load(spark, {**sheets, "Region": sheets["Region"].limit(0)}, root, WINDOW, JAN)["success"]
    listed = Warehouse(spark, root).snapshot().frame("Dim_SOR").orderBy("SOR_SK").collect()
    assert [tuple(r) for r in listed] == [(i + 1, s) for i, s in enumerate(SOURCES)]


def test_csv_and_parquet_sheets_give_the_same_fact(spark, sheets, tmp_path):
    """Two lines of one pair: the later row counts, although its price sorts first."""
    lines = [{"OrderID": 1, "ProductID": 7, "UnitPrice": 9.0, "Quantity": 1}, {"OrderID": 1, "ProductID": 7, "UnitPrice": 2.0, "Quantity": 1}]
    prices = {}
    for fmt in ("csv", "parquet"):
        given = {}
        for name, sheet in sheets.items():
            path = str(tmp_path / f"{name}.{fmt}")
            own = spark.createDataFrame(lines, "OrderID long, ProductID long, UnitPrice double, Quantity int") if name == "OrderDetails" else sheet
            own.coalesce(1).write.option("header", True).format(fmt).save(path)
            given[name] = path
        root = str(tmp_path / f"warehouse-{fmt}")
        assert run_load(spark, given, root, WINDOW, JAN, source_format=fmt)["success"]
        prices[fmt] = [float(r["UnitPrice"]) for r in Warehouse(spark, root).snapshot().frame(FACT_TABLE).collect()]
    assert prices == {"csv": [2.0], "parquet": [2.0]}


def test_time_stamps_do_not_depend_on_time_zones(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        stamp = spark.range(1).select(facts._second(NOW).cast("string").alias("t")).first()["t"]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert stamp == "2024-06-01 12:30:05"


def test_failed_write_leaves_the_published_state(spark, table, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    base = warehouse.snapshot()
    warehouse.publish(warehouse.write(base, [Change("Region", table("Region", [{"RegionID": 1}]))], {"k": 1}))
    bad = table("Region", [{"RegionID": 2}]).selectExpr(
        "staging_raw_id_sk", "raise_error('boom') RegionID", "RegionDescription", "RegionCategory", "RegionImportance")
    with pytest.raises(Exception, match="boom"):
        warehouse.write(warehouse.snapshot(), [Change("Region", bad)], {})
    assert warehouse.snapshot().version == 1
    with pytest.raises(RuntimeError, match="already exists"):
        warehouse.publish(warehouse.write(base, [], {}))


def test_upkeep_keeps_what_readers_use(spark, table, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for i in range(5):
        rows = table("Region", [{"RegionID": i}])
        warehouse.publish(warehouse.write(warehouse.snapshot(), [Change("Region", rows), Change("Shippers", table("Shippers", [{"ShipperID": i}]), append=True)], {}))
    before = warehouse.snapshot(4)
    assert warehouse.vacuum(keep=2) == []  # all folders are young
    assert len(warehouse.vacuum(keep=2, older_than_hours=-1)) == 3
    assert [r["RegionID"] for r in before.frame("Region").collect()] == [3]
    assert warehouse.snapshot().frame("Shippers").count() == 5
    with pytest.raises(ValueError, match="no version 3"):
        warehouse.snapshot(3)
    assert not warehouse.compact("Shippers")
    assert warehouse.compact("Shippers", folders=2)
    assert len(warehouse.snapshot().tables["Shippers"]["all"]) == 1
    assert sorted(r["ShipperID"] for r in warehouse.snapshot().frame("Shippers").collect()) == [0, 1, 2, 3, 4]
    assert before.frame("Shippers").count() == 4


def test_execution_ids_are_unique_uuids():
    ids = {_Run(None).execution_id for _ in range(100)}
    assert len(ids) == 100 and all(len(i) == 36 for i in ids)


def test_command_line_needs_dates_and_rejects_bad_windows():
    with pytest.raises(SystemExit):
        main(["--start_date", "2024-01-01"])
    with pytest.raises(ValueError):
        main(["--start_date", "2024-02-01", "--end_date", "2024-01-01", "--sources", "x", "--warehouse", "y"])


def test_schemas_cover_the_declared_tables():
    assert len(table_schema(FACT_TABLE)) == 28 and len(table_schema(REJECT_TABLE)) == 20
    assert {p.target: len(p.schema) for p in POLICIES.values()} == {
        "DimCategories": 6, "DimRegion": 7, "DimShippers": 6, "DimSuppliers": 16, "DimEmployees": 20,
        "DimCustomers": 18, "DimTerritories": 10, "DimProducts": 19}
    assert len(table_schema("DimSuppliers_History")) == 17
