"""Drafts that break the integrity of the tables are not published; concurrent drafts meet."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from dimweave.operators import facts
from dimweave.plans import gate, job, steps
from dimweave.plans.job import read_audit, run_load
from dimweave.plans.samples import AS_OF, WINDOWS, all_sources
from dimweave.sources.warehouse import CLOSED, CURRENT, Change, ConflictError, Warehouse

NOW = datetime.datetime(2024, 6, 1)


def stamped(rows, **more):
    return [{"SOR_SK": 1, "staging_raw_id_nk": i, **more, **r} for i, r in enumerate(rows)]


@pytest.fixture
def warehouse(spark, table, tmp_path):
    """One valid row in each table that the fact refers to, and one fact row."""
    house = Warehouse(spark, str(tmp_path))
    current = {"ValidFrom": NOW.date(), "IsCurrent": True}
    changes = [
        Change("DimEmployees", table("DimEmployees", stamped([{"EmployeeID_SK": 1, "EmployeeID_NK": 11}, {"EmployeeID_SK": 2, "EmployeeID_NK": 12}]))),
        Change("DimShippers", table("DimShippers", stamped([{"ShipperID_SK": 1, "ShipperID_NK": 11}]))),
        Change("DimRegion", table("DimRegion", stamped([{"RegionID_SK": 1, "RegionID_NK": 11}]))),
        Change("DimTerritories", table("DimTerritories", stamped([{"TerritoryID_SK": 1, "TerritoryID_NK": "T", "RegionID_SK_FK": 1}]))),
        Change("DimCustomers", table("DimCustomers", stamped([{"CustomerID_TABLE_SK": 2, "CustomerID_NK": "A"}], **current)), part=CURRENT),
        Change("DimCustomers", table("DimCustomers", stamped([{"CustomerID_TABLE_SK": 1, "CustomerID_NK": "A", "ValidFrom": NOW.date(), "IsCurrent": False}])), part=CLOSED),
        Change("DimProducts", table("DimProducts", stamped([{"ProductID_TABLE_SK": 1, "ProductID_NK": 11}], **current)), part=CURRENT),
        Change("FactOrders", table("FactOrders", [fact(1, 10)])),
    ]
    house.publish(house.write(house.snapshot(), changes, {}))
    return house


def fact(sk, order, **changes):
    return {"FactOrder_SK": sk, "OrderID_NK": order, "ProductID_NK": 11, "CustomerID_TABLE_SK_FK": 2, "EmployeeID_SK_FK": 1, "ShipperID_SK_FK": 1, "TerritoryID_SK_FK": 1,
            "ProductID_TABLE_SK_FK": 1, "OrderDate": datetime.date(2024, 1, 5), "SnapshotDate": NOW.date(), "LoadDate": NOW, **changes}


def found(warehouse, *changes):
    base = warehouse.snapshot()
    return gate.problems(warehouse.write(base, list(changes), {}), base, [c.table for c in changes])


@pytest.mark.parametrize(("rows", "problem"), [
    ([fact(1, 10), fact(2, 20)], None),
    ([fact(1, 10, CustomerID_TABLE_SK_FK=1)], None),  # a closed version is a row too
    ([fact(1, 10), fact(2, 10)], "FactOrders: {'OrderID_NK': 10, 'ProductID_NK': 11} in 2 rows"),
    ([fact(1, 10, ShipperID_SK_FK=None)], "FactOrders.ShipperID_SK_FK: 1 NULLs"),
    ([fact(1, 10, LoadDate=None), fact(2, 20, LoadDate=None)], "FactOrders.LoadDate: 2 NULLs"),
    ([fact(1, 10, CustomerID_TABLE_SK_FK=3)], "FactOrders.CustomerID_TABLE_SK_FK: no row 3 in DimCustomers"),
    ([fact(1, 10, TerritoryID_SK_FK=9)], "FactOrders.TerritoryID_SK_FK: no row 9 in DimTerritories"),
])
def test_fact_rows(warehouse, table, rows, problem):
    change = Change("FactOrders", table("FactOrders", rows), months=["2024-01"])
    assert found(warehouse, change) == ([problem] if problem else [])


def test_dimension_rows(warehouse, table):
    employees = stamped([{"EmployeeID_SK": 1, "EmployeeID_NK": 11}, {"EmployeeID_SK": 2, "EmployeeID_NK": 11}])
    assert found(warehouse, Change("DimEmployees", table("DimEmployees", employees))) == ["DimEmployees: {'EmployeeID_NK': 11} in 2 rows"]
    versions = stamped([{"CustomerID_TABLE_SK": 2, "CustomerID_NK": "A"}, {"CustomerID_TABLE_SK": 3, "CustomerID_NK": "A"}], ValidFrom=NOW.date(), IsCurrent=True)
    assert found(warehouse, Change("DimCustomers", table("DimCustomers", versions), part=CURRENT)) == ["DimCustomers: {'CustomerID_NK': 'A'} in 2 rows"]
    territories = stamped([{"TerritoryID_SK": 1, "TerritoryID_NK": "T", "RegionID_SK_FK": 7}])
    assert found(warehouse, Change("DimTerritories", table("DimTerritories", territories))) == ["DimTerritories.RegionID_SK_FK: no row 7 in DimRegion"]
    nameless = stamped([{"ShipperID_SK": 1, "ShipperID_NK": None}])
    assert found(warehouse, Change("DimShippers", table("DimShippers", nameless))) == ["DimShippers.ShipperID_NK: 1 NULLs"]


def test_removed_rows_leave_nothing_behind(warehouse, table):
    second = Change("DimEmployees", table("DimEmployees", stamped([{"EmployeeID_SK": 2, "EmployeeID_NK": 12}])))
    assert found(warehouse, second) == ["FactOrders.EmployeeID_SK_FK: row 1 of DimEmployees is gone"]
    none_left = Change("FactOrders", table("FactOrders", []), months=["2024-01"])
    assert found(warehouse, second, none_left) == []
    first = Change("DimEmployees", table("DimEmployees", stamped([{"EmployeeID_SK": 1, "EmployeeID_NK": 11}])))
    assert found(warehouse, first) == []


def test_a_step_that_breaks_a_key_fails_and_leaves_the_old_state(spark, sf_dir, tmp_path, monkeypatch):
    root, sources = str(tmp_path), all_sources(spark, sf_dir, 1)
    assert run_load(spark, sources, root, WINDOWS[1], AS_OF[1])["success"]
    before = Warehouse(spark, root).snapshot()
    whole = steps.facts.fact_changes

    def twice(*args, **kwargs):
        loaded = whole(*args, **kwargs)
        return facts.FactLoaded(loaded.rows.union(loaded.rows), loaded.last_key, loaded.inserted, loaded.gone)

    monkeypatch.setattr(steps.facts, "fact_changes", twice)
    result = run_load(spark, all_sources(spark, sf_dir, 2), root, WINDOWS[2], AS_OF[2])
    assert not result["success"]
    assert "FactOrders: {'OrderID_NK'" in result["error"]
    after = Warehouse(spark, root).snapshot()
    assert after.tables["FactOrders"].keys() == before.tables["FactOrders"].keys()  # only the cascade of employees changed it
    assert after.rows("FactOrders") < before.rows("FactOrders")
    last = read_audit(spark, root).orderBy(F.desc("step_no")).where(F.col("execution_id") == result["execution_id"]).first()
    assert (last["step"], last["status"]) == ("update_fact", "Failed")
    assert job.IntegrityError is gate.IntegrityError


def test_two_drafts_on_one_base(warehouse, table):
    base = warehouse.snapshot()

    def draft(name, **row):
        return warehouse.write(base, [Change(name, table(name, stamped([row])))], {f"key of {name}": 5})

    shippers, regions, again = draft("DimShippers", ShipperID_SK=4), draft("DimRegion", RegionID_SK=5), draft("DimShippers", ShipperID_SK=6)
    warehouse.publish(shippers, base)
    published = warehouse.publish(regions, base)
    assert published.version == base.version + 2
    state = warehouse.snapshot()
    assert [state.frame("DimShippers").first()["ShipperID_SK"], state.frame("DimRegion").first()["RegionID_SK"]] == [4, 5]
    assert {"key of DimShippers", "key of DimRegion"} <= set(state.last_keys)
    assert state.rows("DimShippers") == 1
    with pytest.raises(ConflictError, match="DimShippers"):
        warehouse.publish(again, base)
    with pytest.raises(ConflictError, match="already exists"):
        warehouse.publish(again)
    assert warehouse.snapshot().tables == state.tables


def test_appends_to_one_table_meet(warehouse, table):
    base = warehouse.snapshot()
    drafts = [warehouse.write(base, [Change("DimSuppliers_History", table("DimSuppliers_History", [{"SupplierHistoryID_SK": i, "SupplierID_NK": i}]), append=True)], {}) for i in range(6)]
    errors = []

    def publish(draft):
        try:
            warehouse.publish(draft, base)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=publish, args=(d,)) for d in drafts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    state = warehouse.snapshot()
    assert state.version == base.version + 6
    assert sorted(r["SupplierHistoryID_SK"] for r in state.frame("DimSuppliers_History").collect()) == list(range(6))


def test_a_claim_without_a_commit_is_told(warehouse, table, monkeypatch):
    monkeypatch.setattr("dimweave.sources.warehouse.CLAIM_SECONDS", 1)
    base = warehouse.snapshot()
    draft = warehouse.write(base, [Change("DimRegion", table("DimRegion", stamped([{"RegionID_SK": 5}])))], {})
    warehouse._fs().create(warehouse._path(f"_claims/{draft.version:010d}"), False).close()
    with pytest.raises(RuntimeError, match="claimed but not published"):
        warehouse.publish(draft, base)
