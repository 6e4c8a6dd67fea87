"""Every key that the tables declare unique is looked at."""

import datetime

import pytest

from dimweave.plans import registry
from dimweave.sources.schemas import FACT_TABLE, POLICIES, REJECT_TABLE

DAY = datetime.date(2024, 1, 1)


class Tables:
    """Given rows in place of loads."""

    def __init__(self, spark, table, rows):
        self.spark, self._table, self._rows = spark, table, rows

    def frame(self, batch, table, step=None):
        return self._table(table, self._rows.get(table, []))

    def staged(self, batch, source):
        return self._table(source, self._rows.get(source, []))


def found(spark, table, **rows):
    return sorted(tuple(r) for r in registry._unique_keys(Tables(spark, table, rows)).collect())


def test_fact_keys(spark, table):
    rows = [{"FactOrder_SK": sk, "OrderID_NK": order, "ProductID_NK": 5, "OrderDate": DAY} for sk, order in ((1, 10), (1, 11), (2, 12), (3, 12), (4, 13))]
    assert found(spark, table, **{FACT_TABLE: rows}) == [("FactOrders.FactOrder_SK", "1", 2), ("FactOrders.OrderID_NK-ProductID_NK", "12-5", 2)]


@pytest.mark.parametrize(("name", "kind"), [("DimCustomers", str), ("DimProducts", int)])
def test_current_natural_keys(spark, table, name, kind):
    nk, sk = POLICIES[name].nk, POLICIES[name].surrogate
    rows = [{sk: i, nk: kind(key), "IsCurrent": current} for i, (key, current) in enumerate([(1, True), (1, False), (1, False), (2, True), (2, True), (3, False)])]
    assert found(spark, table, **{name: rows}) == [(f"{name}.{nk}", "2", 2)]


def test_other_keys_as_before(spark, table):
    rows = {
        "DimRegion": [{"RegionID_SK": 1, "RegionID_NK": 4}, {"RegionID_SK": 2, "RegionID_NK": 4}], REJECT_TABLE: [{"FactOrder_Error_SK": 9}] * 3,
        "OrderDetails": [{"OrderID": 7, "ProductID": 8}] * 2 + [{"OrderID": 8, "ProductID": 7}],
    }
    assert found(spark, table, **rows) == [("DimRegion.RegionID_NK", "4", 2), ("FactOrders_Error.FactOrder_Error_SK", "9", 3), ("OrderDetails", "7-8", 2)]


def test_source_table(spark, table, monkeypatch):
    monkeypatch.setattr(registry, "sor_rows", lambda: [(1, "Orders"), (1, "Region"), (2, "Region")])
    assert found(spark, table) == [("Dim_SOR.SOR_SK", "1", 2), ("Dim_SOR.staging_raw_table_name", "Region", 2)]
