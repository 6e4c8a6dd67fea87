"""A merge of the fact writes what changed: new rows, and the places of those that have gone."""

import datetime

import pytest
from pyspark.sql import functions as F

from dimweave.operators import facts
from dimweave.operators.facts import Window
from dimweave.sources import warehouse as warehouse_module
from dimweave.sources.schemas import FACT_SOURCE, FACT_TABLE
from dimweave.sources.statistics import record
from dimweave.sources.warehouse import Change, Warehouse

YEAR = Window(datetime.date(2024, 1, 1), datetime.date(2024, 12, 31))
NOW, LATER = datetime.datetime(2024, 6, 1, 8), datetime.datetime(2024, 7, 1, 9)


def source_rows(spark, n, quantity=None, date=None, but=None):
    """``n`` source rows over three months, some with another quantity or date, without those of ``but``."""
    rows = spark.range(n).select(
        F.col("id").alias("OrderID_NK"), (F.col("id") % 7).alias("ProductID_NK"),
        F.coalesce(date if date is not None else F.lit(None), F.date_add(F.lit(YEAR.start), (F.col("id") % 90).cast("int"))).alias("OrderDate"),
        (quantity if quantity is not None else F.lit(1)).cast("int").alias("Quantity"), *[F.lit(1).cast("long").alias(k.fk) for k in (*facts.ORDER_KEYS, *facts.LINE_KEYS)])
    if but is not None:
        rows = rows.where(~but)
    return record(rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FACT_SOURCE.fields]), "source")


@pytest.fixture
def house(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    first = facts.merge_fact(None, source_rows(spark, 3000), YEAR, NOW, 0)
    house.publish(house.write(house.snapshot(), [Change(FACT_TABLE, first.rows, append=True)], {}))
    return house


def merge(house, source, last_key=3000):
    base = house.snapshot()
    changed = facts.fact_changes(base.placed(FACT_TABLE), source, YEAR, LATER, last_key)
    draft = house.write(base, [Change(FACT_TABLE, changed.rows, append=True, gone=changed.gone)], {})
    return base, draft, changed


def shown(df):
    return sorted(tuple(r) for r in df.select("FactOrder_SK", "OrderID_NK", "Quantity", F.col("OrderDate").cast("string"), F.col("LoadDate").cast("string")).collect())


def test_a_merge_writes_what_changed(spark, house):
    one = F.col("id") % 100 == 3
    base, draft, changed = merge(house, source_rows(spark, 3000, quantity=F.when(one, 2).otherwise(1), but=F.col("id") % 1000 == 7))
    written = {p.split("/order_month=")[0] for paths in draft.written_since(base, FACT_TABLE).values() for p in paths}
    assert sum(draft.stats[f].rows for f in written) == 30
    assert changed.inserted == 0
    assert draft.rows(FACT_TABLE) == draft.frame(FACT_TABLE).count() == 2997
    whole = facts.merge_fact(base.frame(FACT_TABLE), source_rows(spark, 3000, quantity=F.when(one, 2).otherwise(1), but=F.col("id") % 1000 == 7), YEAR, LATER, 3000)
    assert shown(draft.frame(FACT_TABLE)) == shown(whole.rows)
    assert shown(base.frame(FACT_TABLE)) != shown(whole.rows)  # readers of the earlier state are not touched
    assert base.frame(FACT_TABLE).count() == 3000
    house.publish(draft, base)
    assert shown(house.snapshot().frame(FACT_TABLE)) == shown(whole.rows)
    assert shown(house.snapshot().frame(FACT_TABLE, ["2024-02"])) == [r for r in shown(whole.rows) if r[3].startswith("2024-02")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_merges_follow_each_other_and_fold(spark, house, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(warehouse_module, "fits_broadcast", lambda df: False)
    later = F.when(F.col("id") % 50 == 1, F.lit(datetime.date(2024, 8, 8)))  # rows that move to another month
    steps = [source_rows(spark, 3000, date=later), source_rows(spark, 3100, quantity=F.when(F.col("id") % 3 == 0, 5).otherwise(1), date=later),
             source_rows(spark, 3000, quantity=F.when(F.col("id") % 3 == 0, 5).otherwise(1), but=F.col("id") % 2 == 0)]
    plain, last_key = house.snapshot().frame(FACT_TABLE), 3000
    for source in steps:
        base, draft, changed = merge(house, source, last_key)
        whole = facts.merge_fact(plain, source, YEAR, LATER, last_key)
        plain, last_key = record(whole.rows, "plain"), changed.last_key
        house.publish(draft, base)
        now = house.snapshot()
        assert sorted(r[1:] for r in shown(now.frame(FACT_TABLE))) == sorted(r[1:] for r in shown(plain))  # keys follow no order
        assert now.frame(FACT_TABLE).select("FactOrder_SK").distinct().count() == now.rows(FACT_TABLE) == plain.count()
    before = shown(house.snapshot().frame(FACT_TABLE))
    assert house.fold(FACT_TABLE) == ["2024-01", "2024-02", "2024-03", "2024-08"]
    after = house.snapshot()
    assert shown(after.frame(FACT_TABLE)) == before
    assert not after.gone
    assert after.rows(FACT_TABLE) == len(before)
    assert house.fold(FACT_TABLE) == []
    assert house.vacuum(keep=1, older_than_hours=-1)
    assert shown(house.snapshot().frame(FACT_TABLE)) == before


def test_nothing_to_change_writes_nothing(spark, house):
    base, draft, changed = merge(house, source_rows(spark, 3000))
    assert not any(draft.written_since(base, FACT_TABLE).values())
    assert not draft.gone
    assert changed.inserted == 0
    assert draft.rows(FACT_TABLE) == 3000


def test_a_month_of_which_all_rows_have_gone_is_left_out(spark, house):
    """The month's files stay in folders that other months use too; their rows no longer count."""
    february = (F.col("id") % 90 >= 31) & (F.col("id") % 90 < 60)
    base, draft, _ = merge(house, source_rows(spark, 3000, but=february))
    left = 3000 - base.frame(FACT_TABLE, ["2024-02"]).count()
    assert base.months(FACT_TABLE) == ["2024-01", "2024-02", "2024-03"]
    assert draft.months(FACT_TABLE) == ["2024-01", "2024-03"]
    assert draft.rows(FACT_TABLE) == draft.frame(FACT_TABLE).count() == left
    house.publish(draft, base)
    again = house.write(house.snapshot(), [Change(FACT_TABLE, house.snapshot().frame(FACT_TABLE, []), append=True, gone=house.snapshot().placed(FACT_TABLE))], {})
    assert again.months(FACT_TABLE) == []
    assert again.rows(FACT_TABLE) == again.frame(FACT_TABLE).count() == 0


def test_places_are_cut_from_the_path_without_a_search(house):
    files = house.snapshot().placed(FACT_TABLE).select("_file")
    # A pattern that is only anchored at its end is tried from every character of a path, for every row.
    assert "regexp" not in files._jdf.queryExecution().optimizedPlan().toString().lower()
    found = {r["_file"] for r in files.distinct().collect()}
    (folder,) = {path.split("/order_month=")[0] for paths in house.snapshot().tables[FACT_TABLE].values() for path in paths}
    assert {tuple(f.split("/")[:2]) for f in found} == {
        (folder.split("/")[-1], f"order_month={m}") for m in house.snapshot().months(FACT_TABLE)}
    assert all(f.count("/") == 2 and f.endswith(".parquet") for f in found)
