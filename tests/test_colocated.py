"""Orders and lines laid out by order: joins without an exchange, hot and NULL orders apart."""

import pytest
from pyspark.sql import functions as F

from dimweave.operators import facts
from dimweave.plans import registry
from dimweave.plans.samples import WINDOWS
from dimweave.sources import colocated
from dimweave.sources.colocated import Apart
from dimweave.sources.warehouse import HOT, USUAL, Change, Warehouse


@pytest.fixture(scope="module")
def loads(spark, sf_dir):
    return registry.samples(spark, sf_dir)


@pytest.fixture
def no_broadcast(spark, shuffled):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def hot_tables(spark, loads, monkeypatch, tmp_path):
    """A third of the lines in one order, a tenth of the orders in another, both with NULLs: frames and laid-out tables."""
    orders, lines = loads.staged(1, "Orders"), loads.staged(1, "OrderDetails")
    first, last = orders.where(WINDOWS[1].contains()).agg(F.min("OrderID"), F.max("OrderID")).first()
    row = F.col("staging_raw_id_sk")
    lines = lines.withColumn("OrderID", F.when(row % 3 == 0, F.lit(first)).when(row % 50 == 1, F.lit(last)).otherwise(F.col("OrderID")))
    lines = lines.withColumn("OrderID", F.when(row % 40 == 7, F.lit(10**9)).otherwise(F.col("OrderID")))  # hot, and in no order
    orders = orders.withColumn("OrderID", F.when(row % 10 == 3, F.lit(last)).when(row % 20 != 5, F.col("OrderID")))
    monkeypatch.setattr(colocated, "HOT_ROWS", 60)
    warehouse = Warehouse(spark, str(tmp_path))
    draft = warehouse.write(warehouse.snapshot(), [Change("Orders", orders), Change("OrderDetails", lines)], {})
    assert set(draft.tables["Orders"]) == set(draft.tables["OrderDetails"]) == {USUAL, HOT}
    assert rows(draft.frame("OrderDetails")) == rows(lines.select(*draft.frame("OrderDetails").columns))
    laid = draft.apart("Orders"), draft.apart("OrderDetails")
    assert laid[0].hot_keys() == [last]
    assert set(laid[1].hot_keys()) == {first, last, 10**9}
    return (orders, lines), laid


def test_the_four_queries_have_no_exchange_by_order(spark, loads, no_broadcast):
    orders = loads.apart(1, "Orders").usual.where(WINDOWS[1].contains())
    lines = loads.apart(1, "OrderDetails").usual
    orders, lines = Apart("OrderID", orders, orders.where("false")), Apart("OrderID", lines, lines.where("false"))
    for df in (facts.order_lines(orders, lines), facts.newest_order_lines(facts.newest_orders(orders), lines), facts.orphan_lines(lines, orders),
               facts.unmatched_orders(orders, lines), facts.orders_left_lines(orders, lines)):
        text = plan(df)
        assert "Bucketed: true" in text
        assert "Exchange" not in text, text


def test_no_usual_row_is_shuffled_where_some_are_hot(hot_tables, no_broadcast):
    """What is shuffled is filtered by name to the hot orders first."""
    _, (orders, lines) = hot_tables
    for part in plan(facts.unmatched_orders(orders, lines)).split("Exchange")[1:]:
        assert "Bucketed: true" not in part.split("Filter")[0]


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_orders_give_the_same_rows(hot_tables, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    (orders, lines), (laid_orders, laid_lines) = hot_tables
    windowed, laid_window = (facts.orders_in_window(t, WINDOWS[1]) for t in (orders, laid_orders))
    assert rows(facts.order_lines(laid_window, laid_lines)) == rows(facts.order_lines(windowed, lines))
    assert rows(facts.orders_left_lines(laid_window, laid_lines)) == rows(facts.orders_left_lines(windowed, lines))
    assert rows(facts.orphan_lines(laid_lines, laid_orders)) == rows(facts.orphan_lines(lines, orders))
    assert rows(facts.unmatched_orders(laid_window, laid_lines)) == rows(facts.unmatched_orders(windowed, lines))
    newest = facts.newest_order_lines(facts.newest_orders(laid_window), laid_lines)
    assert rows(newest) == rows(facts.newest_order_lines(facts.newest_orders(windowed), lines))


def test_fact_and_rejects_of_hot_orders(hot_tables, loads):
    (orders, lines), laid = hot_tables
    dims = registry.fact_dimensions(loads.before(1, "FactOrders"))
    for source in (facts.fact_source, facts.reject_source):
        assert rows(source(*laid, dims, WINDOWS[1])) == rows(source(orders, lines, dims, WINDOWS[1]))


def test_tables_without_hot_keys_have_one_part(spark, table, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    orders = table("Orders", [{"staging_raw_id_sk": i, "OrderID": i} for i in range(20)])
    draft = warehouse.write(warehouse.snapshot(), [Change("Orders", orders)], {})
    warehouse.publish(draft)
    laid = warehouse.snapshot().apart("Orders")
    assert laid.has_no_hot_rows()
    assert laid.usual.count() == warehouse.snapshot().frame("Orders").count() == 20
    assert not isinstance(warehouse.snapshot().apart("OrderDetails"), Apart)
    empty = warehouse.write(warehouse.snapshot(), [Change("Orders", orders.where("false"))], {}).apart("Orders")
    assert empty.usual.count() == 0
