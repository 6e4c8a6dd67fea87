"""Fact load for a date window and its rejects.

Duplicates are removed on each side before orders meet their lines: the newest pair of a
(order, product) group is the newest order of the window with the newest line, so nothing is
multiplied first. Order-level keys are resolved at order size, product keys at line size.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions import reasons
from dimweave.functions.changes import any_differs, with_collation, zero_if_null
from dimweave.operators.joins import (
    fits_broadcast, hot_frame, hot_keys, key_set, lookup_join, newest_per_key, pair_join,
)
from dimweave.operators.keys import number_in_any_order, number_in_order
from dimweave.sources.colocated import Apart, both, whole
from dimweave.sources.schemas import (
    FACT, FACT_COMPARED, FACT_GRAIN, FACT_SOURCE, LINE_KEYS, LINES_ROW, LINES_SOURCE, MONEY, ORDER_KEYS,
    ORDERS_ROW, ORDERS_SOURCE, POLICIES, RATE, REJECT, REJECT_SOURCE, ROW_ID, STAGING, FactKey, source_key,
)
from dimweave.sources.statistics import count_of, record, record_split

_FKS = [k.fk for k in (*ORDER_KEYS, *LINE_KEYS)]

PLACE = ["_file", "_row"]  # of a stored row: its file below the warehouse's folder of the table, and its index there


@dataclass(frozen=True)
class Window:
    """Order dates of one load, both ends included."""

    start: datetime.date
    end: datetime.date

    def __post_init__(self):
        for value in (self.start, self.end):
            if not isinstance(value, datetime.date):
                raise ValueError(f"window ends must be dates, got {value!r}")
        if self.start > self.end:
            raise ValueError("start date cannot be after end date")

    @classmethod
    def parse(cls, start: str, end: str) -> Window:
        return cls(datetime.date.fromisoformat(start), datetime.date.fromisoformat(end))

    def contains(self, column: str = "OrderDate") -> Column:
        return F.col(column).between(F.lit(self.start), F.lit(self.end))


@dataclass
class FactLoaded:
    """New rows of a fact table, and the places of stored rows that go (None: the rows replace all stored ones)."""

    rows: DataFrame
    last_key: int
    inserted: int
    gone: DataFrame | None = None


def orders_in_window(orders: DataFrame | Apart, window: Window) -> DataFrame | Apart:
    return both(orders, lambda rows: rows.where(window.contains()))


def dimension_keys(dims: dict[str, DataFrame], key: FactKey) -> DataFrame:
    """Natural key to surrogate key of a dimension's current rows, named for the join."""
    policy = POLICIES[key.dimension]
    rows = dims[key.dimension]
    if policy.method == "versions":
        rows = rows.where("IsCurrent")
    return rows.select(F.col(policy.nk).alias(key.column), F.col(policy.surrogate).alias(key.fk))


def resolve(rows: DataFrame, keys: tuple[FactKey, ...], dims: dict[str, DataFrame], how: str,
            spread_by: str = ROW_ID, sample_from: DataFrame | None = None, collation: str | None = None) -> DataFrame:
    """Add the surrogate key of each dimension; unresolved rows drop with ``how="inner"``.

    Hot natural keys are looked for in ``sample_from``, by default the rows before any lookup.
    """
    given = rows if sample_from is None else sample_from
    for key in keys:
        compared = with_collation(F.col(key.column), rows.schema[key.column].dataType, collation)
        lookup = dimension_keys(dims, key).select(compared.alias("_nk"), key.fk)
        keyed = rows.withColumn("_nk", compared)
        sample = given.select(compared.alias("_nk"))
        rows = lookup_join(keyed, lookup, "_nk", how, spread_by, sample_from=sample).drop("_nk")
    return rows


def newest_orders(orders: DataFrame | Apart) -> DataFrame | Apart:
    return both(orders, lambda rows: newest_per_key(rows.where(F.col("OrderID").isNotNull()), ["OrderID"], [F.col(ROW_ID).desc()]))


def sales_amount() -> Column:
    """Unit price times quantity less discount, NULL parts as zero."""
    quantity = zero_if_null("Quantity", STAGING["OrderDetails"]["Quantity"].dataType)
    return (zero_if_null("UnitPrice", MONEY) * quantity * (1 - zero_if_null("Discount", RATE))).cast(MONEY)


def _named_lines(lines: DataFrame | Apart) -> DataFrame | Apart:
    return both(lines, lambda rows: rows.withColumnRenamed(ROW_ID, LINES_ROW))


def _named_orders(orders: DataFrame | Apart) -> DataFrame | Apart:
    return both(orders, lambda rows: rows.withColumnRenamed(ROW_ID, ORDERS_ROW))


def order_lines(orders: DataFrame | Apart, lines: DataFrame | Apart) -> DataFrame:
    """Orders with their lines; both sides may repeat an order."""
    return pair_join(_named_lines(lines), _named_orders(orders), "OrderID", LINES_ROW, ORDERS_ROW)


def newest_order_lines(orders: DataFrame | Apart, lines: DataFrame | Apart) -> DataFrame:
    """The newest row of every (order, product), by order row then line row.

    Usual rows that are laid out by order are joined and deduplicated as they lie. Otherwise:

    ``orders`` has one row per OrderID, so the newest line of a pair decides. A small side of
    orders is broadcast and only the remaining lines are shuffled. Otherwise orders and lines
    are shuffled once by order, which also serves the deduplication; orders that own a large
    share of the lines are few, so they are broadcast and their lines spread over products.
    """
    if isinstance(orders, Apart) and isinstance(lines, Apart):
        usual = _newest_laid_out(orders.usual, lines.usual)
        if orders.has_no_hot_rows() and lines.has_no_hot_rows():
            return usual
        # An order that is hot in one of the tables is none of the rows above: all its rows meet here.
        hot = sorted({*orders.hot_keys(), *lines.hot_keys()})
        met = [table.usual.where(F.col("OrderID").isin(hot)).unionByName(table.hot) for table in (orders, lines)]
        return usual.unionByName(newest_order_lines(*met))
    orders, lines = whole(orders), whole(lines)
    orders = _named_orders(orders)
    keyed = _named_lines(lines.where(F.col("OrderID").isNotNull() & F.col("ProductID").isNotNull()))

    def newest(joined):
        return newest_per_key(joined, ["OrderID", "ProductID"], [F.col(LINES_ROW).desc()])

    if fits_broadcast(orders):
        return newest(keyed.join(F.broadcast(orders), "OrderID"))
    hot = hot_keys(keyed, "OrderID")
    if not hot:
        return newest(keyed.join(orders, "OrderID"))
    heavy = hot_frame(orders, "OrderID", hot).drop("_parts")
    heavy_orders = F.broadcast(orders.join(heavy, "OrderID", "left_semi"))  # one row per hot key
    usual_lines = keyed.join(heavy, "OrderID", "left_anti")
    return newest(usual_lines.join(orders, "OrderID")).unionByName(newest(keyed.join(heavy_orders, "OrderID")))


def _newest_laid_out(orders: DataFrame, lines: DataFrame) -> DataFrame:
    keyed = _named_lines(lines.where(F.col("OrderID").isNotNull() & F.col("ProductID").isNotNull()))
    joined = keyed.join(_named_orders(orders), "OrderID")
    return newest_per_key(joined, ["OrderID", "ProductID"], [F.col(LINES_ROW).desc()])


def fact_source(orders: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], window: Window,
                collation: str | None = None) -> DataFrame:
    """Valid, deduplicated fact rows of the window."""
    windowed = orders_in_window(orders, window)
    valid_orders = both(newest_orders(windowed), lambda rows: resolve(
        rows, ORDER_KEYS, dims, "inner", sample_from=whole(windowed), collation=collation))
    if not isinstance(valid_orders, Apart):
        valid_orders = record(valid_orders, "fact-orders")
    joined = newest_order_lines(valid_orders, lines)
    joined = resolve(joined, LINE_KEYS, dims, "inner", LINES_ROW, sample_from=whole(lines))
    values = {
        "OrderID_NK": F.col("OrderID"), "ProductID_NK": F.col("ProductID"), "SalesAmount": sales_amount(),
        ORDERS_SOURCE: F.lit(source_key("Orders")), LINES_SOURCE: F.lit(source_key("OrderDetails")),
    }
    return joined.select(*[values.get(f.name, F.col(f.name)).alias(f.name) for f in FACT_SOURCE.fields])


def months_to_merge(stored: DataFrame, source: DataFrame, window: Window) -> list[str]:
    """Months of stored rows outside the window that hold a key of ``source``; at most one per month."""
    outside = stored.where(~F.coalesce(window.contains(), F.lit(False)))
    grain = F.struct(*FACT_GRAIN).alias("_key")
    wanted = source.select(grain)
    stored_keys = outside.select(grain, month_of("OrderDate").alias("_month"))
    if fits_broadcast(source.select(*FACT_GRAIN)):
        wanted = F.broadcast(wanted)
    found = stored_keys.join(wanted, "_key", "left_semi").select("_month").distinct()
    return sorted(r["_month"] for r in found.collect())


def month_of(column: str) -> Column:
    """Partition value of a date: its month, or "none"."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))


def merge_fact(stored: DataFrame | None, source: DataFrame, window: Window, load_ts: datetime.datetime,
               last_key: int, collation: str | None = None) -> FactLoaded:
    """Insert, update and delete so that ``stored`` matches ``source`` in the window.

    ``stored`` must hold every stored row of the window and every row with a key of ``source``,
    or be None where there are none; ``source`` must be a written table, see ``materialize``.
    Rows of the window without a source row are deleted, by their stored date.
    """
    stamps = [F.lit(load_ts.date()).alias("SnapshotDate"), _second(load_ts).alias("LoadDate")]
    if stored is None:
        added = number_in_any_order(source, "FactOrder_SK", last_key).select("*", *stamps)
        count = count_of(source)
        return FactLoaded(_typed(added, FACT), last_key + count, count)

    labelled = _labelled(stored, source, window, collation).where("_action != 'delete'")
    rows = record_split(labelled, "merge-fact", "_action", ("insert", "update", "keep"))
    numbered = number_in_any_order(rows["insert"].select("new"), "FactOrder_SK", last_key)
    inserted = numbered.select("FactOrder_SK", "new.*", *stamps)
    updated = rows["update"].select("old.FactOrder_SK", "new.*", *stamps)
    merged = rows["keep"].select("old.*").unionByName(updated).unionByName(inserted)
    count = count_of(rows["insert"])
    return FactLoaded(_typed(merged, FACT), last_key + count, count)


def _labelled(stored: DataFrame, source: DataFrame, window: Window, collation: str | None) -> DataFrame:
    """Stored and new rows of each fact key side by side, with what happens to them."""
    def keyed(df, name):
        return df.select(*FACT_GRAIN, F.struct("*").alias(name))

    paired = keyed(stored, "old").join(keyed(source, "new"), FACT_GRAIN, "full_outer")
    action = (F.when(F.col("old").isNull(), "insert")
              .when(F.col("new").isNull() & window.contains("old.OrderDate"), "delete")
              .when(F.col("new").isNull(), "keep")
              .when(any_differs("old", "new", FACT_COMPARED.fields, collation), "update").otherwise("keep"))
    return paired.select("old", "new", action.alias("_action"))


def fact_changes(placed: DataFrame, source: DataFrame, window: Window, load_ts: datetime.datetime, last_key: int,
                 collation: str | None = None) -> FactLoaded:
    """``merge_fact`` by its changes: new and updated rows, and the places of the stored rows that they replace or that are deleted.

    ``placed`` has the stored rows with ``PLACE`` columns. Rows that stay as they are are read and compared, never written.
    """
    labelled = _labelled(placed, source, window, collation).where("_action != 'keep'")
    slim = F.struct("old.FactOrder_SK", "old.OrderDate", *[f"old.{c}" for c in PLACE])
    rows = record_split(labelled.select(F.when(F.col("old").isNotNull(), slim).alias("old"), "new", "_action"), "merge-fact", "_action",
                        ("insert", "update", "delete"))
    stamps = [F.lit(load_ts.date()).alias("SnapshotDate"), _second(load_ts).alias("LoadDate")]
    numbered = number_in_any_order(rows["insert"].select("new"), "FactOrder_SK", last_key)
    added = numbered.select("FactOrder_SK", "new.*", *stamps).unionByName(rows["update"].select("old.FactOrder_SK", "new.*", *stamps))
    gone = rows["update"].select("old.OrderDate", *[f"old.{c}" for c in PLACE]).unionByName(rows["delete"].select("old.OrderDate", *[f"old.{c}" for c in PLACE]))
    count = count_of(rows["insert"])
    return FactLoaded(_typed(added, FACT), last_key + count, count, gone)


def employees_gone(placed: DataFrame, removed_keys: DataFrame) -> DataFrame:
    """Places of the fact rows of removed employees, whatever their date."""
    gone = removed_keys.toDF("EmployeeID_SK_FK")
    return lookup_join(placed, gone, "EmployeeID_SK_FK", "left_semi", "FactOrder_SK").select("OrderDate", *PLACE)


def _second(ts: datetime.datetime) -> Column:
    """A time stamp as written, in whole seconds, whatever the time zones of Python and the session."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# Rejects

_ORDER_COLUMNS = ["OrderID", *[k.column for k in ORDER_KEYS], "OrderDate", "RequiredDate", "ShippedDate", "Freight"]
_LINE_COLUMNS = ["OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"]


def _without_match(rows: Apart, others: Apart) -> DataFrame:
    """Rows of one table whose order is in no row of the other. Few keys are hot, so those are looked up by name."""
    found = rows.usual.join(others.usual.select("OrderID").distinct(), "OrderID", "left_anti")
    elsewhere = others.hot_keys()
    if elsewhere:
        found = found.where(~F.col("OrderID").isin(elsewhere))
    if rows.has_no_hot_rows():
        return found
    hot = rows.hot_keys()
    met = others.usual.where(F.col("OrderID").isin(hot)).select("OrderID").distinct().collect() if hot else []
    present = sorted({r[0] for r in met} | set(elsewhere))
    lost = rows.hot.where(F.col("OrderID").isNull() | ~F.col("OrderID").isin(present)) if present else rows.hot
    return found.unionByName(lost)


def unmatched_orders(orders: DataFrame | Apart, lines: DataFrame | Apart) -> DataFrame:
    """Orders without a line, those with a NULL order id included."""
    if isinstance(orders, Apart) and isinstance(lines, Apart):
        return _without_match(orders, lines).select(*orders.usual.columns)
    orders, lines = whole(orders), whole(lines)
    wanted, few_orders = key_set(orders, "OrderID")
    present, few_lines = key_set(lines, "OrderID")
    if few_orders:
        present = lines.select("OrderID").join(F.broadcast(wanted), "OrderID", "left_semi").distinct()
    return lookup_join(orders, present, "OrderID", "left_anti", ROW_ID, small=few_orders or few_lines)


def orders_left_lines(orders: DataFrame | Apart, lines: DataFrame | Apart) -> DataFrame:
    """Orders with their lines, orders without a line kept; the two are joined apart so that a
    heavily repeated order id on either side can be spread."""
    lonely = unmatched_orders(orders, lines).withColumnRenamed(ROW_ID, ORDERS_ROW)
    return order_lines(orders, lines).unionByName(lonely, allowMissingColumns=True)


def orphan_lines(lines: DataFrame | Apart, orders: DataFrame | Apart) -> DataFrame:
    """Lines whose order id is NULL or in no order of any date."""
    if isinstance(orders, Apart) and isinstance(lines, Apart):
        return _without_match(lines, orders).select(*lines.usual.columns)
    orders, lines = whole(orders), whole(lines)
    known, few_orders = key_set(orders, "OrderID")
    if few_orders:
        return lines.join(F.broadcast(known), "OrderID", "left_anti").select(*lines.columns)
    line_keys, _ = key_set(lines, "OrderID")
    unknown = record(line_keys.join(known, "OrderID", "left_anti"), "orphans")
    lost = lookup_join(lines, unknown, "OrderID", "left_semi", ROW_ID)
    return lost.unionByName(lines.where(F.col("OrderID").isNull())).select(*lines.columns)


def _unresolved(keys: tuple[FactKey, ...]) -> Column:
    return reduce(or_, [F.col(k.fk).isNull() for k in keys])


def reject_candidates(orders: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], window: Window,
                      collation: str | None = None) -> DataFrame:
    """Rejected rows before their reason is written: natural keys, surrogate keys, measures.

    Pairs of a sound order and a sound line are never formed. The rest is the union of
    unsound orders with their lines, sound orders with unsound lines, orders without a line,
    and lines without an order.
    """
    windowed = both(orders_in_window(orders, window), lambda rows: rows.select(ROW_ID, *_ORDER_COLUMNS))
    if isinstance(windowed, Apart) and isinstance(lines, Apart):
        return _candidates_laid_out(windowed, orders, lines, dims, collation)
    windowed, lines = whole(windowed), whole(lines)
    flagged = resolve(windowed, ORDER_KEYS, dims, "left", collation=collation)
    flagged = flagged.withColumn("_bad", _unresolved(ORDER_KEYS))
    orders_apart = record_split(flagged, "reject-orders", "_bad", (True, False), keys=("OrderID",))
    resolved = resolve(lines.select(ROW_ID, *_LINE_COLUMNS), LINE_KEYS, dims, "left")
    # Written once: the lines meet the products in one shuffle, whatever is asked of them afterwards.
    lines_apart = record_split(resolved.withColumn("_bad", _unresolved(LINE_KEYS)), "reject-lines", "_bad", (True, False), keys=("OrderID",))
    bad, sound, bad_lines = orders_apart[True], orders_apart[False], lines_apart[True]
    resolved = bad_lines.unionByName(lines_apart[False])

    pairs = order_lines(bad, resolved).unionByName(order_lines(sound, bad_lines))
    lonely = unmatched_orders(bad.unionByName(sound), lines).withColumnRenamed(ROW_ID, ORDERS_ROW)
    orphans = orphan_lines(resolved, orders)
    orphans = _named_lines(orphans).withColumn("_orphan", F.lit(True))
    return (pairs.unionByName(lonely, allowMissingColumns=True)
            .unionByName(orphans, allowMissingColumns=True))


def _candidates_laid_out(windowed: Apart, orders: Apart, lines: Apart, dims: dict[str, DataFrame], collation: str | None) -> DataFrame:
    """``reject_candidates`` of tables that are laid out by order: only unsound lines are written once more.

    Keys are resolved for the rows that are found, which are few, and lines meet orders where they lie.
    """
    lines = lines.map(lambda rows: rows.select(ROW_ID, *_LINE_COLUMNS))
    flagged = resolve(windowed.whole(), ORDER_KEYS, dims, "left", collation=collation)
    apart = record_split(flagged.withColumn("_bad", _unresolved(ORDER_KEYS)), "reject-orders", "_bad", (True, False), keys=("OrderID",))
    resolved = resolve(lines.whole(), LINE_KEYS, dims, "left")
    bad_lines = record(resolved.where(_unresolved(LINE_KEYS)), "reject-lines", keys=("OrderID",))
    pairs = resolve(order_lines(apart[True], lines), LINE_KEYS, dims, "left", LINES_ROW)
    pairs = pairs.unionByName(order_lines(apart[False], bad_lines))
    lonely = resolve(unmatched_orders(windowed, lines), ORDER_KEYS, dims, "left", collation=collation)
    orphans = resolve(orphan_lines(lines, orders), LINE_KEYS, dims, "left")
    orphans = _named_lines(orphans).withColumn("_orphan", F.lit(True))
    return (pairs.unionByName(_named_orders(lonely), allowMissingColumns=True)
            .unionByName(orphans, allowMissingColumns=True))


def _natural_names() -> dict[str, str]:
    return {"OrderID_NK": "OrderID", **{k.nk: k.column for k in (*ORDER_KEYS, *LINE_KEYS)}}


def error_reason() -> Column:
    """Reason text over natural keys, surrogate keys, ``LINES_ROW`` and ``_orphan``."""
    has_line = F.col(LINES_ROW).isNotNull()
    product = F.when(has_line, reasons.unresolved("ProductID_NK", "ProductID_TABLE_SK_FK",
                                                  reasons.NO_PRODUCT, reasons.BAD_PRODUCT))
    by_order = reasons.join_reasons(
        F.when(F.col("OrderID_NK").isNull(), reasons.NO_ORDER_ID),
        F.when(~has_line, reasons.NO_LINE), product,
        *[reasons.unresolved(k.nk, k.fk, *reasons.ORDER_KEY_TEXTS[k.nk]) for k in ORDER_KEYS])
    by_line = reasons.join_reasons(
        F.when(F.col("OrderID_NK").isNull(), reasons.LINE_WITHOUT_ORDER_ID).otherwise(reasons.LINE_WITHOUT_ORDER),
        product)
    return F.when(F.col("_orphan"), by_line).otherwise(by_order)


def reject_filter() -> Column:
    """Any of the natural keys, the line or a surrogate key is missing."""
    needed = ["OrderID_NK", LINES_ROW, "ProductID_NK", *_FKS]
    return reduce(or_, [F.col(c).isNull() for c in needed])


def reject_source(orders: DataFrame, lines: DataFrame, dims: dict[str, DataFrame], window: Window,
                  collation: str | None = None) -> DataFrame:
    """Rejected rows of the window plus all orphan lines, with reasons."""
    found = reject_candidates(orders, lines, dims, window, collation)
    for nk, column in _natural_names().items():
        found = found.withColumnRenamed(column, nk)
    values = {ORDERS_SOURCE: F.lit(source_key("Orders")), LINES_SOURCE: F.lit(source_key("OrderDetails")),
              "ErrorReason": error_reason()}
    found = found.where(reject_filter())
    return found.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                          for f in REJECT_SOURCE.fields])


def refresh_rejects(stored: DataFrame, rejected: DataFrame, window: Window, load_ts: datetime.datetime,
                    last_key: int) -> FactLoaded:
    """Replace earlier rejects of the window, and all without an order date, by today's.

    Only rows of the same pair of sources are replaced.
    """
    same_sources = ((F.col(ORDERS_SOURCE) == source_key("Orders"))
                    & (F.col(LINES_SOURCE) == source_key("OrderDetails")))
    outdated = (window.contains() | F.col("OrderDate").isNull()) & same_sources
    kept = stored.where(~F.coalesce(outdated, F.lit(False)))
    written = record(rejected, "rejected")
    numbered = number_in_order(written, "FactOrder_Error_SK", last_key, [ORDERS_ROW, LINES_ROW])
    added = numbered.withColumn("RejectedDate", _second(load_ts))
    count = count_of(written)
    return FactLoaded(_typed(kept.unionByName(_typed(added, REJECT)), REJECT), last_key + count, count)
