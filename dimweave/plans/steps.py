"""Load steps: what each step reads from a snapshot and which tables it changes."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import functions as F

from dimweave.operators import facts
from dimweave.operators.dimensions import LOADERS, clear_reference, load_versions, prepare_source
from dimweave.sources.schemas import (
    FACT_TABLE, ORDER_KEYS, LINE_KEYS, POLICIES, REJECT_TABLE, DimensionPolicy,
)
from dimweave.sources.statistics import count_of, record
from dimweave.sources.warehouse import CLOSED, CURRENT, Change, Snapshot


@dataclass
class StepResult:
    changes: list[Change]
    last_keys: dict[str, int]
    rows: int | None = None  # None: all that was written


def dimension_step(tables: Snapshot, policy: DimensionPolicy, as_of: datetime.date,
                   collation: str | None = None) -> StepResult:
    """Load one dimension and, for removed rows, clear or delete what refers to them."""
    dims = {r.dimension: tables.frame(r.dimension) for r in policy.references}
    source = prepare_source(tables.frame(policy.source), policy, dims)
    if policy.method == "versions":
        loaded = load_versions(tables.frame(policy.target, [CURRENT]), tables.frame(policy.target, [CLOSED]), source,
                               policy, tables.last_keys, as_of, collation)
        changes = [Change(policy.target, loaded.current, part=CURRENT),
                   Change(policy.target, loaded.closed, append=True, part=CLOSED)]
    else:
        load = LOADERS[policy.method]
        loaded = load(tables.frame(policy.target), source, policy, tables.last_keys, as_of, collation)
        changes = [Change(policy.target, loaded.current)]
    if policy.history:
        changes.append(Change(policy.history, loaded.history, append=True))
    if loaded.removed is not None:
        gone = loaded.removed.select(policy.surrogate)
        changes += _follow_removal(tables, policy, gone)
    return StepResult(changes, loaded.last_keys, loaded.inserted)


def _follow_removal(tables: Snapshot, policy: DimensionPolicy, gone) -> list[Change]:
    if gone.isEmpty():
        return []
    changes = []
    for other in POLICIES.values():
        for ref in other.references:
            if ref.dimension != policy.target:
                continue
            for part in tables.tables.get(other.target, {}):
                cleared = clear_reference(tables.frame(other.target, [part]), other, ref.fk, gone)
                changes.append(Change(other.target, cleared, part=part))
    if policy.target == "DimEmployees" and tables.months(FACT_TABLE):
        places = record(facts.employees_gone(tables.placed(FACT_TABLE).select("EmployeeID_SK_FK", "OrderDate", "FactOrder_SK", *facts.PLACE), gone), "employees-gone")
        if count_of(places):
            changes.append(Change(FACT_TABLE, tables.frame(FACT_TABLE, []), append=True, gone=places))
    return changes


def fact_dimensions(tables: Snapshot) -> dict:
    """Current rows of the dimensions the fact refers to."""
    versions = {p.target for p in POLICIES.values() if p.method == "versions"}
    return {k.dimension: tables.frame(k.dimension, [CURRENT] if k.dimension in versions else None)
            for k in (*ORDER_KEYS, *LINE_KEYS)}


def _window_months(tables: Snapshot, table: str, window: facts.Window) -> list[str]:
    first, last = window.start.strftime("%Y-%m"), window.end.strftime("%Y-%m")
    return [m for m in tables.months(table) if first <= m <= last]


def fact_step(tables: Snapshot, window: facts.Window, load_ts: datetime.datetime,
              collation: str | None = None) -> StepResult:
    """Merge the window into the fact; only months with rows to change are read in full, and only changed rows are written."""
    source = facts.fact_source(tables.apart("Orders"), tables.apart("OrderDetails"), fact_dimensions(tables), window,
                               collation)
    source = record(source, "fact-source")
    touched = _window_months(tables, FACT_TABLE, window)
    others = [m for m in tables.months(FACT_TABLE) if m not in touched]
    if others:
        touched += facts.months_to_merge(tables.frame(FACT_TABLE, others), source, window)
    last_key = tables.last_keys.get("FactOrder_SK", 0)
    if touched:
        merged = facts.fact_changes(tables.placed(FACT_TABLE, touched), source, window, load_ts, last_key, collation)
    else:
        merged = facts.merge_fact(None, source, window, load_ts, last_key, collation)
    return StepResult([Change(FACT_TABLE, merged.rows, append=True, gone=merged.gone)], {"FactOrder_SK": merged.last_key},
                      merged.inserted)


def reject_step(tables: Snapshot, window: facts.Window, load_ts: datetime.datetime,
                collation: str | None = None) -> StepResult:
    """Refresh the rejects of the window and those without an order date."""
    rejected = facts.reject_source(tables.apart("Orders"), tables.apart("OrderDetails"), fact_dimensions(tables),
                                   window, collation)
    touched = _window_months(tables, REJECT_TABLE, window) + ["none"]
    last_key = tables.last_keys.get("FactOrder_Error_SK", 0)
    fresh = facts.refresh_rejects(tables.frame(REJECT_TABLE, touched), rejected, window, load_ts, last_key)
    return StepResult([Change(REJECT_TABLE, fresh.rows, months=touched)],
                      {"FactOrder_Error_SK": fresh.last_key}, fresh.inserted)
