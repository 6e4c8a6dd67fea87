"""What a database's constraints would refuse, checked on a draft before it is published.

Only what a step wrote is checked, against the tables as they will be: NULLs were counted by the job that wrote the rows;
keys must be unique in the parts that were rewritten (a fact key lies in a rewritten month or in none); foreign keys of
new rows must have their row; and where rows of a dimension have gone, nothing may refer to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.operators.checks import repeated_keys
from dimweave.operators.joins import key_set, lookup_join
from dimweave.sources.schemas import FACT_TABLE, LINE_KEYS, ORDER_KEYS, POLICIES, REQUIRED, UNIQUE
from dimweave.sources.warehouse import CURRENT, Snapshot, folder_of

#: Foreign keys of every table: column, table and key that it refers to.
REFERENCES: dict[str, list[tuple[str, str, str]]] = {
    FACT_TABLE: [(k.fk, k.dimension, POLICIES[k.dimension].surrogate) for k in (*ORDER_KEYS, *LINE_KEYS)],
    **{p.target: [(r.fk, r.dimension, POLICIES[r.dimension].surrogate) for r in p.references] for p in POLICIES.values() if p.references},
}


class IntegrityError(ValueError):
    """A draft that must not be published."""


def problems(draft: Snapshot, base: Snapshot, tables: list[str]) -> list[str]:
    """What is wrong with the changed tables of a draft; nothing if it may be published."""
    found = []
    for table in dict.fromkeys(tables):
        written = draft.written_since(base, table)
        if any(written.values()):
            found += _nulls(draft, table, written) + _repeated(draft, table, written) + _orphans(draft, table, written)
        found += _left_behind(draft, base, table)
    return found


def _nulls(draft: Snapshot, table: str, written: dict[str, list[str]]) -> list[str]:
    folders = {folder_of(path) for paths in written.values() for path in paths}
    counts = {c: sum(draft.stats[f].counts.get(f"null {c}", 0) for f in folders) for c in REQUIRED.get(table, [])}
    return [f"{table}.{c}: {n} NULLs" for c, n in counts.items() if n]


def _repeated(draft: Snapshot, table: str, written: dict[str, list[str]]) -> list[str]:
    parts = [CURRENT] if CURRENT in written else [p for p, paths in written.items() if paths]
    if not any(written[p] for p in parts):
        return []
    rows, found = draft.frame(table, parts), []
    for keys in UNIQUE.get(table, []):
        first = repeated_keys(rows.select(*keys), list(keys)).first()
        if first is not None:
            found.append(f"{table}: {dict(zip(keys, first, strict=False))} in {first['n_rows']} rows")
    return found


def _orphans(draft: Snapshot, table: str, written: dict[str, list[str]]) -> list[str]:
    found = []
    rows = draft.read(table, [path for paths in written.values() for path in paths])
    for fk, target, key in REFERENCES.get(table, []):
        used = rows.select(fk).where(F.col(fk).isNotNull()).distinct()
        for part in sorted(draft.tables.get(target, {}), key=lambda p: p != CURRENT):  # most refer to current rows
            used = _missing(used, draft.frame(target, [part]).select(F.col(key).alias(fk)), fk)
        first = used.first()
        if first is not None:
            found.append(f"{table}.{fk}: no row {first[0]} in {target}")
    return found


def _missing(used: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The keys of ``used`` that ``known`` does not have."""
    keys, small = key_set(known, key)
    return lookup_join(used, keys, key, "left_anti", key, small=small)


def _left_behind(draft: Snapshot, base: Snapshot, table: str) -> list[str]:
    """References to rows that the step removed; versions are closed, never removed."""
    policy = POLICIES.get(table)
    referring = [(other, fk) for other, keys in REFERENCES.items() for fk, target, _ in keys if target == table and other in draft.tables]
    if policy is None or policy.method == "versions" or not referring or not base.tables.get(table):
        return []
    gone = _missing(base.frame(table).select(policy.surrogate), draft.frame(table).select(policy.surrogate), policy.surrogate)
    if gone.isEmpty():
        return []
    found = []
    for other, fk in referring:
        keys = gone.toDF(fk)
        first = lookup_join(draft.frame(other).select(fk), keys, fk, "left_semi", fk).first()
        if first is not None:
            found.append(f"{other}.{fk}: row {first[0]} of {table} is gone")
    return found
