"""What is known of a written table without reading it: its rows, the bytes of its texts, its frequent keys.

A table that the loads write is observed by the job that writes it, so its rows and bytes cost no pass of their own. Frequent
keys come from a frequent-items sketch for each key column, filled and merged by tasks that read the written key columns:
every key with ``FREQUENT_SHARE`` of the rows is in it, only such keys reach the driver, and counts of several folders of one
table add up. The numbers are kept by folder, in the commit for tables of the warehouse.

``bound`` follows the optimized plan of a frame down to the folders it reads. Steps that never add a row or a byte to a column
(projections, filters, groupings, semi and anti joins, orders and shuffles) keep the numbers as an upper bound; for any other
plan nothing is known.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.sources import scratch

FREQUENT_SHARE = 0.00005  # of the rows; a key below it is never worth a salt
FREQUENT_ROWS = 1000  # nor is one with fewer rows
TRACKED = 50_000  # items of a sketch, which bounds its error to less than that share
MERGERS = 16  # tasks that merge the sketches of all others, before one merges theirs

ROW_BYTES = 16  # of a row beside its columns
LARGE_INPUT = 16 * 1024 * 1024  # bytes of the files that a job reads, beyond which its shuffles are not left to chance
_KEEP_ROWS = {"Filter", "Sort", "Window", "WindowGroupLimit", "Repartition", "RepartitionByExpression", "RebalancePartitions", "GlobalLimit", "LocalLimit", "SubqueryAlias", "ResolvedHint", "CollectMetrics"}


@dataclass(frozen=True)
class TableStats:
    """Numbers of one folder, or of several together."""

    rows: int
    texts: dict[str, int] = field(default_factory=dict)
    frequent: dict[str, list[list]] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    buckets: int | None = None  # where rows are laid out by a key

    def to_json(self) -> dict:
        return {"rows": self.rows, "texts": self.texts, "frequent": self.frequent, "buckets": self.buckets}

    @classmethod
    def from_json(cls, state: dict) -> TableStats:
        return cls(state["rows"], state["texts"], state["frequent"], buckets=state["buckets"])

    def plus(self, other: TableStats) -> TableStats:
        """Both folders as one table; what only one of them knows of a column is not known of both."""
        texts = {c: n + other.texts[c] for c, n in self.texts.items() if c in other.texts}
        frequent = {}
        for column in self.frequent.keys() & other.frequent.keys():
            merged: dict = {}
            for key, n in (*self.frequent[column], *other.frequent[column]):
                merged[key] = merged.get(key, 0) + n
            frequent[column] = [[k, n] for k, n in merged.items()]
        counts = {c: n + other.counts[c] for c, n in self.counts.items() if c in other.counts}
        return TableStats(self.rows + other.rows, texts, frequent, counts)


class Observed:
    """A frame to write in place of another; once it is written, ``stats`` has its numbers but no frequent keys."""

    def __init__(self, df: DataFrame, counting: dict[str, Column] | None = None, split: tuple[str, tuple] | None = None):
        self._texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        self._counting = counting or {}
        self._observation = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [F.sum(F.octet_length(F.col(f"`{c}`"))).alias(f"text {i}") for i, c in enumerate(self._texts)]
        metrics += [F.count_if(condition).alias(f"count {i}") for i, condition in enumerate(self._counting.values())]
        self._split = split
        for v, value in enumerate(split[1] if split else ()):
            literal = str(value).lower() if isinstance(value, bool) else f"'{value}'"
            here = f"`{split[0]}` = {literal}"
            metrics.append(F.expr(f"count_if({here})").alias(f"rows of {v}"))
            metrics += [F.expr(f"sum(case when {here} then octet_length(`{c}`) end)").alias(f"text {i} of {v}") for i, c in enumerate(self._texts)]
        self.frame = df.observe(self._observation, *metrics)

    def split_stats(self) -> dict:
        """Numbers of the rows of each value of the column that the frame is split by."""
        found = self._observation.get
        return {value: TableStats(found[f"rows of {v}"], {c: found[f"text {i} of {v}"] or 0 for i, c in enumerate(self._texts)})
                for v, value in enumerate(self._split[1])}

    @property
    def stats(self) -> TableStats:
        found = self._observation.get
        return TableStats(found["rows"], {c: found[f"text {i}"] or 0 for i, c in enumerate(self._texts)},
                          counts={c: found[f"count {i}"] for i, c in enumerate(self._counting)})


def frequent_of(df: DataFrame, keys: tuple[str, ...], by: str | None = None) -> dict[object, TableStats]:
    """Frequent values of key columns, rows and NULL keys (``counts``), of the rows of each value of ``by`` or of all (None).

    Each task fills a sketch for a column, some tasks merge them and one the rest, so that what the driver gets is bounded by ``FREQUENT_SHARE``.
    """
    names = [f"key {i}" for i in range(len(keys))]
    group = (F.col(f"`{by}`") if by else F.lit(0)).alias("_by")
    rows = df.select(group, (F.spark_partition_id() % MERGERS).alias("_merger"), *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)])
    filled = rows.groupBy("_by", "_merger").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(n).isNull()).alias(f"null {n}") for n in names],
        *[F.expr(f"approx_top_k_accumulate(`{n}`, {TRACKED})").alias(n) for n in names])
    merged = filled.groupBy("_by").agg(
        F.sum("rows").alias("rows"), *[F.sum(f"null {n}").alias(f"null {n}") for n in names],
        *[F.expr(f"approx_top_k_combine(`{n}`, {TRACKED})").alias(n) for n in names])
    least = f"greatest(rows * {FREQUENT_SHARE}, {FREQUENT_ROWS})"
    found = merged.select("_by", "rows", *[f"null {n}" for n in names], *[F.expr(
        f"filter(approx_top_k_estimate(`{n}`, {TRACKED // 5}), x -> x.item is not null and x.count >= {least})").alias(n) for n in names]).collect()
    return {r["_by"] if by else None: TableStats(
        r["rows"], frequent={k: [[x["item"], x["count"]] for x in r[n]] for k, n in zip(keys, names, strict=True)},
        counts={k: r[f"null {n}"] for k, n in zip(keys, names, strict=True)}) for r in found}


def with_frequent(stats: TableStats, written: DataFrame, keys: tuple[str, ...]) -> TableStats:
    """The numbers of a written table with the frequent values of its key columns; a table of few rows, where no key is frequent, is not read."""
    keys = tuple(k for k in keys if k in written.columns)
    if not keys or stats.rows < FREQUENT_ROWS:
        return replace(stats, frequent={k: [] for k in keys})
    return replace(stats, frequent=frequent_of(written, keys)[None].frequent)


_known: dict[str, TableStats] = {}


def remember(path: str, stats: TableStats) -> None:
    """Keep the numbers of a folder for this process."""
    _known[_plain(path)] = stats


def _plain(path: str) -> str:
    """A folder's path without scheme, as plans and callers may differ in it."""
    rest = path.split(":", 1)[1] if ":/" in path else path
    return "/" + rest.strip("/")


def record(df: DataFrame, label: str, partition_by: str | None = None, keys: tuple[str, ...] = (),
           counting: dict[str, Column] | None = None) -> DataFrame:
    """``scratch.materialize`` with the numbers of the written table kept; ``keys`` get a sketch, ``counting`` counts rows."""
    observed = Observed(df, counting)
    written = scratch.materialize(observed.frame, label, partition_by)
    collect_shuffles(df)
    stats = with_frequent(observed.stats, written, keys)
    for path in _folders(_leaves(written)[0]):
        remember(path, stats)
    return written


def record_split(df: DataFrame, label: str, column: str, values: tuple, keys: tuple[str, ...] = ()) -> dict:
    """Write ``df`` once, apart by the values of ``column``; a reader and the numbers kept for each value's rows."""
    path = scratch.new_path(df.sparkSession, label)
    observed = Observed(df, split=(column, values))
    observed.frame.write.partitionBy(column).parquet(path)
    collect_shuffles(df)
    schema = df.drop(column).schema
    split = observed.split_stats()
    frequent = {}
    if keys and max(stats.rows for stats in split.values()) >= FREQUENT_ROWS:
        frequent = frequent_of(df.sparkSession.read.schema(df.schema).parquet(path), keys, column)
    readers = {}
    for value, stats in split.items():
        stats = replace(stats, frequent=frequent[value].frequent if value in frequent else {k: [] for k in keys})
        folder = f"{path}/{column}={str(value).lower() if isinstance(value, bool) else value}"
        if stats.rows:
            readers[value] = df.sparkSession.read.schema(schema).parquet(folder)
            remember(folder, stats)
        else:
            readers[value] = df.sparkSession.read.schema(schema).parquet(path).where("false").select(*schema.names)
    return readers


def count_of(written: DataFrame, name: str | None = None) -> int:
    """Rows of a table made by ``record``, all or those of one of its ``counting`` conditions; other frames are counted."""
    leaves = _leaves(written)
    if _kind(leaves[0]) == "LocalRelation" and name is None:
        return leaves[0].data().length()
    stats = _stats_of(leaves[0]) if _kind(leaves[0]) == "LogicalRelation" else None
    if stats is None and name is None:
        return written.count()
    return stats.rows if name is None else stats.counts[name]


@dataclass
class Bound:
    """At most so many rows; where a column comes from, and the numbers of the table that it comes from."""

    rows: int
    columns: dict[int, str | None]
    stats: TableStats
    output: list[tuple[int, T.DataType]] = field(default_factory=list)

    def bytes(self) -> int | None:
        """At most so many bytes in memory; None if a text was computed."""
        if not self.rows:
            return 0
        total = self.rows * ROW_BYTES
        for number, kind in self.output:
            if isinstance(kind, T.StringType):
                length = self.stats.texts.get(self.columns.get(number) or "")
                if length is None:
                    return None
                total += length
            else:
                total += self.rows * (16 if isinstance(kind, T.DecimalType) else 8)
        return total


def bound(df: DataFrame) -> Bound | None:
    """What is known of a frame, from its plan; no job runs."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        found = _trace(plan)
        output = plan.output()
    except AttributeError:  # a session without a JVM plan
        return None
    if found is None or any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for f in df.schema.fields):
        return None
    found.output = [(output.apply(i).exprId().id(), f.dataType) for i, f in enumerate(df.schema.fields)]
    return found


def frequent_keys(df: DataFrame, key: str) -> tuple[int, dict] | None:
    """Rows of the table that ``key`` comes from and its frequent values with their counts; None if that is not known."""
    found = bound(df.select(key))
    column = found and found.columns.get(found.output[0][0])
    if not column or column not in found.stats.frequent:
        return None
    return found.stats.rows, dict(map(tuple, found.stats.frequent[column]))


def file_bytes(df: DataFrame) -> int:
    """Bytes of all files that a frame reads; 0 for what is not a file. No job runs."""
    return sum(leaf.relation().location().sizeInBytes() for leaf in _leaves(df) if _kind(leaf) == "LogicalRelation")


def collect_shuffles(df: DataFrame) -> None:
    """Have the shuffles of ``df`` deleted once it is written, where it reads large files.

    Spark deletes those of a finished plan when the driver's JVM has collected the plan, which may be long after the disk is full.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()  # as it is already
    given = [leaves.apply(i) for i in range(leaves.length())]
    if sum(leaf.relation().location().sizeInBytes() for leaf in given if _kind(leaf) == "LogicalRelation") > LARGE_INPUT:
        system = df.sparkSession.sparkContext._jvm.System
        df.sparkSession.range(0, 1, 1, 1).collect()  # Spark holds a finished plan until it has run another
        system.gc()
        system.runFinalization()  # what a finalizer still holds goes with the second collection only
        system.gc()


def discard(written: DataFrame) -> None:
    """Delete a table made by ``scratch.materialize`` that nothing reads any more."""
    for path in _folders(_leaves(written)[0]):
        scratch.drop(written.sparkSession, path)


def _kind(plan) -> str:
    return plan.getClass().getSimpleName()


def _leaves(df: DataFrame) -> list:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [leaves.apply(i) for i in range(leaves.length())]


def _folders(relation) -> list[str]:
    paths = relation.relation().location().rootPaths()
    return [paths.apply(i).toString() for i in range(paths.length())]


def _stats_of(relation) -> TableStats | None:
    found = [_known.get(_plain(p)) for p in _folders(relation)]
    if not found or any(s is None for s in found):
        return None
    total = found[0]
    for stats in found[1:]:
        total = total.plus(stats)
    return total


def _together(union) -> Bound | None:
    """Numbers of a union: column by column, those of its members added."""
    members = union.children()
    traced, names = [], []
    for i in range(members.length()):
        found = _trace(members.apply(i))
        if found is None:
            return None
        if found.rows:
            output = members.apply(i).output()
            traced.append(found)
            names.append([found.columns.get(output.apply(k).exprId().id()) for k in range(output.length())])
    output = union.output()
    total = None
    for found, own in zip(traced, names, strict=True):
        renamed = TableStats(found.rows, {str(k): found.stats.texts[c] for k, c in enumerate(own) if c in found.stats.texts},
                             {str(k): found.stats.frequent[c] for k, c in enumerate(own) if c in found.stats.frequent})
        total = renamed if total is None else total.plus(renamed)
    total = total or TableStats(0)
    return Bound(total.rows, {output.apply(k).exprId().id(): str(k) for k in range(output.length())}, total)


def _trace(plan) -> Bound | None:
    kind = _kind(plan)
    if kind == "LogicalRelation":
        stats = _stats_of(plan)
        output = plan.output()
        return stats and Bound(stats.rows, {output.apply(i).exprId().id(): output.apply(i).name() for i in range(output.length())}, stats)
    if kind == "LocalRelation":
        return Bound(plan.data().length(), {}, TableStats(plan.data().length()))
    if kind in _KEEP_ROWS:
        return _trace(plan.children().apply(0))
    if kind == "Join" and plan.joinType().toString() in ("LeftSemi", "LeftAnti"):
        return _trace(plan.children().apply(0))
    if kind == "Union":
        return _together(plan)
    if kind in ("Project", "Aggregate"):
        below = _trace(plan.children().apply(0))
        if below is None:
            return None
        given = plan.projectList() if kind == "Project" else plan.aggregateExpressions()
        for i in range(given.length()):
            named = given.apply(i)
            if _kind(named) == "Alias" and _kind(named.child()) == "AttributeReference":
                below.columns[named.exprId().id()] = below.columns.get(named.child().exprId().id())
        return below
    return None
