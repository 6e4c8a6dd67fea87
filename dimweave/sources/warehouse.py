"""Warehouse tables as immutable Parquet snapshots behind one pointer.

A step writes new folders and then publishes one small commit file naming the folders of every
table. A step that fails publishes nothing, so readers keep the old state; all tables a step
changes switch together. Fact and reject tables are kept by order month. A merge of the fact appends the new rows of a
month and lists the places (file and row) of those that have gone, which readers leave out; ``fold`` rewrites
months where that has become much. Rejects are few, so their months are rewritten.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.operators.facts import PLACE, month_of
from dimweave.operators.joins import fits_broadcast
from dimweave.sources.colocated import Apart, hot_values, is_apart, read_bucketed, write_bucketed
from dimweave.sources.schemas import COLOCATED, FACT_TABLE, KEY_COLUMNS, REJECT_TABLE, REQUIRED, table_schema
from dimweave.sources.statistics import Observed, TableStats, collect_shuffles, remember, with_frequent

WHOLE, CURRENT, CLOSED = "all", "current", "closed"
USUAL, HOT = "usual", "hot"  # parts of a table that is laid out by a key
FOLDERS = 8  # of a month, beyond which it is rewritten
CLAIM_SECONDS = 30  # for another run to publish the version that it claimed
MONTHLY = (FACT_TABLE, REJECT_TABLE)
_MONTH = "order_month"


_PLACES = "_file string, _row long"


def _place_columns() -> list:
    """Folder, month and name of a row's file, and the row's index in it. Cut from the path's end, as this is done for each row."""
    return [F.substring_index("_metadata.file_path", "/", -3).alias("_file"), F.col("_metadata.row_index").alias("_row")]


def _with_places(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())])


@dataclass
class Change:
    """New content of a table: a part of it, rows to append to a part, or the content of some months.

    Tables are one part unless they keep versions: those have a part of current rows and one of
    closed rows that only grows.
    """

    table: str
    frame: DataFrame
    append: bool = False
    months: list[str] | None = None
    part: str = WHOLE
    gone: DataFrame | None = None  # places of stored rows that go, with the order date; of a monthly table that is appended to


@dataclass(frozen=True)
class Snapshot:
    """The folders of every table at one version, and the last key handed out per key column."""

    spark: SparkSession
    root: str
    version: int = 0
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    last_keys: dict[str, int] = field(default_factory=dict)
    stats: dict[str, TableStats] = field(default_factory=dict)  # of folders, as observed while they were written
    gone: dict[str, dict[str, list[str]]] = field(default_factory=dict)  # folders with the places of rows that have gone, by month

    def months(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}))

    def with_table(self, table: str, written: Snapshot) -> Snapshot:
        """The next version, with one table as another snapshot has it."""
        tables = {**self.tables, table: written.tables[table]}
        return Snapshot(self.spark, self.root, self.version + 1, tables, self.last_keys, {**self.stats, **written.stats}, self.gone)

    def rows(self, table: str, parts: list[str] | None = None) -> int:
        """Rows of a table, or of some parts of it, without reading it."""
        folders = {folder_of(path) for part, paths in self.tables.get(table, {}).items() if parts is None or part in parts for path in paths}
        gone = {folder_of(path) for month, paths in self.gone.get(table, {}).items() if parts is None or month in parts for path in paths}
        return sum(self.stats[f].rows for f in folders) - sum(self.stats[f].rows for f in gone)

    def frame(self, table: str, parts: list[str] | None = None, schema=None) -> DataFrame:
        """A table, or some parts or months of it; empty where nothing was written yet."""
        schema = schema or table_schema(table)
        if any(month in self.gone.get(table, {}) for month in (self.tables.get(table, {}) if parts is None else parts)):
            return self.placed(table, parts).select(*schema.names)
        folders = [path for part, paths in self.tables.get(table, {}).items() if parts is None or part in parts for path in paths]
        if not folders:
            return self.spark.createDataFrame([], schema)
        for path in folders:
            if path in self.stats:
                remember(f"{self.root}/{path}", self.stats[path])
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{path}" for path in folders))

    def placed(self, table: str, months: list[str] | None = None) -> DataFrame:
        """Rows of a monthly table with their places, without those that have gone."""
        schema, chosen = table_schema(table), [m for m in self.months(table) if months is None or m in months]
        touched = [m for m in chosen if m in self.gone.get(table, {})]
        found = None
        for part in ([m for m in chosen if m not in touched], touched):
            paths = [f"{self.root}/{p}" for m in part for p in self.tables[table][m]]
            if not paths:
                continue
            rows = self.spark.read.schema(schema).parquet(*paths).select("*", *_place_columns())
            if part is touched:
                lists = [p for m in touched for p in self.gone[table][m]]
                for path in lists:
                    remember(f"{self.root}/{path}", self.stats[folder_of(path)])  # of all its months, a bound for one
                gone = self.spark.read.schema(_PLACES).parquet(*(f"{self.root}/{p}" for p in lists))
                rows = rows.join(F.broadcast(gone) if fits_broadcast(gone) else gone, PLACE, "left_anti").select(*rows.columns)
            found = rows if found is None else found.unionByName(rows)
        if found is None:
            return self.spark.createDataFrame([], _with_places(schema))
        return found

    def written_since(self, base: Snapshot, table: str) -> dict[str, list[str]]:
        """The paths that this state has and ``base`` has not, by part or month of a table."""
        before = base.tables.get(table, {})
        return {part: [p for p in paths if p not in before.get(part, [])] for part, paths in self.tables.get(table, {}).items()}

    def changed_since(self, base: Snapshot) -> set[str]:
        """Tables that differ from ``base``."""
        return {t for t in self.tables.keys() | base.tables.keys() if self.tables.get(t) != base.tables.get(t) or self.gone.get(t) != base.gone.get(t)}

    def read(self, table: str, paths: list[str]) -> DataFrame:
        """Some written paths of a table."""
        return self.spark.read.schema(table_schema(table)).parquet(*(f"{self.root}/{p}" for p in paths))

    def apart(self, table: str) -> Apart | DataFrame:
        """A table that is laid out by a key, its usual rows as they lie; any other table as a frame."""
        folders = self.tables.get(table, {}).get(USUAL, [])
        if len(folders) != 1 or folders[0] not in self.stats or not self.stats[folders[0]].buckets:
            return self.frame(table)
        stats, path, key = self.stats[folders[0]], f"{self.root}/{folders[0]}", COLOCATED[table]
        remember(path, stats)
        usual = read_bucketed(self.spark, path, table_schema(table), key, stats.buckets)
        hot = self.frame(table, [HOT]) if self.tables[table].get(HOT) else usual.where("false")
        return Apart(key, usual, hot)


def _null_counts(table: str) -> dict:
    """Conditions of rows that a table must not have, counted while it is written."""
    return {f"null {c}": F.col(c).isNull() for c in REQUIRED.get(table, [])}


def _folders(tables: dict[str, dict[str, list[str]]]) -> set[str]:
    """All folders that a state names."""
    return {folder_of(path) for parts in tables.values() for paths in parts.values() for path in paths}


def _appended(before: dict[str, list[str]], after: dict[str, list[str]]) -> dict[str, list[str]] | None:
    """What was added to each part of a table; None if anything was replaced or dropped."""
    if any(after.get(p, [])[: len(paths)] != paths for p, paths in before.items()):
        return None
    return {p: paths[len(before.get(p, [])):] for p, paths in after.items()}


class ConflictError(RuntimeError):
    """Another run published the same table, or the same version, meanwhile."""


def folder_of(path: str) -> str:
    """The folder that was written at once, of a path that may name one month in it."""
    return "/".join(path.split("/")[:2])


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, relative: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, relative: str) -> list[str]:
        fs, path = self._fs(), self._path(relative)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The latest published state, or an earlier version."""
        versions = sorted(int(n[:-5]) for n in self._names("_commits") if n.endswith(".json"))
        if version is None:
            version = versions[-1] if versions else 0
        if version == 0:
            return Snapshot(self.spark, self.root)
        if version not in versions:
            raise ValueError(f"no version {version} in {self.root}")
        stream = self._fs().open(self._path(f"_commits/{version:010d}.json"))
        state = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        stats = {folder: TableStats.from_json(s) for folder, s in state["stats"].items()}
        return Snapshot(self.spark, self.root, version, state["tables"], state["last_keys"], stats, state["gone"])

    def write(self, base: Snapshot, changes: list[Change], last_keys: dict[str, int]) -> Snapshot:
        """Write the changed tables to new folders; the state is not visible until published.

        The job that writes a folder also observes its numbers.
        """
        tables = {name: dict(parts) for name, parts in base.tables.items()}
        stats, gone = dict(base.stats), {name: dict(months) for name, months in base.gone.items()}
        for change in changes:
            folder = f"{change.table}/{uuid.uuid4().hex}"
            parts = tables.get(change.table, {})
            if change.gone is not None:
                places = Observed(change.gone.select(*PLACE, month_of("OrderDate").alias(_MONTH)).hint("rebalance", _MONTH))
                places.frame.write.partitionBy(_MONTH).parquet(f"{self.root}/{folder}-gone")
                stats[f"{folder}-gone"] = places.stats
                months = gone.setdefault(change.table, {})
                for month in self._months_in(f"{folder}-gone"):
                    months[month] = months.get(month, []) + [f"{folder}-gone/{_MONTH}={month}"]
            if change.table in MONTHLY:
                # Rebalancing splits a month that is too large for one task and merges small ones.
                monthly = change.frame.withColumn(_MONTH, month_of("OrderDate")).hint("rebalance", _MONTH)
                observed = Observed(monthly, counting=_null_counts(change.table))
                observed.frame.write.partitionBy(_MONTH).parquet(f"{self.root}/{folder}")
                replaced = [] if change.append else list(parts) if change.months is None else change.months
                parts = {m: p for m, p in parts.items() if m not in replaced}
                gone[change.table] = {m: p for m, p in gone.get(change.table, {}).items() if m not in replaced}
                for month in self._months_in(folder):
                    parts[month] = parts.get(month, []) + [f"{folder}/{_MONTH}={month}"]
                if change.gone is not None and observed.stats.rows == 0:  # a merge that also adds rows leaves empty months to fold
                    stats[folder] = observed.stats
                    self._drop_emptied(change.table, parts, gone[change.table], stats, f"{folder}-gone")
            elif change.table in COLOCATED and not change.append and change.part == WHOLE:
                parts, written = self._write_apart(change, folder)
                collect_shuffles(change.frame)
                tables[change.table] = parts
                stats |= written
                continue
            else:
                observed = Observed(change.frame, _null_counts(change.table))
                observed.frame.write.parquet(f"{self.root}/{folder}")
                parts = dict(parts)
                parts[change.part] = (parts.get(change.part, []) if change.append else []) + [folder]
            collect_shuffles(change.frame)
            written = self.spark.read.schema(change.frame.schema).parquet(f"{self.root}/{folder}")
            tables[change.table] = parts
            stats.setdefault(folder, with_frequent(observed.stats, written, KEY_COLUMNS.get(change.table, ())))
        gone = {t: months for t, months in gone.items() if months}
        stats = {f: s for f, s in stats.items() if f in _folders(tables) | _folders(gone)}
        return Snapshot(self.spark, self.root, base.version + 1, tables, {**base.last_keys, **last_keys}, stats, gone)

    def _drop_emptied(self, table: str, parts: dict, gone: dict, stats: dict, listed: str) -> None:
        """Leave out months of which every row has gone, among those that the list ``listed`` names, and their rows from the numbers.

        Rows are counted by file, from the file footers.
        """
        months = [m for m in self._months_in(listed) if m in parts]
        kept = self._rows_in([p for m in months for p in parts[m]], table_schema(table))
        lost = self._rows_in([p for m in months for p in gone[m]], _PLACES)
        for month in months:
            rows, places = parts[month], gone[month]
            if sum(kept.get(p, 0) for p in rows) > sum(lost.get(p, 0) for p in places):
                continue
            for counts, paths in ((kept, rows), (lost, places)):
                for path in paths:
                    known = stats[folder_of(path)]
                    stats[folder_of(path)] = replace(known, rows=known.rows - counts.get(path, 0))
            del parts[month], gone[month]

    def _rows_in(self, paths: list[str], schema) -> dict[str, int]:
        """Rows below each path of a month."""
        if not paths:
            return {}
        files = self.spark.read.schema(schema).parquet(*(f"{self.root}/{p}" for p in paths)).groupBy(F.col("_metadata.file_path").alias("_file")).count()
        path = F.regexp_extract("_file", f"([^/]+/[^/]+/{_MONTH}=[^/]+)/[^/]+$", 1).alias("_path")
        return {r["_path"]: r["n"] for r in files.groupBy(path).agg(F.sum("count").alias("n")).collect()}

    def _months_in(self, folder: str) -> list[str]:
        return [name.split("=", 1)[1] for name in self._names(folder) if name.startswith(f"{_MONTH}=")]

    def _write_apart(self, change: Change, folder: str) -> tuple[dict, dict]:
        """Write a table by its key: as many buckets as a shuffle has partitions, hot and NULL keys apart."""
        key, columns = COLOCATED[change.table], KEY_COLUMNS[change.table]
        hot, special = hot_values(change.frame, key)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = change.frame.where(~is_apart(key, hot)) if special else change.frame

        def known(stats, part):
            return with_frequent(stats, self.spark.read.schema(change.frame.schema).parquet(f"{self.root}/{folder}-{part}"), columns)

        usual = known(write_bucketed(rows, f"{self.root}/{folder}-usual", key, buckets), "usual")
        stats = {f"{folder}-usual": replace(usual, buckets=buckets)}
        parts = {USUAL: [f"{folder}-usual"]}
        if special:
            observed = Observed(change.frame.where(is_apart(key, hot)))
            observed.frame.write.parquet(f"{self.root}/{folder}-hot")
            stats[f"{folder}-hot"], parts[HOT] = known(observed.stats, "hot"), [f"{folder}-hot"]
        return parts, stats

    def publish(self, snapshot: Snapshot, base: Snapshot | None = None) -> Snapshot:
        """Make a written snapshot the current state and return it as published.

        If another run has published meanwhile, a draft is refused, or with its ``base`` given laid upon the newer state: that is
        safe where the other run changed none of the tables that this one did, or both only appended to it.
        """
        while True:
            try:
                self._commit(snapshot)
                return snapshot
            except ConflictError:
                latest = self.snapshot()
                if base is None or latest.version < snapshot.version:
                    raise
                tables, gone = dict(latest.tables), dict(latest.gone)
                theirs = latest.changed_since(base)
                for table in snapshot.changed_since(base):
                    parts = snapshot.tables[table]
                    if table in theirs and snapshot.gone.get(table) != base.gone.get(table):
                        raise ConflictError(f"{table} of {self.root} changed since version {base.version}") from None
                    if table in snapshot.gone and table not in theirs:
                        gone[table] = snapshot.gone[table]
                    if table in theirs:
                        added = [_appended(base.tables.get(table, {}), s.tables.get(table, {})) for s in (latest, snapshot)]
                        if None in added:
                            raise ConflictError(f"{table} of {self.root} changed since version {base.version}") from None
                        parts = {p: [*latest.tables[table].get(p, []), *added[1].get(p, [])] for p in latest.tables[table].keys() | added[1].keys()}
                    tables[table] = parts
                last_keys = {**latest.last_keys, **{k: v for k, v in snapshot.last_keys.items() if v != base.last_keys.get(k)}}
                stats = {f: s for f, s in {**latest.stats, **snapshot.stats}.items() if f in _folders(tables) | _folders(gone)}
                snapshot, base = Snapshot(self.spark, self.root, latest.version + 1, tables, last_keys, stats, gone), latest

    def _commit(self, snapshot: Snapshot) -> None:
        """Write the commit file of a version, once: who creates the version's claim owns it.

        Creating a file that must not exist is atomic on every file system Spark writes to; renaming is not. A claim without
        a commit is of a run that died between the two; it must be removed by hand once that run is known to be dead.
        """
        fs = self._fs()
        target, draft = self._path(f"_commits/{snapshot.version:010d}.json"), self._path(f"_drafts/{uuid.uuid4().hex}")
        claim = self._path(f"_claims/{snapshot.version:010d}")
        fs.mkdirs(claim.getParent())
        try:
            fs.create(claim, False).close()
        except Exception as error:  # the file system's own kinds of "exists already"
            if not fs.exists(claim):
                raise
            for _ in range(CLAIM_SECONDS):
                if fs.exists(target):
                    raise ConflictError(f"version {snapshot.version} of {self.root} already exists") from None
                time.sleep(1)
            raise RuntimeError(f"{claim} is claimed but not published") from error
        stats = {folder: s.to_json() for folder, s in snapshot.stats.items()}
        state = json.dumps({"tables": snapshot.tables, "last_keys": snapshot.last_keys, "stats": stats, "gone": snapshot.gone})
        fs.mkdirs(target.getParent())
        stream = fs.create(draft, False)
        stream.write(bytearray(state.encode("utf-8")))
        stream.close()
        if fs.exists(target) or not fs.rename(draft, target):
            raise ConflictError(f"version {snapshot.version} of {self.root} already exists")

    def fold(self, table: str, share: float = 0.1) -> list[str]:
        """Rewrite the months of a monthly table of whose rows more than ``share`` have gone or that lie in many folders; publishes one version."""
        base = self.snapshot()
        months = []
        for month, paths in base.tables.get(table, {}).items():
            lists = base.gone.get(table, {}).get(month, [])
            rows = base.read(table, paths).count() if lists else 0
            left = base.frame(table, [month]).count() if lists else 0
            if rows - left > share * rows or len(paths) > FOLDERS:
                months.append(month)
        if months:
            self.publish(self.write(base, [Change(table, base.frame(table, months), months=months)], {}), base)
        return sorted(months)

    def compact(self, table: str, part: str = WHOLE, folders: int = 8) -> bool:
        """Rewrite a part that appends have spread over more than ``folders`` folders; publishes one version."""
        base = self.snapshot()
        if len(base.tables.get(table, {}).get(part, [])) <= folders or table in MONTHLY:
            return False
        schema = self.spark.read.parquet(f"{self.root}/{base.tables[table][part][0]}").schema
        whole = base.frame(table, [part], schema=schema).hint("rebalance")
        self.publish(self.write(base, [Change(table, whole, part=part)], {}))
        return True

    def vacuum(self, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Delete what none of the last ``keep`` versions names: their readers go on, earlier versions end.

        Folders younger than ``older_than_hours`` stay, as a step may be writing them. Returns the deleted paths.
        """
        if keep < 1:
            raise ValueError("at least one version must be kept")
        versions = sorted(int(n[:-5]) for n in self._names("_commits") if n.endswith(".json"))
        named = set()
        for version in versions[-keep:]:
            state = self.snapshot(version)
            for parts in (*state.tables.values(), *state.gone.values()):
                named |= {folder_of(path) for paths in parts.values() for path in paths}
        before = (time.time() - older_than_hours * 3600) * 1000
        fs, deleted = self._fs(), []
        for table in self._names(""):
            if table.startswith("_"):
                continue
            for status in fs.listStatus(self._path(table)):
                path = f"{table}/{status.getPath().getName()}"
                if path not in named and status.getModificationTime() < before and fs.delete(status.getPath(), True):
                    deleted.append(path)
        for version in versions[:-keep]:
            fs.delete(self._path(f"_commits/{version:010d}.json"), False)
        return deleted
