"""Tables laid out by a key, so that what joins or groups by it needs no exchange.

Rows are written in buckets by the hash of the key, sorted within, in the format that Spark's own bucketed tables have; a reader
names the same buckets, and two tables with as many of them join as they lie. Rows whose key is NULL or owns more than
``HOT_SHARE`` of the table would make one bucket large. They are written apart, in no order, and joins spread them.

The hot keys come from a frequent-items sketch of the key column alone, which is read before the table is written.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.sources.statistics import Observed, TableStats, bound, frequent_of

HOT_SHARE = 0.0001  # bounds the hot keys of a table to 10,000
HOT_ROWS = 2000  # a key with fewer rows is not hot, however small the table


@dataclass(frozen=True)
class Apart:
    """A table in two parts: ``usual``, laid out by ``key``, and ``hot``, the rows with a hot or NULL key."""

    key: str
    usual: DataFrame
    hot: DataFrame

    def map(self, change) -> Apart:
        """Both parts changed alike, by a step that neither drops nor renames the key."""
        return Apart(self.key, change(self.usual), change(self.hot))

    def whole(self) -> DataFrame:
        return self.usual.unionByName(self.hot)

    def hot_keys(self) -> list:
        """The keys of the hot rows, at most ``1 / HOT_SHARE``; NULL is not named."""
        if self.has_no_hot_rows():
            return []
        return sorted(r[0] for r in self.hot.select(self.key).where(F.col(self.key).isNotNull()).distinct().collect())

    def has_no_hot_rows(self) -> bool:
        known = bound(self.hot.select(self.key))
        return known is not None and known.rows == 0


def both(table: DataFrame | Apart, change) -> DataFrame | Apart:
    return table.map(change) if isinstance(table, Apart) else change(table)


def whole(table: DataFrame | Apart) -> DataFrame:
    return table.whole() if isinstance(table, Apart) else table


def hot_values(df: DataFrame, key: str) -> tuple[list, int]:
    """Keys with more than ``HOT_SHARE`` of the rows, and the number of rows with such a key or with NULL. Reads the key column alone."""
    stats = frequent_of(df, (key,)).get(None)
    if stats is None:  # no rows
        return [], 0
    hot = {k: n for k, n in stats.frequent[key] if n > max(HOT_SHARE * stats.rows, HOT_ROWS)}
    return list(hot), stats.counts[key] + sum(hot.values())


def is_apart(key: str, hot: list):
    """Condition of the rows that are written apart."""
    special = F.col(key).isNull()
    return F.coalesce(special | F.col(key).isin(hot), F.lit(False)) if hot else special


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> TableStats:
    """Write ``df`` in buckets: one shuffle, one sorted file for each bucket."""
    observed = Observed(df.repartition(buckets, key).sortWithinPartitions(key))
    name = f"dimweave_write_{hashlib.md5(path.encode()).hexdigest()}"
    (observed.frame.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files are not the table's own
    return observed.stats


def read_bucketed(spark: SparkSession, path: str, schema, key: str, buckets: int) -> DataFrame:
    """A reader over the files of ``write_bucketed`` that knows their layout."""
    name = f"dimweave_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name).select(*(F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else F.col(f.name) for f in schema.fields))
