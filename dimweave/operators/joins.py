"""Equi-joins that hold when one key owns a large share of the rows.

A side is broadcast only if its size is known to be bounded. Tables that the loads wrote have their rows and
text bytes observed while they were written, so the bound of a frame over them costs no job. A frame over other
files is too large if its files are, again without a job, and only small files are read to measure it. Beyond the bound
both sides are shuffled (adaptive execution may still broadcast what turns out small). Keys that own more than
``HOT_SHARE`` of a side, by the sketch kept with its table or else in a sample, are salted:
their rows are spread over a number of shuffle keys that grows with their share, and the
matching rows of the other side are repeated once for each. Salting never changes a result,
so a key that is missed costs time only. NULL keys match nothing and are spread as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.sources import statistics
from dimweave.sources.colocated import Apart

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.0001  # bounds the hot keys of a side to 10,000
HOT_SAMPLE = 0.01
HOT_SAMPLE_ROWS = 20  # a key seen less often in the sample is not taken for hot


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df``: row count times fixed widths plus the measured length of its texts."""
    fixed = statistics.ROW_BYTES
    texts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            texts.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        else:
            fixed += 16 if isinstance(f.dataType, T.DecimalType) else 8
    text = sum(texts, F.lit(0)).cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("b")).first()
    return row["n"] * fixed + row["b"]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is bounded by ``BROADCAST_BYTES``. Rows are read only where the files are smaller and nothing is known of them."""
    known = statistics.bound(df)
    size = known and known.bytes()
    if size is not None:
        return size <= BROADCAST_BYTES
    if statistics.file_bytes(df) > BROADCAST_BYTES:
        return False
    return measured_bytes(df) <= BROADCAST_BYTES


def hot_keys(df: DataFrame, key: str) -> dict:
    """Keys owning more than ``HOT_SHARE`` of the rows, with the number of parts to split each into.

    At most ``1 / HOT_SHARE`` keys, and as many parts again, whatever the size of ``df``. A key that comes unchanged from a
    table with a sketch is judged by its share of that table.
    """
    known = statistics.frequent_keys(df, key)
    if known is not None:
        rows, counts = known
        least = max(HOT_SHARE * rows, HOT_SAMPLE_ROWS / HOT_SAMPLE)
        return {k: max(2, math.ceil(n / (HOT_SHARE * rows))) for k, n in counts.items() if n > least}
    sample = df.select(key).where(F.col(key).isNotNull()).sample(HOT_SAMPLE, seed=7)
    counts = sample.rollup(key).agg(F.count(F.lit(1)).alias("n"), F.grouping(key).alias("all"))  # the total comes with the counts
    top = counts.orderBy(F.desc("all"), F.desc("n")).limit(1 + math.ceil(1 / HOT_SHARE)).collect()
    if not top:
        return {}
    total = top[0]["n"]
    least = max(HOT_SHARE * total, HOT_SAMPLE_ROWS)
    return {r[0]: max(2, math.ceil(r["n"] / (HOT_SHARE * total))) for r in top[1:] if r["n"] > least}


def hot_frame(df: DataFrame, key: str, hot: dict, column: str = "_parts") -> DataFrame:
    """Hot keys and their parts as a broadcast table; its size is bounded by ``HOT_SHARE``."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(column, T.IntegerType())])
    return F.broadcast(df.sparkSession.createDataFrame(list(hot.items()), schema))


def _spread(df: DataFrame, key: str, hot: dict, by: str, salt: str) -> DataFrame:
    """Give every row of a hot key one of its parts, NULL keys one of many, all others part 0."""
    parts = F.lit(1)
    if hot:
        df = df.join(hot_frame(df, key, hot), key, "left")
        parts = F.coalesce("_parts", F.lit(1))
    parts = F.when(F.col(key).isNull(), F.lit(int(1 / HOT_SHARE))).otherwise(parts)
    return df.withColumn(salt, F.pmod(F.xxhash64(by), parts).cast("int")).drop("_parts")


def _repeat(df: DataFrame, key: str, hot: dict, salt: str) -> DataFrame:
    """Repeat rows of a hot key for each of its parts."""
    if not hot:
        # Always 0, but not a constant: the optimizer would take a constant out of the shuffle keys
        # and with it the spread of NULL keys on the other side.
        return df.withColumn(salt, F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    marked = df.join(hot_frame(df, key, hot), key, "left")
    every = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return marked.withColumn(salt, F.explode(every)).drop("_parts")


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str, spread_by: str,
                small: bool | None = None, sample_from: DataFrame | None = None) -> DataFrame:
    """Join ``rows`` to ``lookup``, which has one row per key.

    ``how`` is inner, left, left_semi or left_anti; ``spread_by`` names a column that tells rows
    of one key apart. ``small`` says whether ``lookup`` fits a broadcast where the caller has a
    bound for it already; otherwise it is measured. ``sample_from`` is a cheaper frame to look
    for hot keys in than ``rows``.
    """
    if fits_broadcast(lookup) if small is None else small:
        return rows.join(F.broadcast(lookup), key, how)
    if how in ("inner", "left_semi"):
        rows = rows.where(F.col(key).isNotNull())
    hot = hot_keys(rows if sample_from is None else sample_from, key)
    if not hot and how in ("inner", "left_semi"):
        return rows.join(lookup, key, how)
    spread, repeated = _spread(rows, key, hot, spread_by, "_salt"), _repeat(lookup, key, hot, "_salt")
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


def _parts_join(left: Apart, right: Apart, join) -> DataFrame:
    """Inner join of two tables laid out by the same key: usual rows as they lie, hot rows with what they meet.

    A hot key is hot in one table or in both; only rows of such keys are looked up in the other's usual rows.
    """
    found = join(left.usual, right.usual)
    if not left.has_no_hot_rows():
        met = right.usual.where(F.col(right.key).isin(left.hot_keys()))
        found = found.unionByName(join(left.hot, met))
    if not right.has_no_hot_rows():
        met = left.usual.where(F.col(left.key).isin(right.hot_keys()))
        found = found.unionByName(join(met, right.hot))
    if not left.has_no_hot_rows() and not right.has_no_hot_rows():
        found = found.unionByName(join(left.hot, right.hot))
    return found


def pair_join(left: DataFrame | Apart, right: DataFrame | Apart, key: str, spread_left: str, spread_right: str) -> DataFrame:
    """Inner join of two sides that may both repeat keys."""
    if isinstance(left, Apart) or isinstance(right, Apart):
        left, right = (t if isinstance(t, Apart) else Apart(key, t, t.where("false")) for t in (left, right))
        return _parts_join(left, right, lambda a, b: pair_join(a, b, key, spread_left, spread_right))
    left, right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    if fits_broadcast(right):
        return left.join(F.broadcast(right), key)
    if fits_broadcast(left):
        return F.broadcast(left).join(right, key)
    hot_left, hot_right = hot_keys(left, key), hot_keys(right, key)
    if not hot_left and not hot_right:
        return left.join(right, key)
    for k in hot_left.keys() & hot_right.keys():  # rows are both spread and repeated: share the parts
        hot_left[k], hot_right[k] = (math.ceil(math.sqrt(h[k])) for h in (hot_left, hot_right))
    left = _repeat(_spread(left, key, hot_left, spread_left, "_salt_l"), key, hot_right, "_salt_r")
    right = _repeat(_spread(right, key, hot_right, spread_right, "_salt_r"), key, hot_left, "_salt_l")
    return left.join(right, [key, "_salt_l", "_salt_r"]).drop("_salt_l", "_salt_r")


def key_set(df: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """Distinct non-NULL keys and whether they fit a broadcast, by the bound that all rows give.

    Copies collapse before the shuffle; the bound costs no shuffle.
    """
    keys = df.select(key).where(F.col(key).isNotNull())
    return keys.distinct(), fits_broadcast(keys)


def newest_per_key(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """One row per key, the first in the ``newest`` order.

    Planned with a group limit before the shuffle, so at most one row per key leaves a task; rows laid out by one of
    the keys are not shuffled.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
