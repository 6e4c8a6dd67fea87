"""Mixing sources to target weights.

Every source has a budget of words. Documents get hash-random keys and are sorted by range within their source;
prefix sums of their sizes over these ranges say which words of the source a document holds, and the
source is cut where its budget ends. A budget above the source's size takes whole epochs first. So a source gives
its budget to the word, and the document at the cut gives its first words only.

Targets: sources in the order of their code points, null last, weigh ``WEIGHTS`` in turn and share
the size of all. None gets over ``MOST`` times its own size; what is left over goes to the others by weight. That
is one water level: sources are sorted by size for weight, prefix sums tell what stays for the rest if all before
are at their limit, and the first source that its share leaves below its limit sets the level for all behind it.

DataFrame functions only. Texts are read once, to count their words; what is sorted and shuffled is four
small columns. Prefix sums are made in the parts of a range sort and then over the parts, so no
source, however hot, lies in one task; equal rows are dealt out by a number of their own. Neither sources nor
documents are collected: the driver sees the water level, one row.

Nulls and ties: a null text has no words, a null source is one more source, a null doc_id is a key like another. Rows
with equal doc_id, source and size are interchangeable: as many of them take a given number of words in every run. An empty
table gives no rows; a source without words has the target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import materialize, spread

WEIGHTS = (1, 2, 3)
MOST = 3  # times its size that a source, and so a document, is taken at most
WORD = "[^\\x20\\x09-\\x0D]+"
ROWS_PER_PART = 100_000  # of the table of sources


def prefix_sums(df: DataFrame, within: list[str], order: list[Column], sums: dict[str, str], parts: int, label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` sorted by ``within`` and ``order`` over ``parts`` ranges, as a written table with its part's number ``part``, and
    a row for each part and value of ``within``: in ``sums``' names what the earlier parts hold of the named columns.

    The first table has in each such name what the rows before hold in their own part.
    """
    keys = [F.col(c) for c in within]
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, label)
    before = Window.partitionBy("part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.select("*", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(name) for name, c in sums.items()))
    totals = ranged.groupBy("part", *within).agg(*(F.sum(c).alias(name) for name, c in sums.items()))
    earlier = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    return rows, totals.select("part", *within, *(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums))


def _whole(rows: DataFrame, parts: DataFrame, names: list[str]) -> DataFrame:
    """Sums within and before the parts, added."""
    other = parts.select("part", *(F.col(n).alias(f"earlier_{n}") for n in names))
    return rows.join(other, "part").select(*(c for c in rows.columns if c not in (*names, "part")), *((F.col(n) + F.col(f"earlier_{n}")).alias(n) for n in names))


def sized(docs: DataFrame, seed: str = "") -> DataFrame:
    """Of every row: ``doc_id``, its source as ``none`` (is null) and ``name``, ``size`` in words, the hash-random ``key``
    and ``copy``, the row's place, which tells equal rows apart."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.conv(F.substring(F.md5(F.concat(F.lit(seed), doc)), 1, 15), 16, 10).cast("long")
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("doc_id", F.col("source").isNull().alias("none"), name.alias("name"), size.alias("size"), key.alias("key"), F.monotonically_increasing_id().alias("copy"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``none``, ``name``, ``source_size`` and ``target`` of a table of sources (none, name, source_size), one row each."""
    sources = materialize(sources.select("none", "name", F.col("source_size").cast("long").alias("source_size")), "sources")
    total, n = sources.agg(F.sum("source_size"), F.count(F.lit(1))).first()
    parts = -(-n // ROWS_PER_PART) or 1
    one = sources.withColumn("one", F.lit(1).cast("long"))
    ranked = _whole(*prefix_sums(one, [], [F.col("none").asc(), F.col("name").asc()], {"rank": "one"}, parts, "ranked"), ["rank"])
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight).withColumn("level", F.col("source_size") / F.col("weight"))
    order = [F.col("level").asc(), F.col("rank").asc()]
    level = _whole(*prefix_sums(weighed.drop("one"), [], order, {"size_before": "source_size", "weight_before": "weight"}, parts, "levels"), ["size_before", "weight_before"])
    level = materialize(level, "level")
    wide = "decimal(38,0)"
    all_weights = F.lit(level.agg(F.sum("weight")).first()[0] or 0)
    left, weight_left = F.lit(total or 0) - most * F.col("size_before"), all_weights - F.col("weight_before")
    fits = left.cast(wide) * F.col("weight") <= F.col("source_size").cast(wide) * most * weight_left
    at = level.where(fits).orderBy(*order).select("level", "rank", left.alias("left"), weight_left.alias("weight_left")).first()
    if at is None:
        return level.select("none", "name", "source_size", F.lit(0.0).alias("target"))
    capped = F.struct("level", "rank") < F.struct(F.lit(at["level"]).alias("level"), F.lit(at["rank"]).alias("rank"))
    share = (F.col("weight") * F.lit(at["left"])).cast("double") / F.lit(at["weight_left"]).cast("double")
    return level.select("none", "name", "source_size", F.when(capped, (most * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "") -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted), ``epochs`` (whole ones) of every row,
    and ``copy``, the row's place in ``docs``."""
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_last(), F.col("size").asc(), F.col("copy").asc()]
    source = ["none", "name"]
    rows, parts = prefix_sums(sized(docs, seed), source, order, {"before": "size"}, spread(docs), "ranges")
    shares = targets(rows.groupBy(*source).agg(F.sum("size").alias("source_size")), weights, most)
    # A row for each part of each source: it meets the rows where the windows left them, by part and source.
    rows = rows.join(parts.withColumnRenamed("before", "earlier").join(shares, source), ["part", *source])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before") - F.col("earlier")))
    return rows.select("doc_id", F.when(~F.col("none"), F.col("name")).alias("source"), "size", "source_size", "target", (epochs * F.col("size") + last).alias("taken"), epochs.alias("epochs"), "copy")


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "") -> DataFrame:
    """The mix itself: the rows of ``docs`` once for each epoch that takes them, in ``row``, with ``epoch`` (from 1) and the ``text`` taken.

    ``docs`` must give its rows in the same place whenever it is read, as a written table does.
    """
    taken = mix(docs, weights, most, seed).where("taken > 0").select("copy", "size", "taken")
    whole = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("copy")).join(taken, "copy")
    epoch = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))
    rows = whole.select("row", "size", "taken", epoch.alias("epoch"))
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    spaced = F.regexp_extract_all("row.text", F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    text = F.when(words == F.col("size"), F.col("row.text")).otherwise(F.array_join(F.slice(spaced, F.lit(1), words.cast("int")), ""))
    return rows.select("row", "epoch", text.alias("text"))
