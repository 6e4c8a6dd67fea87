"""Removal of runs of lines that occurred before, by winnowing over line hashes.

Lines become rows once: place, hash, length; blank lines are passed over. A window is as many lines in a row as
it takes to reach ``MIN_CHARS`` characters, and the line with the least hash in it is selected (the last of equal
ones). So every run of ``MIN_CHARS`` characters or more has a selected line, and equal runs select the same one; a line of
that length is a window of its own. Only selected lines are joined: each with the first selected place of the same line, in the
order of (doc_id, text_key, line). Short selected lines, which are common, also meet the first place of the line with the line
before it and with the line after it. A match is extended both ways over the lines that begin within ``MIN_CHARS``
characters before it and end within as many behind it, as long as they agree with those beside the first place (a longer
extension holds a selected line of its own). The lines of a match of ``MIN_CHARS`` characters or more go, blank ones
between them too.

With ``short_times`` a further step takes single lines below ``MIN_CHARS``: one that occurs so many times is boilerplate, and all
but its first occurrence go, wherever they stand. Repeated fewer times and not within a run, a short line stays.

DataFrame functions only. Places are reduced to the first of each line before rows are dealt out, and each
selected line meets one row for each of its keys, so common lines make no pairs. What is joined is a written
table, so both sides are dealt out for the join and adaptive execution can split a hot line. A document is
sorted by its lines and never gathered in one row but for its removed line numbers.

Nulls and ties: a null text is empty. Null doc_ids come first. Rows that share doc_id and text are one
document and get the same result. Judged on the input: a line is compared with the lines as they
were, also if the earlier ones go too, which happens only where runs of one document overlap
themselves. A line of spaces alone is blank, one of tabs is not. A document whose lines all go keeps its row with an empty
text. Blank lines go only inside a removed run. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import materialize

MIN_CHARS = 40
SHORT_TIMES = 3

_DOC = ["doc_id", "text_key"]


def line_rows(docs: DataFrame) -> DataFrame:
    """A row for each line that is not blank: document, number of the line from 0, two hashes of it, its characters."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    rows = lines.select(*_DOC, "at", F.xxhash64("line").alias("hash"), F.hash("line").alias("check"), F.length(F.trim("line")).alias("chars")).where("chars > 0")
    # Rows of one doc_id and text are one document; copies collapse before anything is dealt out.
    return rows.groupBy(*_DOC, "at").agg(*(F.min(c).alias(c) for c in ("hash", "check", "chars")))


def winnowed(lines: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The selected lines with the lines beside them, nearest first."""
    doc = Window.partitionBy(*_DOC)
    placed = lines.withColumn("end", F.sum("chars").over(doc.orderBy("at"))).withColumn("begin", F.col("end") - F.col("chars"))
    by_begin, by_end = doc.orderBy("begin"), doc.orderBy("end")
    least = F.min(F.struct("hash", (-F.col("at")).alias("last"))).over(by_begin.rangeBetween(0, min_chars - 1))
    beside = F.struct("hash", "at", "chars")
    placed = placed.select("*", least.alias("least"), (F.max("end").over(doc) - F.col("begin")).alias("rest"),
                           F.reverse(F.collect_list(beside).over(by_begin.rangeBetween(-min_chars, -1))).alias("before"))
    placed = placed.withColumn("after", F.collect_list(beside).over(by_end.rangeBetween(1, min_chars)))
    # A window's least line is marked from the window's first line: within the window's reach, so again a frame.
    chosen = F.when(F.col("rest") >= min_chars, -F.col("least.last"))
    marked = F.array_contains(F.collect_set(chosen).over(by_begin.rangeBetween(-(min_chars - 1), 0)), F.col("at"))
    return placed.withColumn("selected", marked).where("selected").select(*_DOC, "at", "hash", "check", "chars", "before", "after")


def _agreeing(a: Column, b: Column) -> Column:
    """The common head of two lists of lines."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x["hash"] == y["hash"], F.lit(False)))
    n = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)).cast("int") - 1, F.size(same))
    return F.slice(a, F.lit(1), n)


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda total, x: total + x["chars"])


def _keyed(selected: DataFrame, min_chars: int) -> DataFrame:
    """Selected lines with what they are joined by: the line, and if it is short also the line with either neighbour."""
    line = F.xxhash64("hash", "check")
    pairs = F.array_compact(F.array(line, F.when(F.size("before") > 0, F.xxhash64("hash", "check", F.get("before", F.lit(0))["hash"], F.lit(1))),
                                    F.when(F.size("after") > 0, F.xxhash64("hash", "check", F.get("after", F.lit(0))["hash"], F.lit(2)))))
    return selected.select("*", F.explode(F.when(F.col("chars") < min_chars, pairs).otherwise(F.array(line))).alias("key"))


def later_runs(docs: DataFrame, min_chars: int = MIN_CHARS, short_times: int | None = None) -> DataFrame:
    """``doc_id``, ``text_key`` and the list of lines (numbers from 0) that go."""
    lines = materialize(line_rows(docs), "lines")
    selected = materialize(_keyed(winnowed(lines, min_chars), min_chars), "selected")
    place = F.struct(*_DOC, "at")
    firsts = selected.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    # Only what stands at a first place brings its neighbours along.
    firsts = materialize(firsts, "firsts")
    later = selected.join(firsts, "key")
    here = place.eqNullSafe(F.col("first"))
    origins = later.where(here).select("key", F.col("before").alias("first_before"), F.col("after").alias("first_after"))
    matches = later.where(~here).join(materialize(origins, "origins"), "key")
    up, down = _agreeing(F.col("before"), F.col("first_before")), _agreeing(F.col("after"), F.col("first_after"))
    runs = matches.select(*_DOC, "at", "chars", up.alias("up"), down.alias("down"))
    runs = runs.where(F.col("chars") + _chars(F.col("up")) + _chars(F.col("down")) >= min_chars)
    begin, end = F.coalesce(F.try_element_at("up", F.lit(-1))["at"], F.col("at")), F.coalesce(F.try_element_at("down", F.lit(-1))["at"], F.col("at"))
    gone = runs.select(*_DOC, F.explode(F.sequence(begin, end)).alias("at"))
    if short_times:
        gone = gone.union(repeated_short_lines(lines, min_chars, short_times))
    return gone.groupBy(*_DOC).agg(F.collect_set("at").alias("gone"))


def repeated_short_lines(lines: DataFrame, min_chars: int, times: int) -> DataFrame:
    """Places of all but the first occurrence of lines below ``min_chars`` that occur at least ``times`` times."""
    short = lines.where(F.col("chars") < min_chars)
    place = F.struct(*_DOC, "at")
    common = short.groupBy("hash", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where(F.col("times") >= times)
    common = materialize(common.drop("times"), "common")
    return short.join(common, ["hash", "check"]).where(~place.eqNullSafe(F.col("first"))).select(*_DOC, "at")


def remove_later_runs(docs: DataFrame, min_chars: int = MIN_CHARS, short_times: int | None = None) -> DataFrame:
    """``docs`` with the kept lines as ``text`` and a struct ``lines`` (total, removed) beside ``row``'s other columns.

    Returns the columns ``row`` (all columns of ``docs``), ``text``, ``n_lines`` and ``n_removed``, so
    that no name of ``docs`` can clash. A null text stays null.
    """
    gone = later_runs(docs.select("doc_id", "text"), min_chars, short_times)
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("key"))
    joined = whole.join(gone, whole["id"].eqNullSafe(gone["doc_id"]) & (whole["key"] == gone["text_key"]), "left")
    joined = joined.select("row", F.split(F.coalesce("row.text", F.lit("")), "\n").alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.size("gone") == 0, F.col("row.text")).otherwise(F.array_join(F.transform(places, lambda p: F.get("lines", p)), "\n"))
    return joined.select("row", kept.alias("text"), F.size("lines").alias("n_lines"), F.size("gone").alias("n_removed"))
