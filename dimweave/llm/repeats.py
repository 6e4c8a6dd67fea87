"""Removal of every byte that lies in a repeated string of ``LENGTH`` bytes, by ranks of anchored strings.

Sorting (rank, rank at offset) pairs of all positions at doubling offsets, as prefix doubling does, shuffles every byte
of the text as a row in each round (README has the figures). Here few positions are ranked, by hashing, and only the
last round derives a rank from a pair of ranks.

Texts are UTF-8 bytes and a match never crosses documents. Ranks are names of strings: equal strings,
and no others, have equal ranks (64-bit hashes; two of them must agree before a byte goes).

1. Every start of a 200-byte string is tied to the least ``GRAM``-byte gram in it (its anchor), which
   depends on the string alone. So equal strings have anchors with equal ranks, and only about one
   position in 70 has to be ranked. Anchors with a unique rank are done: nothing near them repeats.
2. The span of an anchor holds all strings tied to it. Spans are ranked next; a span whose rank is
   not unique is repeated as a whole, and so is each of its bytes.
3. The unique spans of repeated anchors are left, the edges of copies, and with them one span of each
   other rank. Their bytes are looked up once. ``STEP`` starts at a like distance from the anchor share a
   core that all their strings hold and have a hull that holds them all. If the rank of the core is unique,
   none of them repeats; if that of the hull is not, all do.
4. The starts that are still open, with those of one hull of each other rank, get the pair (rank of 100
   bytes, rank at offset 100), which is the rank of 200 bytes.

Every round is a Spark job over positions and ranks at a longer reach. Groups are counted before rows
meet (partial aggregation), and rows find the counts through joins with one row for a rank. The counts
are written tables, so both sides of such a join are dealt out for it and adaptive execution can split
a hot rank. No pairs of positions are formed.

Nulls and ties: a null text is empty. Rows that share doc_id and text are separate rows here: all
their strings repeat. Null doc_ids are kept. Texts under 200 bytes are kept whole. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import materialize

LENGTH, GRAM = 200, 64
HALF = LENGTH // 2
STEP = 16  # starts that share a core and a hull
BLOCK_BYTES = 3 * 512 * 1024  # of text held as arrays of numbers at a time

#: Fixed value: an odd multiplier of the rolling hash (modulo 2**64).
BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i below 2**bits."""
    n = 1 << bits
    with np.errstate(over="ignore"):
        up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of all substrings of a run of bytes in constant time."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _powers(max(21, int(len(data)).bit_length()))
        with np.errstate(over="ignore"):
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)])))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        with np.errstate(over="ignore"):
            return _mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach:])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of texts laid end to end: text number, anchor, first and last start tied to it, gram rank, span rank."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none, none
    hashes = Hashes(data)
    grams = hashes.grams(GRAM)
    bits = np.uint64(max(24, int(len(grams)).bit_length()))
    coded = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)  # least gram, leftmost if several
    least = (sliding_min(coded, LENGTH - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    begins = np.concatenate(([0], ends[:-1]))
    text = np.repeat(np.arange(len(ends)), ends - begins)[: len(least)]
    valid = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends[text])
    if not len(valid):
        return none, none, none, none, none, none
    new = np.concatenate(([True], (np.diff(valid) > 1) | (np.diff(least[valid]) != 0)))
    first = valid[new]
    last = valid[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(valid) - 1]))]
    at = least[first]
    with np.errstate(over="ignore"):
        span = hashes.of(first, last + LENGTH) + _mix((at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64))
    own = begins[text[first]]
    return text[first], at - own, first - own, last - own, grams[at].view(np.int64), span.view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in blocks of about ``BLOCK_BYTES``: rows, their bytes in a row and where each text ends."""
    for batch in batches:
        texts = batch.column("text")
        width = np.dtype(np.int64 if pa.types.is_large_string(texts.type) else np.int32)
        offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset: texts.offset + batch.num_rows + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        block = (offsets[1:] - offsets[0]) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a), data[offsets[a]: offsets[b]], offsets[a + 1: b + 1] - offsets[a]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, ends in _blocks(batches):
        text, at, first, last, gram, span = anchors(data, ends)
        number = pa.array(text)
        place = first << 16 | (at - first) << 8 | (last - first)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(number), rows.column("text_key").take(number), pa.array(place), pa.array(gram), pa.array(span)],
                                         ["doc_id", "text_key", "place", "gram", "span"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each listed span with ``STEP - 1`` more at both sides, where the text has them."""
    for batch in batches:
        columns: list[list] = [[], [], [], [], [], []]
        for doc_id, key, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "spans")), strict=True):
            data = text.encode()
            for span in spans:
                first, width = span["place"] >> 16, span["place"] & 0xFF
                begin = max(0, first - STEP + 1)
                own = (doc_id, key, span["place"], span["single"], begin, data[begin: first + width + LENGTH + STEP - 1])
                for column, value in zip(columns, own, strict=True):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "text_key", "place", "single", "begin", "bytes"])


def _laid_out(batch: pa.RecordBatch) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts end to end: their hashes, where each begins and ends, its anchor, its first and last start."""
    held = batch.column("bytes").to_pylist()
    ends = np.cumsum([len(b) for b in held])
    begins = np.concatenate(([0], ends[:-1]))
    place, begin = batch.column("place").to_numpy(), batch.column("begin").to_numpy()
    first = begins + (place >> 16) - begin
    return Hashes(np.frombuffer(b"".join(held), np.uint8)), begins, ends, first + (place >> 8 & 0xFF), first, first + (place & 0xFF)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each span in steps of starts: the ranks of core and hull. A hull that leaves the text has no rank."""
    for batch in _parts(batches):
        hashes, begins, ends, anchor, first, last = _laid_out(batch)
        least, most = (anchor - last) // STEP, (anchor - first) // STEP
        many = most - least + 1
        row = np.repeat(np.arange(len(many)), many)
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + least[row]
        near, far = anchor[row] - STEP * step, anchor[row] - STEP * step - STEP + 1  # the last and the first start of a step
        with np.errstate(over="ignore"):
            core = hashes.of(near, far + LENGTH) + _mix(step.astype(np.uint64))
            inside = (far >= begins[row]) & (near + LENGTH <= ends[row])
            hull = hashes.of(np.maximum(far, 0), np.minimum(near + LENGTH, len(hashes.sums) - 1)) + _mix(step.astype(np.uint64))
        number = pa.array(row)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(number) for c in ("doc_id", "text_key", "place", "single")), pa.array(step),
                                          pa.array(core.view(np.int64)), pa.array(hull.view(np.int64), mask=~inside)],
                                         ["doc_id", "text_key", "place", "single", "step", "core", "hull"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The starts of each listed step with their pairs of ranks."""
    for batch in _parts(batches):
        hashes, begins, _, anchor, first, last = _laid_out(batch)
        step = batch.column("step").to_numpy()
        near, far = np.minimum(anchor - STEP * step, last), np.maximum(anchor - STEP * step - STEP + 1, first)
        many = near - far + 1
        row = np.repeat(np.arange(len(many)), many)
        here = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + far[row]
        number = pa.array(row)
        start = here - begins[row] + batch.column("begin").to_numpy()[row]
        ranks = [pa.array(hashes.of(here + o, here + o + HALF).view(np.int64)) for o in (0, HALF)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(number) for c in ("doc_id", "text_key")), pa.array(start), batch.column("open").take(number), *ranks],
                                         ["doc_id", "text_key", "start", "open", "rank", "rank_next"])


def covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they touch or overlap."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))]


def _removals(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text").to_pylist(), batch.column("spans")
            offsets, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
            starts, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            columns: list[list] = [[], [], [], [], []]
            for i, text in enumerate(texts):
                data = text.encode()
                a, b = offsets[i], offsets[i + 1]
                gone, spans, kept = 0, 0, data
                if b > a:
                    from_, to = covered(starts[a:b], ends[a:b])
                    gone, spans = int((to - from_).sum()), len(from_)
                    edges = [0, *np.stack((from_, to), 1).ravel().tolist(), len(data)]
                    kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(columns, (len(data), gone, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None), strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _same_text(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and a text_key that is needed only where doc_ids repeat."""
    ids = docs.groupBy("doc_id").count().agg(F.max("count").alias("most")).first()["most"] or 0
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), (F.xxhash64(text) if ids > 1 else F.lit(0).cast("long")).alias("text_key"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``end`` in bytes; spans may overlap."""
    ranked = docs.mapInArrow(_anchor_rows, "doc_id long, text_key long, place long, gram long, span long")
    grams = materialize(ranked.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "grams")
    repeated = materialize(ranked.join(grams, "gram"), "anchors")
    spans = repeated.groupBy("gram", "span").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_key", "place")).alias("one"))
    spans = materialize(spans, "spans")
    mixed = spans.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("gram")
    edges = spans.join(mixed, "gram").select("one.*", (F.col("n") == 1).alias("single"))
    edges = edges.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("place", "single")).alias("spans"))
    contexts = (docs.join(edges, _same_text(docs, edges)).select(docs["doc_id"], docs["text_key"], "text", "spans")
                .mapInArrow(_contexts, "doc_id long, text_key long, place long, single boolean, begin long, bytes binary"))
    start = F.shiftright("place", 16)
    whole = repeated.join(spans.where("n > 1").select("gram", "span"), ["gram", "span"])
    whole = whole.select("doc_id", "text_key", start.alias("start"), (start + F.col("place").bitwiseAND(0xFF) + LENGTH).alias("end"))
    return whole.union(repeated_at_edges(materialize(contexts, "contexts")))


def repeated_at_edges(contexts: DataFrame) -> DataFrame:
    """Repeated spans among the strings of ``contexts`` that are not known to repeat."""
    steps = contexts.mapInArrow(_steps, "doc_id long, text_key long, place long, single boolean, step long, core long, hull long")
    steps = materialize(steps, "steps")
    alike = materialize(steps.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "cores")
    steps = steps.join(alike, "core")
    own = F.xxhash64("doc_id", "text_key", "place", "step")  # a step without a hull is a kind of its own
    steps = materialize(steps.withColumn("kind", F.coalesce("hull", own)), "steps")
    kinds = steps.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_key", "place", "step", "single")).alias("one"))
    kinds = materialize(kinds, "kinds")
    anchor = F.shiftright("place", 16) + F.shiftright("place", 8).bitwiseAND(0xFF)
    near, far = anchor - STEP * F.col("step"), anchor - STEP * F.col("step") - STEP + 1
    first, last = F.shiftright("place", 16), F.shiftright("place", 16) + F.col("place").bitwiseAND(0xFF)
    hulls = steps.where("single").join(kinds.where("n > 1").select("kind"), "kind")
    hulls = hulls.select("doc_id", "text_key", F.greatest(far, first).alias("start"), (F.least(near, last) + LENGTH).alias("end"))
    listed = kinds.select("one.*", (F.col("one.single") & (F.col("n") == 1)).alias("open")).drop("single")
    same = _same_text(contexts, listed) & (contexts["place"] == listed["place"])
    pairs = (contexts.join(listed, same).select(contexts["doc_id"], contexts["text_key"], contexts["place"], "begin", "bytes", "step", "open")
             .mapInArrow(_pairs, "doc_id long, text_key long, start long, open boolean, rank long, rank_next long"))
    pairs = materialize(pairs, "pairs")
    same = materialize(pairs.groupBy("rank", "rank_next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rank", "rank_next"), "strings")
    strings = pairs.where("open").join(same, ["rank", "rank_next"])
    return hulls.union(strings.select("doc_id", "text_key", "start", (F.col("start") + LENGTH).alias("end")))


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if asked for, the kept bytes."""
    texts = _texts(docs)
    spans = repeated_spans(texts).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = texts.join(spans, _same_text(texts, spans), "left").select(texts["doc_id"], "text", F.coalesce("spans", none).alias("spans"))
    kept = joined.mapInArrow(_removals(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return kept if keep_text else kept.drop("kept")
