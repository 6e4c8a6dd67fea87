"""SimHash near-duplicates, found with keys from a Golay code.

A fingerprint has 64 bits; two link at ``DISTANCE`` = 3 or fewer differing bits. A fingerprint has two
halves, and of two linked fingerprints one half differs in at most one bit. A half is a 23-bit word
of the perfect binary Golay code and 9 more bits. If the differing bit is in the word, the two words
share a codeword among those that the word and its 23 neighbours decode to (one or six), and the 9
bits agree; otherwise the words agree. The other half differs in at most three bits, so one of its
four bytes agrees. Hence the keys (half, codeword, 9 bits, byte) and (half, word, byte): 8 to 56 for a
fingerprint, no link is missed, and a key has about 30 bits, so that buckets stay small.

Only distinct fingerprints get keys: exact copies cost one counted row. Within a bucket links are
verified, and from a large bucket only the links of a spanning forest are returned, which keeps
every component and never emits all pairs.

Nulls and ties: a null text is empty and has fingerprint zero, which links like any other; a null
doc_id keeps its row and never names a component unless all its members are null; repeated rows
each get their row. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import keyed_texts, materialize, slices

DISTANCE = 3
SEED = 42
SMALL_BUCKET = 32  # up to here all pairs of a bucket are compared side by side

#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011


def fingerprint_rows(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id``, ``text_key`` and the fingerprint (a long with the 64 bits) of every row."""
    texts = keyed_texts(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_fingerprinter(size), f"doc_id {kind}, text_key long, fingerprint long")


def fingerprint(text: str, size: int = 3) -> int:
    """64 bits, each set if it is set in over half of the hashes of the shingles."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    n = max(1, len(words) - size + 1)
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprinter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "text")):
            prints = np.array([fingerprint(t, size) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(prints.view(np.int64))],
                                             ["doc_id", "text_key", "fingerprint"])

    return run


class Golay:
    """Decoding of 23-bit words to the 12-bit number of their only codeword within three bits."""

    def __init__(self):
        high = np.arange(1 << 12, dtype=np.int64) << 11
        for bit in range(22, 10, -1):
            high = np.where(high >> bit & 1, high ^ (GOLAY << (bit - 11)), high)
        self.syndrome = high  # of the upper 12 bits; the lower 11 are their own
        self.error = np.zeros(1 << 11, np.int64)
        single = 1 << np.arange(23)
        pairs = np.bitwise_or.outer(single, single).ravel()
        errors = np.unique(np.concatenate(([0], single, pairs, np.bitwise_or.outer(pairs, single).ravel())))
        self.error[self._of(errors)] = errors

    def _of(self, words: np.ndarray) -> np.ndarray:
        return self.syndrome[words >> 11] ^ (words & 0x7FF)

    def decode(self, words: np.ndarray) -> np.ndarray:
        return (words ^ self.error[self._of(words)]) >> 11

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codewords of each word and its 23 neighbours: positions in ``words`` and codeword numbers, distinct."""
        near = np.sort(self.decode(words[:, None] ^ np.concatenate(([0], 1 << np.arange(23)))), axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        at, column = np.nonzero(new)
        return at, near[at, column]


def bucket_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``prints`` (uint64) and their keys."""
    halves = (prints & np.uint64(0xFFFFFFFF)).astype(np.int64), (prints >> np.uint64(32)).astype(np.int64)
    positions, keys = [], []
    for side in (0, 1):
        word, rest, other = halves[side] & 0x7FFFFF, halves[side] >> 23, halves[1 - side]
        at, code = golay.near(word)
        for byte in range(4):
            tail = (other >> 8 * byte & 0xFF) | byte << 8 | side << 10
            positions += [at, np.arange(len(prints))]
            keys += [(code << 9 | rest[at]) << 11 | tail[at], 1 << 40 | word << 11 | tail]
    return np.concatenate(positions), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    golay = Golay()
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy()
        at, keys = bucket_keys(prints.view(np.uint64), golay)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[at])], ["key", "fingerprint"])


def forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of all links among distinct fingerprints."""
    left, a, b = prints, [], []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            hit = np.bitwise_count(left ^ at) <= DISTANCE
            if hit.any():
                found = left[hit]
                left = left[~hit]
                a.append(np.full(len(found), at))
                b.append(found)
                frontier += list(found)
    none = np.zeros(0, prints.dtype)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def bucket_links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets; ``keys`` ascends, fingerprints within a key are distinct."""
    starts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    a, b = [], []
    small = np.repeat(sizes, sizes) <= SMALL_BUCKET
    k, p = keys[small], prints[small]
    for shift in range(1, SMALL_BUCKET):
        same = np.flatnonzero(k[shift:] == k[:-shift])
        if not len(same):
            break
        hit = same[np.bitwise_count(p[same] ^ p[same + shift]) <= DISTANCE]
        a.append(p[hit])
        b.append(p[hit + shift])
    for i in np.flatnonzero(sizes > SMALL_BUCKET):
        one, two = forest(prints[starts[i]: starts[i] + sizes[i]])
        a.append(one)
        b.append(two)
    none = np.zeros(0, prints.dtype)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        keys = np.concatenate((keys, batch.column("key").to_numpy()))
        prints = np.concatenate((prints, batch.column("fingerprint").to_numpy().view(np.uint64)))
        whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last bucket may go on
        yield _link_batch(keys[:whole], prints[:whole])
        keys, prints = keys[whole:], prints[whole:]
    yield _link_batch(keys, prints)


def _link_batch(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    a, b = (x.view(np.int64) for x in bucket_links(keys, prints))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def links(distinct_prints: DataFrame) -> DataFrame:
    """Links (a < b) among distinct fingerprints that keep all components."""
    keys = distinct_prints.mapInArrow(_keys, "key long, fingerprint long")
    return (keys.repartition("key").sortWithinPartitions("key", "fingerprint")
            .mapInArrow(_links, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of an edge (a, b).

    Alternates two steps until the edges stand still: every node hands its larger neighbours to the
    least one, then its smaller neighbours. The edges of each round are a written table.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialize(large.distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", "m"))
        edges = materialize(small.distinct(), "edges")
        mark, before = _mark(edges), mark
        if mark == before:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def classified(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id``, ``text_key``, ``fingerprint`` and ``root`` of every row; rows of one component share the root."""
    prints = materialize(fingerprint_rows(docs, size), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    roots = components(links(materialize(distinct, "distinct").select("fingerprint")))
    joined = prints.join(roots, prints["fingerprint"] == roots["node"], "left")
    return joined.select("doc_id", "text_key", "fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``."""
    rows = materialize(classified(docs, size), "classified")
    named = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(named, "root").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, size: int = 3) -> DataFrame:
    """The first row of each component, by doc_id and then by text_key, with all its columns."""
    return first_of_each(docs, classified(docs, size))


def first_of_each(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The first of the ``rows`` (doc_id, text_key, root) of each root, with all columns of ``docs``."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    kept = rows.groupBy("root").agg(first).select("first.doc_id", "first.text_key", F.lit(True).alias("kept"))
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    joined = whole.join(kept, whole["id"].eqNullSafe(kept["doc_id"]) & (whole["key"] == kept["text_key"]))
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy(F.lit(0)))  # equal rows: one stays
    return joined.select("row", place.alias("place")).where("place = 1").select("row.*")
