"""Ranked lexical search of all documents for each of a set of items.

A score needs of a document only how often it holds each term of the items and its length class m. So documents are
restricted to the items' vocabulary, which makes many of them equal: rows with the same bag (terms with their
frequencies) and the same m are one class, found by a 64-bit hash and verified by comparing the bags themselves. A class
is scored once for every item that shares a term with it, through the lists of items of each term. Its members
then get its score, by ascending doc_id; as an item returns its ``k`` best, a class keeps its ``k`` smallest doc_ids
(cut off in every task before rows are dealt out, so a class of any size costs a task ``k`` rows), and only the ``k``
best classes of an item by score and smallest doc_id can hold one of its documents.

Items come in blocks of about ``BLOCK_CHARS`` characters, written to the shared folder and loaded by the tasks, with one pass
over the documents for all blocks. All but the logarithm is integer arithmetic.

Nulls and ties: a null or empty text has no terms, and neither has an item with one, which gives no rows. Equal scores go by
ascending doc_id, null last; rows with one doc_id are documents of their own. Items that share an item_id but not their
text are ranked separately, repeated rows of one item once. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import materialize, new_folder, read_block, slices, write_blocks
from dimweave.llm.tokens import ragged

BLOCK_CHARS = 4_000_000  # of items that a task holds at a time
GROUP_SLICES = 32  # of texts that meet one block after the other, where there are several
SCORES = 4_000_000  # scores that a task holds at a time

#: Bytes of terms (ASCII letters and digits, and all of other characters) as lower case, any other byte as a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256))

_BAGS = "block int, doc_id long, n long, terms array<int>, tfs array<int>"
_FOUND = "item long, item_id long, score long, ids array<long>"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return (text or "").encode().translate(_TERM_BYTES).split()


class Items:
    """The items of one block: a number for each term, and the items that hold it."""

    def __init__(self, rows: list[tuple]):
        self.ids = [item_id for item_id, _ in rows]
        self.words: dict[bytes, int] = {}
        holders: list[list[int]] = []
        for k, (_, text) in enumerate(rows):
            for word in sorted(set(terms(text))):
                number = self.words.setdefault(word, len(holders))
                if number == len(holders):
                    holders.append([])
                holders[number].append(k)
        self.sizes = np.fromiter(map(len, holders), np.int64, len(holders))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.holders = np.fromiter(chain.from_iterable(holders), np.int64, int(self.sizes.sum()))


@lru_cache(maxsize=2)
def load_items(folder: str, block: int) -> Items:
    rows = read_block(folder, block)
    if rows is None:
        return Items([])
    pairs = set(zip(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), strict=True))
    return Items(sorted(pairs, key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` documents with the highest scores above 0 for each item."""
    spark = docs.sparkSession
    folder, blocks = write_blocks(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), "items", BLOCK_CHARS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    bags = materialize(texts.mapInArrow(_bagger(folder, blocks), _BAGS), "bags")
    n_docs, n_terms = bags.where("block = 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    bags = bags.where(F.size("terms") > 0)
    held = new_folder(spark, "frequencies")
    (bags.select("block", F.explode("terms").alias("term")).groupBy("block", "term").agg(F.count(F.lit(1)).alias("df"))
     .repartition("block").write.partitionBy("block").parquet(held))  # as many rows as the items have terms at most
    found = classes(bags, n_docs, n_terms or 1, k).mapInArrow(_scorer(folder, held, n_docs, k), _FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("ids")[0].asc_nulls_last())
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    members = found.select("item", "item_id", "score", F.explode("ids").alias("doc_id"))
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return members.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``block``, ``m``, ``terms``, ``tfs`` and the ``k`` smallest doc_ids, in order, of every class of equal rows."""
    m = F.lit(50) + F.expr(f"(cast(50 * n as decimal(20,0)) * {n_docs}) div {n_terms}").cast("long")
    same = ["hash", "block", "m", "terms", "tfs"]
    rows = bags.withColumn("m", m).withColumn("hash", F.xxhash64("block", "m", "terms", "tfs"))
    place = F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last()))
    members = rows.withColumn("place", place).where(F.col("place") <= k)
    ids = F.sort_array(F.collect_list(F.struct("place", "doc_id")))
    return materialize(members.groupBy(*same).agg(ids.alias("ids")).select("block", "m", "terms", "tfs", F.col("ids.doc_id").alias("ids")), "classes")


def _bagger(folder: str, blocks: int):
    """Bags of all texts with a term; rows of other blocks than the first only where they share a term with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in (s for b in batches for s in slices(b, "text")):
            words = [terms(t) for t in batch.column("text").to_pylist()]
            group.append((batch.column("doc_id"), words))
            if blocks == 1 or len(group) == GROUP_SLICES:
                yield from (_bags(block, *own, load_items(folder, block)) for block in range(blocks) for own in group)
                group = []
        yield from (_bags(block, *own, load_items(folder, block)) for block in range(blocks) for own in group)

    return run


def _bags(block: int, keys: pa.Array, words: list[list[bytes]], items: Items) -> pa.RecordBatch:
    n = np.fromiter(map(len, words), np.int64, len(words))
    number = np.fromiter(map(items.words.get, chain.from_iterable(words), repeat(-1)), np.int64, int(n.sum()))
    row = np.repeat(np.arange(len(words)), n)[number >= 0]
    entries, tfs = np.unique(row << 32 | number[number >= 0], return_counts=True)
    sizes = np.bincount(entries >> 32, minlength=len(words))
    kept = np.flatnonzero(n > 0 if block == 0 else sizes > 0)
    bounds = pa.array(np.concatenate(([0], np.cumsum(sizes[kept]))), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), block), pa.int32()), keys.take(pa.array(kept)), pa.array(n[kept]),
                                       pa.ListArray.from_arrays(bounds, pa.array(entries & 0xFFFFFFFF, pa.int32())),
                                       pa.ListArray.from_arrays(bounds, pa.array(tfs, pa.int32()))], [c.split()[0] for c in _BAGS.split(", ")])


@lru_cache(maxsize=2)
def load_weights(folder: str, held: str, block: int, n_docs: int) -> np.ndarray:
    """The weight of each term of a block."""
    weights = np.zeros(len(load_items(folder, block).words), np.int64)
    rows = read_block(held, block)
    if rows is not None:
        weights[rows.column("term").to_numpy()] = [weight(n_docs, df) for df in rows.column("df").to_pylist()]
    return weights


class Best:
    """The ``k`` best classes of each item among those seen, by score and then by smallest doc_id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.members: list[list] = []

    def add(self, scores: np.ndarray, ids: pa.ListArray) -> None:
        """``scores``: a row for each class, a column for each item; ``ids``: members of each class."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        own = ids.take(pa.array(row)).to_pylist()
        last = np.iinfo(np.int64).max
        self.members += own
        self.item, self.score = np.concatenate((self.item, item)), np.concatenate((self.score, scores[row, item]))
        self.first = np.concatenate((self.first, [last if i[0] is None else i[0] for i in own]))
        if len(self.item) > 4 * self.k * len(self.least):
            self.prune()

    def prune(self) -> None:
        order = np.lexsort((self.first, -self.score, self.item))
        ranked = self.item[order]
        place = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        full = order[place == self.k - 1]
        self.least[self.item[full]] = self.score[full]
        order = order[place < self.k]
        self.members = [self.members[i] for i in order.tolist()]
        self.item, self.score, self.first = self.item[order], self.score[order], self.first[order]


def _scorer(folder: str, held: str, n_docs: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            for block in np.unique(blocks).tolist():
                items = load_items(folder, block)
                weights = load_weights(folder, held, block, n_docs)
                own = batch.filter(pa.array(blocks == block))
                state = best.setdefault(block, Best(len(items.ids), k))
                step = max(1, SCORES // max(1, len(items.ids)))
                for at in range(0, own.num_rows, step):
                    some = own.slice(at, step)
                    state.add(scores(some, items, weights), some.column("ids"))
        for block, state in best.items():
            state.prune()
            names = load_items(folder, block).ids
            yield pa.RecordBatch.from_arrays([pa.array(state.item + (block << 32)), pa.array([names[i] for i in state.item.tolist()], pa.int64()), pa.array(state.score),
                                              pa.array(state.members, pa.list_(pa.int64()))], ["item", "item_id", "score", "ids"])

    return run


def scores(classes: pa.RecordBatch, items: Items, weights: np.ndarray) -> np.ndarray:
    """A row for each class, a column for each item of the block."""
    term, tf = classes.column("terms").flatten().to_numpy(), classes.column("tfs").flatten().to_numpy().astype(np.int64)
    lengths = classes.column("terms").value_lengths().to_numpy()
    m = np.repeat(classes.column("m").to_numpy(), lengths)
    value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
    row = np.repeat(np.arange(classes.num_rows), lengths)
    times = items.sizes[term]
    total = np.zeros(classes.num_rows * len(items.ids), np.int64)
    np.add.at(total, np.repeat(row * len(items.ids), times) + items.holders[ragged(items.starts[term], times)], np.repeat(value, times))
    return total.reshape(classes.num_rows, -1)
