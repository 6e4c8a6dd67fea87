"""Approximate nearest neighbours by cosine with a forest of random-projection trees.

**Forest.** All nodes of a level of a tree project on one direction, which joins two random vectors of the sample; a
node's threshold is the median of its own sample. So a tree is its directions and a threshold for each node, and the forest's size
is bounded by ``SAMPLE``, a sample by hash. The depth follows the number of rows: leaves of about
``LEAF_ROWS`` rows as long as the sample has ``LEAF_SAMPLE`` vectors for each leaf.

**Search.** Each query has one priority queue over the nodes of all trees. A node's priority is the least margin on the way to it (how far the
query is on the node's side of a hyperplane; negative on the other side). The queue gives leaves until the budget is reached, a
number of leaves. Queries and rows meet by leaf: both are shuffled on (leaf, part), where a leaf of more than ``PART_ROWS`` rows or
queries is split into parts by hash, and each part ranks its rows exactly. No query and no row passes the driver; the plan
does not depend on their number, and only leaves that some query asks for are shuffled.

**Budget.** ``PROBES`` queries by hash are compared with every row in one pass; the budget is the least number of leaves in which
``RECALL`` of their true neighbours lie. So it is measured against brute force on the very table, and is small where
vectors have structure. On vectors without any, where all directions are equally likely, no forest prunes much and it is large.

Equal vectors are one entry with its smallest vec_ids, as many as an answer can hold; so copies make no hot leaf
and none is lost.

Vectors that are null, zero, not of the usual length or that hold null or non-finite components take no
part, nor do null vec_ids. Equal rows are one. Rows that share a vec_id are candidates with each of their vectors, but never
for each other, and ask as one query: a candidate is as near as it is to the nearest of them. Ties go to the smaller vec_id. A table of fewer
candidates gives all of them; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from dimweave.llm.common import materialize, spread

TREES = 3
LEAF_ROWS, LEAF_SAMPLE = 1024, 16
PART_ROWS = 4096  # rows or queries of a leaf that a task is given at a time
SAMPLE = 40_000
PROBES, RECALL = 200, 0.97
ROW_BLOCK = 2048  # bounds the arrays that a task holds at a time
NEAR = 1e-9  # scores from matrix products that are closer than this are computed again one by one

_FOUND = "query_id long, vec_id long, vector_key long, score double"


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@dataclass
class Forest:
    directions: np.ndarray  # tree, level, component
    thresholds: np.ndarray  # tree, node
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, trees: int = TREES, seed: int = 7) -> Forest:
        rng = np.random.default_rng(seed)
        wanted, possible = np.log2(max(1, rows / LEAF_ROWS)), np.log2(max(1, len(sample) / LEAF_SAMPLE))
        depth = max(0, min(int(np.ceil(wanted)), int(possible)))
        directions, thresholds = np.zeros((trees, depth, sample.shape[1])), np.zeros((trees, (1 << depth) - 1))
        for tree in range(trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                a, b = sample[rng.choice(len(sample), 2, replace=False)]
                directions[tree, level] = unit((a - b)[None])[0] if (a != b).any() else a
                side = sample @ directions[tree, level]
                order = np.lexsort((side, node))
                bounds = np.searchsorted(node[order], np.arange((1 << level) + 1))
                for n in range(1 << level):
                    own = side[order[bounds[n]: bounds[n + 1]]]
                    thresholds[tree, (1 << level) - 1 + n] = (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2 if len(own) else 0.0
                node = 2 * node + (side > thresholds[tree, (1 << level) - 1 + node])
        return cls(directions, thresholds, depth)

    @property
    def leaves(self) -> int:
        return len(self.thresholds) << self.depth

    def sides(self, rows: np.ndarray) -> np.ndarray:
        """Place of each row on the direction of each tree and level."""
        return np.einsum("tld,rd->rtl", self.directions, rows)

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree; leaves of all trees are numbered in one series."""
        sides, trees = self.sides(rows), np.arange(len(self.thresholds))
        node = np.zeros((len(rows), len(trees)), np.int64)
        for level in range(self.depth):
            node = 2 * node + (sides[:, :, level] > self.thresholds[trees, (1 << level) - 1 + node])
        return node + (trees << self.depth)

    def nearest_leaves(self, sides: np.ndarray, budget: int) -> list[int]:
        """The first ``budget`` leaves of one query's queue over the nodes of all trees."""
        queue = [(-np.inf, tree, 0, 0) for tree in range(len(self.thresholds))]
        found: list[int] = []
        while queue and len(found) < budget:
            lost, tree, level, node = heapq.heappop(queue)
            if level == self.depth:
                found.append((tree << self.depth) + node)
                continue
            margin = float(sides[tree, level] - self.thresholds[tree, (1 << level) - 1 + node])
            heapq.heappush(queue, (max(lost, margin), tree, level + 1, 2 * node))
            heapq.heappush(queue, (max(lost, -margin), tree, level + 1, 2 * node + 1))
        return found


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _array(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), float).reshape(-1, size)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, ROW_BLOCK) for b in batches for at in range(0, b.num_rows, ROW_BLOCK))


def search(vectors: DataFrame, is_query: Column, k: int = 5, recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found for each row where ``is_query``."""
    given = vectors.schema["embedding"].dataType
    kind = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    asking = F.coalesce(is_query, F.lit(False)).alias("asking")
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("vector"), asking)
    valid = valid.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    usual = valid.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    none = valid.where("false").select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    if usual is None:
        return none
    size = usual["size"]
    valid = valid.where(F.size("vector") == size)
    queries = materialize(valid.where("asking").select("vec_id", "vector").distinct(), "asking")
    entries = materialize(_entries(valid, k), "entries")
    rows = entries.count()
    sample = _part_by_hash(entries, ["vector"], rows, SAMPLE).orderBy("vector_key", "vector").select("vector").toArrow()
    forest = Forest.fit(unit(_array(sample["vector"], size)), rows)
    probes = _part_by_hash(queries, ["vec_id", "vector"], queries.count(), PROBES).select("vec_id", "vector").toArrow()
    if not probes.num_rows:
        return none
    budget = _budget(forest, entries, probes, size, k, recall)

    row_counts = _counts(entries.mapInArrow(_leaves_of_rows(forest, size), "leaf int"), forest)
    asks = materialize(queries.mapInArrow(_leaves_of_queries(forest, size, budget), f"vec_id long, vector array<{kind}>, leaves array<int>"), "asks")
    ask_counts = _counts(asks.select(F.explode("leaves").alias("leaf")), forest)
    row_parts, ask_parts = (np.maximum(1, -(-c // PART_ROWS)) * (ask_counts > 0) for c in (row_counts, ask_counts))

    where = "leaf int, part int, ask_part int"
    left = entries.mapInArrow(_dealt_rows(forest, size, row_parts, ask_parts), f"{where}, ids array<long>, vector array<{kind}>, vector_key long")
    right = asks.mapInArrow(_dealt_queries(size, row_parts, ask_parts), f"{where}, query_id long, query array<{kind}>")
    met = left.groupBy("leaf", "part", "ask_part").cogroup(right.groupBy("leaf", "part", "ask_part")).applyInArrow(_ranker(size, k), _FOUND)
    found = met.repartition(spread(vectors), "query_id").groupBy("query_id", "vec_id", "vector_key").agg(F.max("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "vector_key")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _entries(valid: DataFrame, k: int) -> DataFrame:
    """A row for each distinct vector with its k + 1 smallest vec_ids: whichever of them asks, k others are left."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    first = valid.select("vec_id", "vector").distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("vector_key", F.xxhash64("vector"))


def _part_by_hash(df: DataFrame, columns: list[str], rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the rows (all, if there are fewer), which differ in ``columns``; the same in every run."""
    return df.where(F.pmod(F.xxhash64(F.lit("part"), *columns), F.lit(1 << 40)) < int((1 << 40) * min(1.0, wanted / max(1, rows))) + 1)


def _counts(leaves: DataFrame, forest: Forest) -> np.ndarray:
    """Number of rows for each leaf; as many numbers as the forest has leaves reach the driver."""
    counts = np.zeros(forest.leaves, np.int64)
    for leaf, n in leaves.groupBy("leaf").count().collect():
        counts[leaf] = n
    return counts


def _budget(forest: Forest, entries: DataFrame, probes: pa.Table, size: int, k: int, recall: float) -> int:
    """The least number of leaves in which ``recall`` of the probes' true neighbours lie, by one pass over all entries."""
    own, ids = unit(_array(probes["vector"], size)), np.asarray(probes["vec_id"])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            rows = unit(_array(batch.column("vector"), size))
            scores = _without_own(own @ rows.T, ids, batch.column("ids"))
            some = min(k, len(rows))
            top = np.argpartition(-scores, some - 1, axis=1)[:, :some]
            leaves = forest.leaf_of(rows).astype(np.int32)[top.ravel()]
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(leaves) + 1) * leaves.shape[1], pa.int32()), pa.array(leaves.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(own)), some), pa.int32()), pa.array(np.take_along_axis(scores, top, axis=1).ravel()), listed],
                                             ["probe", "score", "leaves"])

    best = Window.partitionBy("probe").orderBy(F.desc("score"))
    found = entries.mapInArrow(nearest, "probe int, score double, leaves array<int>").where(F.col("score") > -2)
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).select("probe", "leaves").collect()  # k rows for a probe
    turns = [{leaf: at for at, leaf in enumerate(forest.nearest_leaves(s, forest.leaves), 1)} for s in forest.sides(own)]
    reached = np.sort([min(turns[r["probe"]][leaf] for leaf in r["leaves"]) for r in found])
    return int(reached[min(len(reached), int(np.ceil(recall * len(reached)))) - 1]) if len(reached) else 1


def _without_own(scores: np.ndarray, asking: np.ndarray, ids: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """-inf where an entry has no vec_id but the query's own."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    first, alone = np.asarray(pa.compute.list_element(ids, 0)), np.asarray(pa.compute.list_value_length(ids)) == 1
    return np.where((asking[:, None] == first[None]) & alone[None], -np.inf, scores)


def _leaves_of_rows(forest: Forest, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(forest.leaf_of(unit(_array(batch.column("vector"), size))).ravel(), pa.int32())], ["leaf"])

    return run


def _leaves_of_queries(forest: Forest, size: int, budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            leaves = [forest.nearest_leaves(s, budget) for s in forest.sides(unit(_array(batch.column("vector"), size)))]
            yield pa.RecordBatch.from_arrays([*batch.select(["vec_id", "vector"]).columns, pa.array(leaves, pa.list_(pa.int32()))], ["vec_id", "vector", "leaves"])

    return run


def _hashed(rows: np.ndarray) -> np.ndarray:
    """A number for each vector that decides its part."""
    bits = np.ascontiguousarray(rows + 0.0).view(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (bits * np.arange(1, 2 * bits.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum(axis=1, dtype=np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(33)).astype(np.int64)


def _copies(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element as many copies as ``parts`` says: the element's place and the copy's number."""
    at = np.repeat(np.arange(len(parts)), parts)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)


def _dealt_rows(forest: Forest, size: int, row_parts: np.ndarray, ask_parts: np.ndarray):
    """Each row once for each tree and each part of the queries that ask for its leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            rows = _array(batch.column("vector"), size)
            hashed = _hashed(rows)
            for leaves in forest.leaf_of(unit(rows)).T:
                at, ask_part = _copies(ask_parts[leaves])
                leaf = leaves[at]
                part = hashed[at] % np.maximum(1, row_parts[leaf])
                own = batch.select(["ids", "vector", "vector_key"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(part, pa.int32()), pa.array(ask_part, pa.int32()), *own.columns],
                                                 ["leaf", "part", "ask_part", "ids", "vector", "vector_key"])

    return run


def _dealt_queries(size: int, row_parts: np.ndarray, ask_parts: np.ndarray):
    """Each query once for each leaf of its queue and each part of the leaf's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 64) for b in batches for at in range(0, b.num_rows, 64)):
            hashed = _hashed(np.column_stack((_array(batch.column("vector"), size), np.asarray(batch.column("vec_id")))))
            leaf = np.asarray(batch.column("leaves").flatten())
            query = np.repeat(np.arange(batch.num_rows), np.asarray(pa.compute.list_value_length(batch.column("leaves"))))
            at, part = _copies(row_parts[leaf])
            query, leaf = query[at], leaf[at]
            own = batch.take(pa.array(query))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(part, pa.int32()), pa.array(hashed[query] % np.maximum(1, ask_parts[leaf]), pa.int32()),
                                              own.column("vec_id"), own.column("vector")], ["leaf", "part", "ask_part", "query_id", "query"])

    return run


def _ranker(size: int, k: int):
    """The k nearest candidates of each query among the rows of a part."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if rows.num_rows and queries.num_rows:
            vectors, asking, own = unit(_array(rows["vector"], size)), np.asarray(queries["query_id"]), unit(_array(queries["query"], size))
            ids, keys = rows["ids"].to_pylist(), np.asarray(rows["vector_key"])
            some = min(k, len(vectors))
            for at in range(0, len(own), 256):
                scores = _without_own(own[at: at + 256] @ vectors.T, asking[at: at + 256], rows["ids"])
                least = -np.partition(-scores, some - 1, axis=1)[:, some - 1] - NEAR
                for q in range(len(scores)):
                    near = np.flatnonzero((scores[q] >= least[q]) & (scores[q] > -np.inf))
                    exact = (vectors[near] * own[at + q]).sum(axis=1)
                    asked = int(asking[at + q])
                    found = sorted((-s, i, int(keys[r])) for s, r in zip(exact.tolist(), near.tolist(), strict=True) for i in ids[r] if i != asked)[:k]
                    for s, i, key in found:
                        out[0].append(asked), out[1].append(i), out[2].append(key), out[3].append(-s)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.float64())],
                        names=["query_id", "vec_id", "vector_key", "score"])

    return run
