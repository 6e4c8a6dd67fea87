"""Benchmark decontamination by greedy string tiling.

A document leaks a benchmark item if tiles cover at least ``COVERAGE`` of the item's tokens. Tiles are
matches of ``MIN_MATCH`` or more tokens that overlap neither in the document nor in the item, marked
longest first, in any order of the passages. Tokens are runs of word characters, lower-cased.

Seeds are all runs of ``MIN_MATCH`` tokens of the items. Documents are joined with them where they lie,
task by task: the items are written to the shared folder in blocks of about ``BLOCK_CHARS`` characters, which tasks load one
after the other, so that one pass over the documents meets all blocks. Only an item whose
seeds in a document could reach the coverage is tiled. No document is shuffled.

Nulls and ties: a null or empty text leaks nothing, nor does a null or empty item. An item of fewer than
``MIN_MATCH`` tokens has no seeds and is never matched. Null item_ids and doc_ids stay null, repeated
rows are judged one by one. Empty tables leak nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import read_block, slices, write_blocks

MIN_MATCH, COVERAGE = 5, 0.5
BLOCK_CHARS = 4_000_000
GROUP_SLICES = 32  # of texts that meet one block after the other, where there are several
FIRST_LENGTH = 20  # of the search for tiles

_WORD = re.compile(r"\w+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LEAKS = "doc_id long, item_id long, coverage double, matched long, item_tokens long, tiles array<struct<doc_start:bigint,item_start:bigint,length:bigint>>"


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` ids."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        if size > 32:  # rolling: prefix sums with powers, the same value for equal runs
            up = np.cumprod(np.full(len(x) + 1, _MULTIPLIER, np.uint64)) * np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
            down = np.full(n, pow(int(_MULTIPLIER), -1, 1 << 64), np.uint64)
            down[0] = 1
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[: len(x)])))
            return (sums[size:] - sums[:n]) * np.cumprod(down)
        total = np.zeros(n, np.uint64)
        for k in range(size - 1, -1, -1):
            total = total * _MULTIPLIER + x[k: k + n]
    return total


def greedy_tiles(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length), longest first."""
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(min_match, min(FIRST_LENGTH, len(item)))
    while True:
        found = _maximal(doc, item, free_doc, free_item, length)
        longest = found[0][2] if found else 0
        if longest > 2 * length:
            length = longest
            continue
        for d, i, n in found:
            if free_doc[d: d + n].all() and free_item[i: i + n].all():
                free_doc[d: d + n] = free_item[i: i + n] = False
                tiles.append((d, i, n))
        if length == min_match:
            # a match that lost a part to a longer tile may leave a rest that is long enough
            if not any(free_doc[d: d + n].any() for d, i, n in found):
                return tiles
            if not _maximal(doc, item, free_doc, free_item, length):
                return tiles
            continue
        length = max(min_match, length // 2)


def _maximal(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Matches of unmarked tokens of at least ``length`` that cannot be made longer, longest first."""
    own = _free_runs(free_doc, length)
    theirs = _free_runs(free_item, length)
    if not len(own) or not len(theirs):
        return []
    a, b = window_hashes(doc, length)[own], window_hashes(item, length)[theirs]
    order = np.argsort(b, kind="stable")
    left, right = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    found = []
    for k in np.flatnonzero(right > left).tolist():
        d = int(own[k])
        for i in theirs[order[left[k]: right[k]]].tolist():
            if d and i and free_doc[d - 1] and free_item[i - 1] and doc[d - 1] == item[i - 1]:
                continue  # part of the match that begins one token before
            most = min(len(doc) - d, len(item) - i)
            same = (doc[d: d + most] == item[i: i + most]) & free_doc[d: d + most] & free_item[i: i + most]
            n = most if same.all() else int(np.argmin(same))
            if n >= length:
                found.append((d, i, n))
    return sorted(found, key=lambda t: (-t[2], t[0], t[1]))


def _free_runs(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of ``length`` unmarked tokens in a row."""
    if len(free) < length:
        return np.zeros(0, np.int64)
    marked = np.concatenate(([0], np.cumsum(~free)))
    return np.flatnonzero(marked[length:] == marked[:-length])


class Items:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, items: list[tuple], min_match: int, coverage: float):
        self.min_match, self.coverage = min_match, coverage
        self.words: dict[str, int] = {}
        self.items = []
        seeds = []
        for item_id, text in items:
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in tokens(text)], np.int64)
            if len(ids) >= min_match:
                seeds.append((window_hashes(ids, min_match), len(self.items)))
                self.items.append((item_id, ids))
        none = np.zeros(0, np.int64)
        hashes = np.concatenate([np.zeros(0, np.uint64), *(h for h, _ in seeds)])
        order = np.argsort(hashes, kind="stable")
        self.seeds = hashes[order]
        self.owner = np.concatenate([none, *(np.full(len(h), k) for h, k in seeds)])[order]
        self.place = np.concatenate([none, *(np.arange(len(h)) for h, _ in seeds)])[order]

    def leaks(self, text: str | None) -> list[tuple[int, list[tuple[int, int, int]], int]]:
        """Items that the text leaks: number of the item, tiles, matched tokens."""
        words = tokens(text)
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        starts = _free_runs(ids > 0, self.min_match)
        if not len(starts) or not len(self.seeds):
            return []
        own = np.unique(window_hashes(ids, self.min_match)[starts])
        at = np.searchsorted(self.seeds, own, "left"), np.searchsorted(self.seeds, own, "right")
        covers: dict[int, set[int]] = defaultdict(set)
        for a, b in zip(*(x[at[1] > at[0]].tolist() for x in at), strict=True):
            for k in range(a, b):
                p = int(self.place[k])
                covers[int(self.owner[k])].update(range(p, p + self.min_match))
        found = []
        for k, cover in sorted(covers.items()):
            item = self.items[k][1]
            if len(cover) >= self.coverage * len(item):
                tiles = greedy_tiles(ids, item, self.min_match)
                matched = sum(n for *_, n in tiles)
                if matched >= self.coverage * len(item):
                    found.append((k, tiles, matched))
        return found


@lru_cache(maxsize=2)
def load_items(folder: str, block: int, min_match: int, coverage: float) -> Items:
    rows = read_block(folder, block)
    given = [] if rows is None else zip(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), strict=True)
    return Items(sorted(given, key=lambda r: (r[0] is None, r[0] or 0, r[1])), min_match, coverage)


def _blocks(benchmark: DataFrame) -> tuple[str, int]:
    return write_blocks(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "items", BLOCK_CHARS)


def leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """A row for each document and item that it leaks, with the tiles."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_reporter(*_blocks(benchmark), min_match, coverage), LEAKS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    return docs.mapInArrow(_filter(*_blocks(benchmark), min_match, coverage), docs.schema)


def _groups(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of texts, as many together as shall meet a block before the next one is loaded."""
    group: list[pa.RecordBatch] = []
    for batch in (s for b in batches for s in slices(b, "text")):
        group.append(batch)
        if blocks == 1 or len(group) == GROUP_SLICES:
            yield group
            group = []
    if group:
        yield group


def _reporter(folder: str, blocks: int, min_match: int, coverage: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, blocks):
            for block in range(blocks):
                items = load_items(folder, block, min_match, coverage)
                yield from (_reported(batch, items) for batch in group)

    return run


def _reported(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))
    columns: list[list] = [[], [], [], [], [], []]
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        for k, tiles, matched in items.leaks(text):
            item_id, item = items.items[k]
            named = [{"doc_start": d, "item_start": i, "length": n} for d, i, n in tiles]
            for column, value in zip(columns, (doc_id, item_id, matched / len(item), matched, len(item), named), strict=True):
                column.append(value)
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), kind]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["doc_id", "item_id", "coverage", "matched", "item_tokens", "tiles"])


def _filter(folder: str, blocks: int, min_match: int, coverage: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, blocks):
            clean = [np.ones(batch.num_rows, bool) for batch in group]
            for block in range(blocks):
                items = load_items(folder, block, min_match, coverage)
                for batch, own in zip(group, clean, strict=True):
                    for i, text in enumerate(batch.column("text").to_pylist()):
                        own[i] = own[i] and not items.leaks(text)
            yield from (batch.filter(pa.array(own)) for batch, own in zip(group, clean, strict=True))

    return run
