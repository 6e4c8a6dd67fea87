"""Order-preserving packing of token ids into windows.

The ids of a partition's documents, in order, form one line. Windows cut it; a cut costs nothing at
the end of a document, little at the end of a sentence and more elsewhere, and a window that is
neither full nor a power of two long costs the padding up to full length. Dynamic programming finds
the cheapest set of cuts. States are the ends of documents and sentences and the points that
``free_cuts`` adds, so that text without any sentence can be cut too. The cheapest predecessor within
a window's reach is the head of a monotone queue; predecessors at a distance of a power of two come
from a search over all states at once.

Nothing is shuffled: a window takes documents of one partition in the order they have. Each
partition's line is programmed in blocks of about ``BLOCK_TOKENS`` ids, so memory is bounded; a block's
end can be reached by windows that are powers of two, so blocks need no padding.

Nulls and ties: a null text counts as empty (the end id alone), null and repeated doc_ids are packed
like others, in the order of the rows. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import slices
from dimweave.llm.tokens import encoder

SENTENCE_COST, FREE_COST = 4.0, 16.0  # of a cut, in tokens of padding
SHORT_COST = 48.0  # of a window under full length, so that few are made
BLOCK_TOKENS = 1 << 20
_PIECES = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
           "sequence_id": pa.int64(), "offset": pa.int64()}
PIECE_SCHEMA = ", ".join(f"{c} long" for c in _PIECES)


def plan_cuts(states: np.ndarray, costs: np.ndarray, window: int) -> list[int]:
    """Window ends of the cheapest packing of a line.

    ``states``: ascending positions where a cut is considered, from 0 to the line's end. ``costs``:
    what a cut there costs; infinite means that the cut is not allowed. No gap may exceed a window.
    """
    points, price = states.tolist(), costs.tolist()
    first, earlier = _at_powers(states, window)
    best, back = [0.0] * len(points), [0] * len(points)
    keys, queued, head = [0.0], [0], 0  # the queue from ``head`` on: cost plus position and state, both ascending
    for j in range(1, len(points)):
        at = points[j]
        while points[queued[head]] < at - window:
            head += 1
        cost, i = keys[head] + window - at, queued[head]
        for k in earlier[first[j]: first[j + 1]]:
            if best[k] + SHORT_COST < cost:
                cost, i = best[k] + SHORT_COST, k
        cost += price[j]
        best[j], back[j] = cost, i
        cost += at
        while len(keys) > head and keys[-1] >= cost:
            keys.pop()
            queued.pop()
        keys.append(cost)
        queued.append(j)
    cuts, j = [], len(points) - 1
    while j:
        cuts.append(points[j])
        j = back[j]
    return cuts[::-1]


def _at_powers(states: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """The earlier states at a distance of a power of two below a window, state by state, and where those of each begin, with the end."""
    later, earlier = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in (1 << k for k in range((window - 1).bit_length())):
        at = np.searchsorted(states, states - p)
        later.append(np.flatnonzero(states[at] == states - p))
        earlier.append(at[later[-1]])
    found = np.concatenate(later)
    order = np.argsort(found, kind="stable")
    return np.searchsorted(found[order], np.arange(len(states) + 1)).tolist(), np.concatenate(earlier)[order].tolist()


def free_cuts(doc_ends: np.ndarray, window: int) -> np.ndarray:
    """Cuts inside documents that let windows be full: each window from the line's start, one window
    after each end of a document, and at the line's end windows that are powers of two."""
    last = int(doc_ends[-1])
    rest, tail = last // window * window, []
    for k in range(window.bit_length() - 1, -1, -1):
        if last % window >> k & 1:
            rest += 1 << k
            tail.append(rest)
    cuts = np.concatenate((np.arange(window, last, window), doc_ends + window, np.array(tail, np.int64)))
    return cuts[cuts < last]


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_packer(tokenizer, window, end_id), PIECE_SCHEMA)


def _packer(tokenizer: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        block: list[tuple] = []
        held = 0
        for batch in (s for b in batches for s in slices(b, "text")):
            flat, n, parts_at, ends = enc.encode(batch.column("text").to_pylist())
            block.append((batch.column("doc_id").to_pylist(), flat, n, np.concatenate((parts_at[1:], [len(flat)]))[ends]))
            held += len(flat)
            if held >= BLOCK_TOKENS:
                made, sequence = _pieces(block, window, end_id, sequence)
                yield made
                block, held = [], 0
        if block:
            yield _pieces(block, window, end_id, sequence)[0]

    return run


def _pieces(block: list[tuple], window: int, end_id: int, sequence: int) -> tuple[pa.RecordBatch, int]:
    """Pack one block; also the number of the next sequence."""
    keys = [k for b in block for k in b[0]]
    n = np.concatenate([b[2] for b in block])
    before = np.cumsum([0, *(len(b[1]) for b in block)])
    sentences = np.concatenate([b[3] + o for b, o in zip(block, before, strict=False)])
    ends = np.cumsum(n)  # of documents, without end ids
    line = np.insert(np.concatenate([b[1] for b in block]), ends, end_id).astype("<u4")
    sentences = sentences + np.searchsorted(ends, sentences, "left")
    doc_ends = ends + np.arange(1, len(n) + 1)
    states = np.unique(np.concatenate(([0], sentences, doc_ends, free_cuts(doc_ends, window))))
    costs = np.full(len(states), FREE_COST)
    costs[np.searchsorted(states, sentences)] = SENTENCE_COST
    costs[np.searchsorted(states, doc_ends)] = 0.0
    cuts = np.array(plan_cuts(states, costs, window))
    bounds = np.union1d(cuts, doc_ends)
    starts = np.concatenate(([0], bounds[:-1]))
    doc = np.searchsorted(doc_ends, starts, "right")
    own = np.searchsorted(cuts, starts, "right")
    doc_start, window_start = np.concatenate(([0], doc_ends[:-1])), np.concatenate(([0], cuts[:-1]))
    raw = memoryview(line.tobytes())
    crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(starts.tolist(), bounds.tolist(), strict=True)]
    columns = [[keys[d] for d in doc.tolist()], starts - doc_start[doc], bounds - starts, crc, (n + 1)[doc], own + sequence, starts - window_start[own]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _PIECES.values(), strict=True)], list(_PIECES)), sequence + len(cuts)
