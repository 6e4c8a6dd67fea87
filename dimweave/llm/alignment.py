"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A is byte-level BPE of the ``tokenizers`` library and encodes a space and the text, tokenizer B is a
``sentencepiece`` model, which adds that space itself. A dictionary from the byte where a token ends to the token's index is
made for each side; the ends that both dictionaries have, in order, slice both id lists into groups. Every A token of
a group is linked with every B token of it. Strings of special tokens in a text are plain text.

Both tokenizers end a token before a space that follows another character than white space, so a text is aligned part by
part (see ``tokens``), each part once, and what it gives is remembered. A model with a piece that
runs over such a place has its texts aligned whole.

The count of an id pair is the number of rows that hold it linked. Tasks gather rows in blocks of about
``BLOCK_BYTES`` of text and give the pairs of a block once, with the number of its rows that hold them; so counts are
sums over blocks, and each block gets back the counts of its own pairs and no others. Nothing is broadcast.

Nulls and ties: a null or empty text has no tokens, nor has one whose tokens do not spell the space and the text (such as a
text with U+2581): all its numbers are zero and its groups are the empty text. Repeated rows, null and repeated doc_ids are
rows like others. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimweave.llm.common import materialize, slices
from dimweave.llm.tokens import Lists, PartMemory, WordIds, byte_letters, cut, ragged

BLOCK_BYTES = 8 * 1024 * 1024
MAX_PARTS = 200_000  # remembered parts of a Python worker
A_SHIFT = 32  # a pair is the A id times 2^32 plus the B id
WIDE = 64  # links of a group from which its pairs are counted before they are listed

_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_ROWS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, slots array<int>, times array<long>, pairs array<long>, holders array<long>"
STATISTICS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_aligners: dict[tuple, "Aligner"] = {}


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B lie before the end of each group: the bytes where both sides end a token, in order."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    common = sorted(index_a.keys() & index_b.keys())
    return tuple(np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (index_a, index_b))


def links(ids_a: list[int], ids_b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The id pairs of one group, each once, with their number of links."""
    (a, n), (b, m) = (np.unique(np.array(ids, np.int64), return_counts=True) for ids in (ids_a, ids_b))
    return (a[:, None] << A_SHIFT | b).ravel(), (n[:, None] * m).ravel()


class PieceIds:
    """Ids of texts by the ``sentencepiece`` model and the bytes of its pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuttable = not any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces)
        self.space = self.model.encode("a ")[len(self.model.encode("a")):]

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.model.encode(texts, num_threads=1)
        return [own if text else self.space for own, text in zip(found, texts, strict=True)]


class Aligner(PartMemory):
    """Aligns texts; a part's key is the text behind its space."""

    def __init__(self, path_a: str, path_b: str, max_parts: int = MAX_PARTS):
        super().__init__(max_parts)
        self.a, self.b = WordIds(path_a, added_tokens=False), PieceIds(path_b)
        back = {c: b for b, c in enumerate(byte_letters())}
        entries = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(map(back.__getitem__, entry)) if all(c in back for c in entry) else b""
        self.a_sizes, self.b_sizes = (np.array(list(map(len, own)), np.int64) for own in (self.a_bytes, self.b.bytes))
        # Ids as text with what follows them: a comma, the bar behind a group's A ids, a semicolon, the line's end behind a part.
        self.shown = [f"{i}{mark}" for own, marks in ((self.a_bytes, ",|"), (self.b.bytes, ",;\n")) for mark in marks for i in range(len(own))]
        self.written: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links; n_a is -1 where bytes differ
        self.pairs, self.times = Lists(np.int64), Lists(np.int64)

    def align(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The groups of each key as text and its four numbers; the linked pairs of all in a row, their links, and how many pairs a key has."""
        spaced = [f" {k}".encode() for k in keys]
        a, n_a = self.a.encode([f" {k}" for k in keys])
        ids = self.b.encode(keys)
        n_b = np.fromiter(map(len, ids), np.int64, len(ids))
        b = np.fromiter(chain.from_iterable(ids), np.int64, int(n_b.sum()))
        a = a.astype(np.int64)
        good = self._spelled(spaced, a, n_a, b, n_b)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        sizes = np.zeros((len(keys), 4), np.int64)
        sizes[~good, 0] = -1
        counts = np.zeros(len(keys), np.int64)
        written = [""] * len(keys)
        if good.any():
            text, sizes[good], pairs, times, counts[good] = self._grouped(a, n_a[good], b, n_b[good])
            for i, own in zip(np.flatnonzero(good).tolist(), text, strict=True):
                written[i] = own
            return written, sizes, pairs, times, counts
        return written, sizes, a, a, counts

    def _spelled(self, spaced: list[bytes], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether the tokens of both sides spell each of the texts."""
        length = np.fromiter(map(len, spaced), np.int64, len(spaced))
        whole_a, whole_b = (b"".join(map(own.__getitem__, ids.tolist())) for own, ids in ((self.a_bytes, a), (self.b.bytes, b)))
        sums = [np.diff(np.concatenate(([0], np.cumsum(own[ids])))[np.concatenate(([0], np.cumsum(n)))]) for own, ids, n in ((self.a_sizes, a, n_a), (self.b_sizes, b, n_b))]
        good = (sums[0] == length) & (sums[1] == length)
        if good.all() and whole_a == whole_b == b"".join(spaced):
            return good
        ends = [np.cumsum(own).tolist() for own in sums]
        starts = [[0, *own[:-1]] for own in ends]
        return np.array([ok and whole_a[a0: a1] == whole_b[b0: b1] == text for ok, a0, a1, b0, b1, text in
                         zip(good.tolist(), starts[0], ends[0], starts[1], ends[1], spaced, strict=True)], bool)

    def _grouped(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        """``align`` of texts that both sides spell, laid one behind the other."""
        ends = groups(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))
        starts = [np.concatenate(([0], e[:-1])) for e in ends]
        wide_a, wide_b = ends[0] - starts[0], ends[1] - starts[1]
        part = np.searchsorted(np.cumsum(n_a), starts[0], "right")
        n_links = wide_a * wide_b
        # Groups as text: the ids of both sides in the order of the groups, each with the mark behind it.
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[ends[0] - 1] = len(self.a_bytes)
        mark_b[ends[1] - 1] = len(self.b.bytes)
        mark_b[np.cumsum(n_b) - 1] = 2 * len(self.b.bytes)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(starts[1], wide_a)] = a + mark_a
        order[np.arange(len(b)) + np.repeat(ends[0], wide_b)] = b + mark_b + 2 * len(self.a_bytes)
        written = "".join(map(self.shown.__getitem__, order.tolist())).split("\n")[:-1]
        # Links: all pairs of tokens of a group, or where they are many the distinct id pairs with their number.
        wide = np.flatnonzero(n_links > WIDE)
        counted = [links(a[starts[0][g]: ends[0][g]].tolist(), b[starts[1][g]: ends[1][g]].tolist()) for g in wide.tolist()]
        entries = n_links.copy()
        entries[wide] = [len(p) for p, _ in counted]
        at = np.cumsum(entries) - entries
        pairs, times = np.zeros(int(entries.sum()), np.int64), np.ones(int(entries.sum()), np.int64)
        usual = np.flatnonzero(n_links <= WIDE)
        within = ragged(np.zeros(len(usual), np.int64), n_links[usual])
        group = np.repeat(usual, n_links[usual])
        pairs[ragged(at[usual], n_links[usual])] = a[starts[0][group] + within // wide_b[group]] << A_SHIFT | b[starts[1][group] + within % wide_b[group]]
        for g, (own, n) in zip(wide.tolist(), counted, strict=True):
            pairs[at[g]: at[g] + len(own)], times[at[g]: at[g] + len(own)] = own, n
        texts = len(n_a)
        whole = [np.bincount(part, minlength=texts), np.zeros(texts, np.int64), np.zeros(texts, np.int64)]
        np.add.at(whole[1], part, n_links)
        np.add.at(whole[2], part, entries)
        return written, np.stack((n_a, n_b, whole[0], whole[1]), axis=1), pairs, times, whole[2]

    def learn(self, new: list) -> None:
        written, sizes, pairs, times, lengths = self.align(new)
        self.written += written
        self.sizes = np.concatenate((self.sizes, sizes))
        self.pairs.add(pairs, lengths)
        self.times.add(times, lengths)

    def keep(self, at: np.ndarray) -> None:
        self.written = [self.written[i] for i in at.tolist()]
        self.sizes, self.pairs, self.times = self.sizes[at], self.pairs.kept(at), self.times.kept(at)

    def rows(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the groups and the four numbers; of all texts in a row the distinct pairs, their links and how many pairs a text has."""
        self.tidy()
        parts: list[str] = []
        bounds = [0]
        for text in texts:
            parts += cut(f" {text}")[1:] if text and self.b.cuttable else [text] if text else []
            bounds.append(len(parts))
        number = self.number(parts)
        sizes = self.sizes[number]
        before = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(sizes, axis=0)))
        numbers = before[bounds[1:]] - before[bounds[:-1]]
        wrong = np.concatenate(([0], np.cumsum(sizes[:, 0] < 0)))
        bad = wrong[bounds[1:]] > wrong[bounds[:-1]]
        of_parts = list(map(self.written.__getitem__, number.tolist()))
        written = ["" if w else ";".join(of_parts[a: b]) for a, b, w in zip(bounds, bounds[1:], bad.tolist(), strict=False)]
        numbers[bad] = 0
        pairs, lengths = self.pairs.take(number)
        times, _ = self.times.take(number)
        row = np.repeat(np.repeat(np.arange(len(texts)), np.diff(bounds)), lengths)
        good = ~bad[row]
        pairs, times, row = pairs[good], times[good], row[good]
        for i in np.flatnonzero(bad).tolist():  # a text can spell itself where a part does not
            text, own, more, more_times, _ = self.align([texts[i]])
            if own[0, 0] >= 0:
                written[i], numbers[i] = text[0], own[0]
                pairs, times, row = np.concatenate((pairs, more)), np.concatenate((times, more_times)), np.concatenate((row, np.full(len(more), i)))
        bits = max(1, (len(self.a_bytes) - 1).bit_length()) + A_SHIFT
        if len(texts).bit_length() + bits < 64:
            key = row << bits | pairs
            order = np.argsort(key)
            key, times = key[order], times[order]
            first = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0))) if len(key) else order
            pairs, row = key & ((1 << bits) - 1), key >> bits
        else:
            order = np.lexsort((pairs, row))
            pairs, times, row = pairs[order], times[order], row[order]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(pairs) != 0) | (np.diff(row) != 0)))) if len(pairs) else order
        return written, numbers, pairs[first], np.add.reduceat(times, first) if len(first) else times[:0], np.bincount(row[first], minlength=len(texts))


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each Python worker and pair of tokenizers."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id``, the four numbers and ``groups`` of every row, as text: ``a1,a2|b1;a3|b2,b3``. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in (s for b in batches for s in slices(b, "text")):
            written, numbers, *_ = own.rows(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in numbers.T), pa.array(written, pa.string())], ["doc_id", *_NUMBERS, "groups"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string")


def statistics(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``STATISTICS`` of every row: its numbers, the digest of its groups, and how common its links are in all of ``docs``.

    ``n_best`` counts the links whose pair has the highest count of all pairs with its A id, ``count_sum`` adds
    the counts of all links.
    """
    linked = materialize(_texts(docs).mapInArrow(_linker(path_a, path_b), _ROWS), "linked")
    entries = linked.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("slot", "entry"))
    entries = entries.select("block", "slot", F.col("entry.pairs").alias("pair"), F.col("entry.holders").alias("holders"))
    counts = pair_counts(entries)
    found = entries.join(counts, "pair").select("block", "slot", "pair_rows", "best")
    rows = linked.where("pairs is null").select(*(F.col(c).alias(c) for c in linked.columns if c not in ("pairs", "holders")))
    return rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_counted_rows, STATISTICS)


def pair_counts(entries: DataFrame) -> DataFrame:
    """``pair``, ``pair_rows`` (rows that hold it) and ``best`` (no pair with its A id has more) of entries (pair, holders)."""
    counts = entries.groupBy("pair").agg(F.sum("holders").alias("pair_rows"))
    same = Window.partitionBy(F.shiftright("pair", A_SHIFT))  # as many rows as B has pieces at most
    return materialize(counts.withColumn("best", F.col("pair_rows") == F.max("pair_rows").over(same)), "counts")


def _linker(path_a: str, path_b: str):
    """Rows of texts, their pairs as places in the list of the block's pairs, which follows them in a row of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        block, held, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in (s for b in batches for s in slices(b, "text")):
            texts = batch.column("text").to_pylist()
            written, *rest = own.rows(texts)
            digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
            held.append((batch.column("doc_id"), digests, *rest))
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield from _block_rows(block, held)
                block, held, size = block + 1, [], 0
        if held:
            yield from _block_rows(block, held)

    return run


def _block_rows(block: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    keys, digests, numbers, pairs, times, lengths = zip(*held, strict=True)
    distinct, slots, holders = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
    at = 0
    for key, digest, number, own_times, length in zip(keys, digests, numbers, times, lengths, strict=True):
        bounds = pa.array(np.concatenate(([0], np.cumsum(length))), pa.int32())
        own = slots[at: at + len(own_times)]
        at += len(own_times)
        n = len(key)
        yield _rows_batch([pa.array(np.full(n, block)), key, *(pa.array(x) for x in number.T), pa.array(digest, pa.string()),
                           pa.ListArray.from_arrays(bounds, pa.array(own, pa.int32())), pa.ListArray.from_arrays(bounds, pa.array(own_times, pa.int64())),
                           pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))])
    whole = pa.array([0, len(distinct)], pa.int32())
    yield _rows_batch([pa.array([block]), *(pa.nulls(1, pa.int64()) for _ in range(5)), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64())),
                       pa.ListArray.from_arrays(whole, pa.array(distinct)), pa.ListArray.from_arrays(whole, pa.array(holders, pa.int64()))])


def _rows_batch(columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ROWS.split(", ")])


def _counted_rows(rows: pa.Table, found: pa.Table) -> pa.Table:
    """Statistics of the rows of one block from the counts of its pairs."""
    slot = found.column("slot").to_numpy()
    counts, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
    counts[slot], best[slot] = found.column("pair_rows").to_numpy(), found.column("best").to_numpy()
    slots = rows.column("slots").combine_chunks()
    lengths = slots.value_lengths().to_numpy()
    at, times = slots.flatten().to_numpy(), rows.column("times").combine_chunks().flatten().to_numpy()

    def total(values: np.ndarray) -> pa.Array:
        sums = np.concatenate(([0], np.cumsum(values)))
        ends = np.cumsum(lengths)
        return pa.array(sums[ends] - sums[ends - lengths], pa.int64())

    columns = [rows.column(c) for c in ("doc_id", *_NUMBERS)]
    return pa.Table.from_arrays([*columns, total(best[at] * times), total(counts[at] * times), rows.column("groups_sha256")],
                                [c.split()[0] for c in STATISTICS.split(", ")])
