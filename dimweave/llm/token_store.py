"""Token-ID shards with a minimal perfect hash index.

A store is a folder with ``shards/`` and ``index/``.

Shard ``shard-00007.ids``: all ids in a row, then the token count of every document as little-endian
uint32, then JSON (``dtype``, ``documents``, ``tokens``) and its length in eight bytes. Ids take two
bytes if the vocabulary allows it, otherwise four. Shards follow ascending doc_id, and so do documents
within. Ids are written as they come, so a task holds the counts of its shard and no more.

Index ``bucket-00003.npz``: keys are dealt to buckets by hash. A bucket has levels of bits: a key that
is alone on its bit of a level owns that bit, the others try the next level. The rank of the bit is
the key's slot, so n keys have exactly n slots. A slot stores a 32-bit fingerprint of its key, the
shard, the place of the first id in it, the ids of all documents before, the number of documents
with this key and the number of the first of them in the shard. Access by key is constant in time: one hash for a
level, one comparison of fingerprints, one ranged read.

Table ``slices`` lists runs of at most ``SLICE`` documents that are reached without a slot: those without a doc_id, and those of a
doc_id that has more than one run. Each run is read by itself, so a doc_id that many documents share is
written and read by many tasks; its slot says 0 documents. Only full copies (one doc_id, one text to its first ``PREFIX`` characters)
are written by one task.

Files are written under a name of the task's attempt and then renamed; a repeated task that finds its file leaves it.
Nulls: a null text is empty and gives only the end id; documents with a null doc_id come
first, are kept in the shards and have no key. Rows with one doc_id lie side by side, ordered by
text. An empty table gives a store without shards.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import materialize, open_store, slices, spread
from dimweave.llm.tokens import encoder

KEYS_PER_BUCKET = 100_000
READERS = 32  # tasks that read the documents of a bucket
SLICE = 1000  # documents of one doc_id, or of none, that a task reads at a time
PREFIX = 256  # characters of the text that deal the documents of one doc_id out to shards
LEVELS = 64  # keys left after the last one are told as an error; each level keeps under half of them
_MANIFEST = "doc_id long, shard int, place long, number long, copies long, n_tokens long"
_SLICES = "doc_id long, shard int, place long, number long, copies long, start long"
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"


def write_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode ``docs`` (doc_id, text) and write shards and index under ``folder``."""
    ordered = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange(spread(docs), "doc_id", F.substring("text", 1, PREFIX)).sortWithinPartitions("doc_id", "text"))
    manifest = materialize(ordered.mapInArrow(_shard_writer(folder, tokenizer, end_id), _MANIFEST), "manifest")
    bases = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # a row per shard
    base, before = [], 0
    for row in bases:
        base.append((row["shard"], before))
        before += row["n"]
    spark = docs.sparkSession
    shard_base = F.broadcast(spark.createDataFrame(base, "shard int, base long"))
    runs = manifest.join(shard_base, "shard").withColumn("start", F.col("base") + F.col("place"))
    keys = (runs.where("doc_id is not null").groupBy("doc_id")
            .agg(F.min(F.struct("start", "shard", "place", "number")).alias("first"), F.count(F.lit(1)).alias("runs"), F.sum("copies").alias("copies")))
    several = keys.where("runs > 1").select("doc_id")
    slices_of = runs.where("doc_id is null").unionByName(runs.join(several, "doc_id", "left_semi").select(*runs.columns))
    slices_of.select(*[c.split()[0] for c in _SLICES.split(", ")]).write.parquet(f"{folder}/slices")
    keys = keys.select("doc_id", "first.*", F.when(F.col("runs") == 1, F.col("copies")).otherwise(0).alias("copies"))
    n_buckets = bucket_count(manifest.agg(F.sum("copies")).first()[0] or 0)
    (keys.withColumn("bucket", bucket_of("doc_id", n_buckets)).repartition(n_buckets, "bucket")
     .groupBy("bucket").applyInPandas(_index_writer(folder), "bucket int, keys long")
     .write.format("noop").mode("overwrite").save())


def bucket_count(rows: int) -> int:
    return max(1, -(-rows // KEYS_PER_BUCKET))


def bucket_of(column: str, n_buckets: int):
    return F.pmod(F.xxhash64(column), F.lit(n_buckets)).cast("int")


def read_store(keys: DataFrame, folder: str, n_buckets: int) -> DataFrame:
    """Read the documents of ``keys`` (doc_id) back through the index: doc_id, start, n_tokens, ids_crc32, shard.

    Each key gives all its documents; a key that the store does not have gives none.
    """
    wanted = keys.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    # A stated number: keys are small, but a task reads the ids of its documents.
    indexed = (wanted.withColumn("bucket", bucket_of("doc_id", n_buckets)).repartition(spread(keys), "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(READERS)))
               .sortWithinPartitions("bucket", "doc_id").mapInArrow(_key_reader(folder), _ROWS))
    return indexed.unionByName(_read_slices(_slices(keys.sparkSession, folder).join(wanted, "doc_id", "left_semi"), folder))


def read_unkeyed(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without a doc_id."""
    return _read_slices(_slices(spark, folder).where("doc_id is null"), folder)


def _slices(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_SLICES).parquet(f"{folder}/slices")


def _read_slices(found: DataFrame, folder: str) -> DataFrame:
    names = [c.split()[0] for c in _SLICES.split(", ")]
    return found.select(*names).repartition(spread(found), "shard", "number").mapInArrow(_slice_reader(folder), _ROWS)


def _save(path: str, parts: Iterator[bytes]) -> None:
    """Write a file under the name of this attempt and rename it when it is whole."""
    fs, inner = open_store(path)
    fs.create_dir(inner.rpartition("/")[0], recursive=True)
    own = f"{inner}.attempt-{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    publish(fs, own, inner)


def publish(fs: pyarrow.fs.FileSystem, own: str, target: str) -> None:
    """Give a whole file its name, unless an earlier attempt at the same task has done so."""
    def there() -> bool:
        return fs.get_file_info(target).type != pyarrow.fs.FileType.NotFound

    if not there():
        try:
            fs.move(own, target)
            return
        except OSError:
            if not there():
                raise
    fs.delete_file(own)


def _shard_writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, counts, keys = TaskContext.get().partitionId(), [], []

        def parts() -> Iterator[bytes]:
            enc = encoder(tokenizer, sentences=False)
            kind = np.dtype("<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
            for batch in chain([first], rest):
                flat, n, *_ = enc.encode(batch.column("text").to_pylist())
                counts.append(n + 1)
                keys.append(batch.column("doc_id"))
                yield np.insert(flat, np.cumsum(n), end_id).astype(kind).tobytes()
            n = np.concatenate(counts)
            yield n.astype("<u4").tobytes()
            foot = json.dumps({"dtype": kind.str, "documents": len(n), "tokens": int(n.sum())}).encode()
            yield foot + struct.pack("<q", len(foot))

        rest = (s for b in batches for s in slices(b, "text"))
        first = next(rest, None)
        if first is None:
            return
        _save(f"{folder}/shards/shard-{shard:05d}.ids", parts())
        n, key = np.concatenate(counts).astype(np.int64), pa.chunked_array(keys)
        place, first = np.cumsum(n) - n, _first_of_runs(key)
        fields = [place[first], first, np.diff(first, append=len(n)), np.add.reduceat(n, first)]
        for at in range(0, len(first), 100_000):
            part = slice(at, at + 100_000)
            own = key.take(pa.array(first[part])).combine_chunks()
            yield pa.RecordBatch.from_arrays([own, pa.array(np.full(len(own), shard), pa.int32()), *(pa.array(f[part]) for f in fields)],
                                             ["doc_id", "shard", "place", "number", "copies", "n_tokens"])

    return write


def _first_of_runs(key: pa.ChunkedArray) -> np.ndarray:
    """Where runs of at most ``SLICE`` equal keys begin; equal keys lie side by side."""
    empty, values = key.is_null().to_numpy(), key.fill_null(0).to_numpy()
    new = np.concatenate(([True], (values[1:] != values[:-1]) | (empty[1:] != empty[:-1])))
    at = np.arange(len(values))
    return np.flatnonzero(new | ((at - np.maximum.accumulate(np.where(new, at, 0))) % SLICE == 0))


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of integer keys (the finaliser of splitmix64) that depends on ``seed``."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct integer keys to 0, ..., n - 1 and back to no more than the levels of bits."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.offsets = np.cumsum(sizes) - sizes
        self.rank = np.concatenate(([0], np.cumsum(bits)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        left = keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = 2 * len(left)
            at = (mixed(left, level) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(bits)
            left = left[~bits[at]]
        if len(left):
            raise ValueError("the keys are not distinct")
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that finds no bit. A foreign key may find one."""
        slot = np.full(len(keys), -1, np.int64)
        for level, (offset, size) in enumerate(zip(self.offsets, self.sizes, strict=True)):
            open_ = np.flatnonzero(slot < 0)
            if not len(open_):
                break
            at = offset + (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            slot[open_[hit]] = self.rank[at[hit]]
        return slot


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def _index_writer(folder: str):
    def write(rows):
        keys = rows["doc_id"].to_numpy(np.int64)
        perfect = PerfectHash.build(keys)
        order = np.argsort(perfect.slots(keys))
        fields = {c: rows[c].to_numpy(np.int64)[order] for c in ("shard", "place", "number", "start", "copies")}
        out = io.BytesIO()
        np.savez(out, sizes=perfect.sizes, bits=np.packbits(perfect.bits), prints=fingerprints(keys)[order], **fields)
        _save(f"{folder}/index/bucket-{int(rows['bucket'].iloc[0]):05d}.npz", iter([out.getvalue()]))
        return rows[["bucket"]].head(1).assign(keys=len(keys))

    return write


class Bucket:
    """One loaded bucket of the index."""

    def __init__(self, fs, path: str):
        with fs.open_input_stream(path) as f:
            data = np.load(io.BytesIO(f.read()))
            self.fields = {k: data[k] for k in data.files}
        sizes = self.fields["sizes"]
        self.hash = PerfectHash(sizes, np.unpackbits(self.fields["bits"])[: sizes.sum()].astype(bool))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``keys`` that the bucket has, and their slots."""
        slot = self.hash.slots(keys)
        known = np.flatnonzero(slot >= 0)
        known = known[self.fields["prints"][slot[known]] == fingerprints(keys[known])]
        return known, slot[known]


class Shard:
    """An open shard."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        self.file.seek(self.file.size() - 8)
        length = struct.unpack("<q", self.file.read(8))[0]
        self.file.seek(self.file.size() - 8 - length)
        self.head = json.loads(self.file.read(length))
        self.kind = np.dtype(self.head["dtype"])
        self.counts_at = self.kind.itemsize * self.head["tokens"]

    def counts(self, number: int, n: int) -> np.ndarray:
        self.file.seek(self.counts_at + 4 * number)
        return np.frombuffer(self.file.read(4 * n), "<u4")

    def ids(self, place: int, n: int) -> np.ndarray:
        self.file.seek(self.kind.itemsize * place)
        return np.frombuffer(self.file.read(self.kind.itemsize * n), self.kind)


def _documents(shard: Shard, number: int, copies: int, place: int) -> Iterator[tuple[int, int, int]]:
    """Place, token count and crc32 of consecutive documents."""
    for n in shard.counts(number, copies).tolist():
        yield place, n, zlib.crc32(shard.ids(place, n).astype("<u4").tobytes())
        place += n


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _ROWS.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _key_reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = open_store(folder)
        at, bucket = None, None
        for batch in batches:
            keys, buckets = batch.column("doc_id").to_numpy(), batch.column("bucket").to_numpy()
            for number in np.unique(buckets):
                if number != at:
                    at, bucket = number, Bucket(fs, f"{inner}/index/bucket-{number:05d}.npz")
                own = keys[buckets == number]
                known, slots = bucket.find(own)
                f, rows, shard, open_at = bucket.fields, [], None, None
                for k in np.lexsort((f["place"][slots], f["shard"][slots])):
                    slot = slots[k]
                    if f["shard"][slot] != open_at:
                        open_at = int(f["shard"][slot])
                        shard = Shard(fs, f"{inner}/shards/shard-{open_at:05d}.ids")
                    start = int(f["start"][slot]) - int(f["place"][slot])
                    rows += [(int(own[known[k]]), start + place, n, crc, open_at)
                             for place, n, crc in _documents(shard, int(f["number"][slot]), int(f["copies"][slot]), int(f["place"][slot]))]
                yield _batch(rows)

    return read


def _slice_reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, inner = open_store(folder)
        for batch in batches:
            for run in batch.to_pylist():
                shard = Shard(fs, f"{inner}/shards/shard-{run['shard']:05d}.ids")
                base = run["start"] - run["place"]
                yield _batch([(run["doc_id"], base + place, n, crc, run["shard"]) for place, n, crc in _documents(shard, run["number"], run["copies"], run["place"])])

    return read
