"""Helpers that the operators share."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.sources import scratch
from dimweave.sources.scratch import scratch_root

__all__ = ["keyed_texts", "materialize", "new_folder", "open_store", "read", "read_block", "slices", "spread", "write_blocks"]

SLICE_BYTES = 1024 * 1024  # of text that a Python task holds as arrays at a time


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a reader over it.

    Spark deletes the shuffle files of a finished plan when the driver's JVM has collected the plan. A step may
    shuffle as much as its input, so collection is asked for here instead of left to chance.
    """
    written = scratch.materialize(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    return written


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    context = spark.sparkContext
    if any(f.endswith("/dimweave-code.zip") for f in context.listFiles):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    folder = new_folder(spark, "code")
    fs, inner = open_store(folder)
    fs.create_dir(inner, recursive=True)
    with fs.open_output_stream(f"{inner}/dimweave-code.zip") as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/dimweave-code.zip")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def open_store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and inner path of a shared folder, from any task."""
    if ":/" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)


def slices(batch: pa.RecordBatch, column: str):
    """Cut a batch into runs of rows with about ``SLICE_BYTES`` of text, so that long texts need little memory."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def spread(df: DataFrame) -> int:
    """Number of partitions to deal ``df`` out to where a number must be stated."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``text_key``, which tells rows of one doc_id apart.

    Rows that share doc_id and text are one document to the operators: they get the same result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("text_key", F.xxhash64("text"))


def write_blocks(items: DataFrame, label: str, chars: int) -> tuple[str, int]:
    """Write the rows of ``items`` that have a ``text`` in blocks of about ``chars`` characters, dealt by hash, for tasks to load.

    Returns the folder and the number of blocks. Only two numbers reach the driver.
    """
    items = items.where("text is not null")
    total = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // chars))
    folder = new_folder(items.sparkSession, label)
    items.withColumn("block", F.pmod(F.xxhash64(*items.columns), F.lit(blocks))).repartition("block").write.partitionBy("block").parquet(folder)
    return folder, blocks


def read_block(folder: str, block: int) -> pa.Table | None:
    """The rows of one written block, in a task; None if it has none."""
    fs, inner = open_store(folder)
    files = fs.get_file_info(pyarrow.fs.FileSelector(f"{inner}/block={block}", allow_not_found=True))
    found = [pyarrow.parquet.ParquetFile(fs.open_input_file(f.path)).read() for f in sorted(files, key=lambda f: f.path) if f.path.endswith(".parquet")]
    return pa.concat_tables(found) if found else None
