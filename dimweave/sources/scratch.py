"""Intermediate results that are used more than once, as Parquet tables in a shared folder.

Writing them cuts the lineage, survives lost executors and gives every row a fixed place
(file and row index) that key allocation relies on. Those of a load step are deleted when its tables are written, see ``released``.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_written = threading.local()  # paths that this thread has named within ``released``


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local temporary folder only where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if shared:
        return f"{shared.rstrip('/')}/dimweave-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="dimweave-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A folder of its own for a table."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if getattr(_written, "paths", None) is not None:
        _written.paths.append((spark, path))
    return path


@contextlib.contextmanager
def released():
    """Delete the tables that this thread writes within, at the end. Nothing may read them afterwards, so results must be written elsewhere by then."""
    outer = getattr(_written, "paths", None)
    _written.paths = []
    try:
        yield
    finally:
        paths, _written.paths = _written.paths, outer
        for spark, path in paths:
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table of this application's scratch folder, if it is there."""
    if path.split("/")[-2] != scratch_root(spark).split("/")[-1]:
        raise ValueError(f"{path} is not a table of the scratch folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and return a reader over the written files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
