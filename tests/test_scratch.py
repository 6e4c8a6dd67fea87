"""What a load step needs on disk beside its tables goes when they are written."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from dimweave.plans.samples import SampleLoads
from dimweave.sources import scratch, statistics
from dimweave.sources.ingest import stage_frame
from dimweave.sources.scratch import materialize, released, scratch_root
from dimweave.sources.schemas import FACT_TABLE, REJECT_TABLE
from dimweave.sources.statistics import record


def tables(spark):
    root = scratch_root(spark)
    return set(os.listdir(root)) - {"samples"} if os.path.exists(root) else set()


def test_tables_of_a_scope_go_at_its_end(spark):
    before = tables(spark)
    with released():
        kept = spark.range(5).count()
        materialize(spark.range(3), "outer")
        with released():
            materialize(spark.range(3), "inner")
            assert {n.split("-")[0] for n in tables(spark) - before} == {"outer", "inner"}
        assert {n.split("-")[0] for n in tables(spark) - before} == {"outer"}
        other = []
        thread = threading.Thread(target=lambda: other.append(materialize(spark.range(4), "other")))
        thread.start()
        thread.join()
    assert kept == 5
    assert {n.split("-")[0] for n in tables(spark) - before} == {"other"}  # another thread's table is its own
    assert other[0].count() == 4


def test_tables_go_where_a_step_fails(spark):
    before = tables(spark)
    with pytest.raises(KeyError), released():
        materialize(spark.range(3), "failing")
        raise KeyError
    assert tables(spark) == before
    assert materialize(spark.range(3), "free").count() == 3  # no scope, so it stays


def test_only_scratch_tables_are_dropped(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/mine")
    with pytest.raises(ValueError, match="not a table"):
        scratch.drop(spark, f"{tmp_path}/mine")
    assert spark.read.parquet(f"{tmp_path}/mine").count() == 3


def test_raw_rows_of_a_staged_sheet_are_dropped(spark):
    before = tables(spark)
    staged = stage_frame(spark.createDataFrame([(2, "b"), (1, "a")], "RegionID long, RegionDescription string"), "Region")
    assert {n.split("-")[0] for n in tables(spark) - before} == {"ordered", "offsets"}
    assert [(r[0], r["RegionID"]) for r in staged.orderBy("RegionID").collect()] == [(1, 1), (2, 2)]


def test_loads_leave_their_tables_only(spark, sf_dir):
    loads = SampleLoads(spark, sf_dir)
    before = tables(spark)
    loaded = {name: loads.after(1, name) for name in (FACT_TABLE, REJECT_TABLE)}
    assert tables(spark) == before
    assert all(state.frame(name).count() == state.rows(name) > 0 for name, state in loaded.items())


def test_shuffles_of_a_written_table_are_deleted(spark, monkeypatch):
    monkeypatch.setattr(statistics, "LARGE_INPUT", -1)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for d in disk.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}

    before = shuffled()
    record(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "grouped")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
