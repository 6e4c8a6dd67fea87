"""Numbers kept of written tables: what plans tell from them, and that no job reads rows for them."""

import uuid

import pytest
from pyspark.sql import functions as F

from dimweave.operators import facts, joins
from dimweave.plans import registry
from dimweave.plans.samples import WINDOWS
from dimweave.sources import colocated, statistics
from dimweave.sources.statistics import TableStats, bound, count_of, frequent_keys, record, record_split
from dimweave.sources.warehouse import Change, Warehouse


@pytest.fixture
def jobs(spark):
    """How many jobs a call starts."""
    def count(call):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "counted")
        result = call()
        spark.sparkContext.setJobGroup("", "")
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    return count


@pytest.fixture
def written(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    rows = spark.range(9000).select(key.alias("k"), F.concat(F.lit("n"), F.col("id") % 10).alias("name"), (F.col("id") % 4 == 0).alias("odd"))
    return record(rows, "numbers", keys=("k",), counting={"odd": F.col("odd")})


def test_a_plan_tells_its_bound(spark, written, jobs):
    renamed = written.where("k > 5").select(F.col("k").alias("other"), F.col("name").alias("label")).distinct()
    known, n = jobs(lambda: bound(renamed))
    assert n == 0
    assert known.rows == 9000
    assert known.bytes() == 9000 * (16 + 8) + 18000
    assert bound(written.select(F.upper("name").alias("name"))).bytes() is None
    assert bound(written.join(written.select("k"), "k")) is None
    semi = written.join(spark.range(5).withColumnRenamed("id", "k"), "k", "left_semi")
    assert bound(semi.select("k")).rows == 9000
    both = bound(written.select("k", "name").union(written.select("k", "name")).select("name"))
    assert both.rows == 18000
    assert both.bytes() == 18000 * 16 + 36000
    assert bound(written.where("false").select("k")).bytes() == 0
    assert (count_of(written), count_of(written, "odd"), count_of(spark.range(3))) == (9000, 2250, 3)


def test_frequent_keys_come_with_the_table(spark, written, jobs):
    (rows, found), n = jobs(lambda: frequent_keys(written.select(F.col("k").alias("nk")), "nk"))
    assert n == 0
    assert rows == 9000
    assert found[7] == pytest.approx(3000, abs=5)
    assert len(found) == 1
    hot, n = jobs(lambda: joins.hot_keys(written, "k"))
    assert n == 0
    assert hot[7] > 1000
    assert frequent_keys(written.select((F.col("k") + 1).alias("k")), "k") is None
    assert frequent_keys(written.select(F.col("name").alias("k")), "k") is None


def test_split_tables_know_their_parts(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 4).alias("k"), F.lit("ab").alias("t"), F.when(F.col("id") < 10, "few").otherwise("many").alias("_label"))
    apart = record_split(rows, "apart", "_label", ("few", "many", "none"), keys=("k",))
    assert {v: count_of(df) for v, df in apart.items()} == {"few": 10, "many": 990, "none": 0}
    assert {v: df.count() for v, df in apart.items()} == {"few": 10, "many": 990, "none": 0}
    assert bound(apart["few"].select("t")).bytes() == 10 * 16 + 20
    assert set(frequent_keys(apart["many"], "k")[1]) == {0, 1, 2, 3}
    whole = apart["few"].unionByName(apart["many"]).unionByName(apart["none"])
    assert bound(whole.select("t")).bytes() == 1000 * 16 + 2000
    assert frequent_keys(whole, "k")[0] == 1000


def test_sketches_of_folders_add_up():
    one = TableStats(100, {"a": 5}, {"k": [["x", 40], ["y", 9]]}, {"n": 1})
    two = TableStats(50, {"a": 6, "b": 1}, {"k": [["x", 2]], "j": []}, {"n": 2})
    assert one.plus(two) == TableStats(150, {"a": 11}, {"k": [["x", 42], ["y", 9]]}, {"n": 3})
    assert TableStats.from_json(one.to_json()) == TableStats(100, {"a": 5}, {"k": [["x", 40], ["y", 9]]})


def test_commits_keep_the_numbers(spark, table, tmp_path):
    lines = table("OrderDetails", [{"staging_raw_id_sk": i, "OrderID": 1 if i % 2 else i, "ProductID": i} for i in range(2000)])
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.publish(warehouse.write(warehouse.snapshot(), [Change("OrderDetails", lines)], {}))
    statistics._known.clear()  # as in another process
    again = warehouse.snapshot()
    assert again.rows("OrderDetails") == 2000
    rows, found = frequent_keys(again.frame("OrderDetails"), "OrderID")
    assert (rows, list(found)) == (2000, [1])
    warehouse.publish(warehouse.write(again, [Change("OrderDetails", lines.limit(5))], {}))
    assert warehouse.snapshot().rows("OrderDetails") == 5
    assert len(warehouse.snapshot().stats) == 1


def test_no_job_reads_a_side_whose_files_exceed_the_bound(spark, sf_dir, monkeypatch, jobs):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    for side in (lines, lines.where("l_quantity > 3").select("l_orderkey"), lines.select("l_orderkey").distinct()):
        assert jobs(lambda side=side: joins.fits_broadcast(side)) == (False, 0)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1 << 40)
    small, n = jobs(lambda: joins.fits_broadcast(lines))  # of small files that nothing is known of
    assert small
    assert n > 0


def test_rejects_of_staged_tables_start_no_job_to_measure(spark, sf_dir, monkeypatch, jobs):
    """Beyond the bound, all jobs of the reject source belong to its writes."""
    loads = registry.samples(spark, sf_dir)
    tables = loads.before(1, "FactOrders")
    dims = registry.fact_dimensions(tables)
    orders, lines = tables.frame("Orders"), tables.frame("OrderDetails")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    source, n = jobs(lambda: facts.reject_source(orders, lines, dims, WINDOWS[1]))
    measured = []
    monkeypatch.setattr(joins, "measured_bytes", lambda df: measured.append(df) or 0)
    facts.reject_source(orders, lines, dims, WINDOWS[1])
    assert not measured
    assert n < 26  # 52 with measuring and sampling; a write runs a job for each shuffle under adaptive execution
    assert source.count() > 0


def test_sketches_of_keys_do_not_pass_the_driver(spark, tmp_path):
    """Each task's sketch has its 50,000 items; what the driver gets is only what is frequent."""
    conf = spark.sparkContext._jsc.sc().conf()
    rows = spark.range(0, 400_000, 1, 8).select(F.when(F.col("id") % 4 == 0, 7).otherwise(F.col("id")).alias("OrderID"), "id")
    conf.set("spark.driver.maxResultSize", "2m")
    try:
        written = record(rows, "sketched", keys=("OrderID", "id"))
        apart = record_split(rows.withColumn("_odd", F.col("id") % 2 == 1), "sketched-apart", "_odd", (True, False), keys=("OrderID",))
        hot, special = colocated.hot_values(rows, "OrderID")
    finally:
        conf.set("spark.driver.maxResultSize", "1g")
    assert frequent_keys(written, "OrderID")[1][7] == pytest.approx(100_000, rel=0.01)
    assert frequent_keys(apart[False], "OrderID")[1][7] == pytest.approx(100_000, rel=0.01)
    assert 7 not in frequent_keys(apart[True], "OrderID")[1]
    assert hot == [7]
    assert special == pytest.approx(100_000, rel=0.01)
