"""Rows that the second batch adds have keys of their own, however large the keys of the tables are."""

from pyspark.sql import functions as F

from dimweave.plans import samples


def test_added_rows_keep_out_of_the_way_of_large_keys(spark):
    rows = spark.range(0, 1_000_100).select(F.col("id").alias("ProductID"), F.lit("p").alias("ProductName"))
    kept = rows.where("ProductID % 17 <> 3")
    added = samples._under_new_keys(rows, kept, "ProductID", 11)
    keys = [r["ProductID"] for r in added.collect()]
    assert len(keys) == len(set(keys)) == rows.where("ProductID % 11 = 0").count()
    assert kept.join(added, "ProductID").count() == 0
    # A raised key that is free stays as it is, so small tables give the rows that they gave.
    free = {k + samples.NEW_KEYS for k in range(0, 1_000_100, 11) if k + samples.NEW_KEYS >= 1_000_100 or (k + samples.NEW_KEYS) % 17 == 3}
    assert {k for k in keys if k < samples.BEYOND} == free
    assert len(keys) - len(free) == 9
    assert min(k for k in keys if k not in free) == samples.BEYOND


def test_small_tables_give_the_added_rows_that_they_gave(spark):
    rows = spark.createDataFrame([(k,) for k in (0, 7, 11, 20, 22, 30, None)], "SupplierID long")
    added = samples._under_new_keys(rows, rows, "SupplierID", 10)
    assert sorted(r[0] for r in added.collect()) == [1000000, 1000020, 1000030]
