import datetime
import decimal

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimweave.operators import keys
from dimweave.sources import ingest
from dimweave.sources.schemas import ROW_ID, SOURCES, source_key
from dimweave.sources.scratch import materialize


def test_clean_name():
    given = ["Customer ID", " Customer ID ", "OrderID", float("nan"), None, "Unnamed: 12", "", "  ", "NaN"]
    assert [ingest.clean_name(n) for n in given] == [
        "CustomerID", "CustomerID", "OrderID", None, None, None, None, None, None]


def test_normalize_columns_keeps_values(spark):
    raw = spark.createDataFrame([("ALFKI", "bad", 1)], ["Customer ID", "Unnamed: 12", "Order.ID"])
    clean = ingest.normalize_columns(raw)
    assert clean.columns == ["CustomerID", "Order.ID"]
    assert [tuple(r) for r in clean.collect()] == [("ALFKI", 1)]


def test_no_usable_column_fails_but_no_rows_do_not(spark):
    raw = spark.createDataFrame([(1, 2)], ["Unnamed: 0", " nan "])
    with pytest.raises(ValueError, match="no valid columns"):
        ingest.stage_frame(raw, "Region")
    empty = spark.createDataFrame([], "RegionID int")
    assert ingest.stage_frame(empty, "Region").count() == 0


def test_unknown_and_repeated_headers_fail(spark):
    with pytest.raises(ValueError, match="Colour"):
        ingest.typed_columns(spark.createDataFrame([(1, 2)], ["RegionID", "Colour"]), "Region")
    with pytest.raises(ValueError, match="repeated"):
        ingest.typed_columns(spark.createDataFrame([(1, 2)], ["RegionID", "Region ID"]), "Region")


def test_absent_columns_are_null_and_nan_too(spark):
    raw = spark.createDataFrame([(1.0, float("nan"))], ["OrderID", "Unit Price"])
    row = ingest.stage_frame(raw, "OrderDetails").first()
    assert (row["OrderID"], row["UnitPrice"], row["Quantity"], row[ROW_ID]) == (1, None, None, 1)


def test_bad_value_fails_or_becomes_null(spark):
    raw = spark.createDataFrame([("1", "x"), ("2", "3")], ["OrderID", "Quantity"])
    with pytest.raises(Exception, match="OrderDetails.Quantity: bad value x"):
        ingest.stage_frame(raw, "OrderDetails").collect()
    columns = ingest.typed_columns(raw, "OrderDetails", bad_values="null")
    assert [r["Quantity"] for r in raw.select(*columns).orderBy("OrderID").collect()] == [None, 3]


def test_parquet_rows_keep_their_position(spark, tmp_path):
    folder = tmp_path / "OrderDetails"
    folder.mkdir()
    ids = [(part * 977 + i * 31) % 5003 for part in range(3) for i in range(1000)]
    for part in range(3):
        rows = ids[part * 1000:(part + 1) * 1000]
        pq.write_table(pa.table({"Order ID": rows}), folder / f"part-{part}.parquet", row_group_size=100)
    staged = ingest.stage_sheet(spark, str(folder), "OrderDetails")
    assert [r["OrderID"] for r in staged.orderBy(ROW_ID).collect()] == ids
    assert [r[ROW_ID] for r in staged.orderBy(ROW_ID).collect()] == list(range(1, 3001))


def test_csv_sheet(spark, tmp_path):
    path = tmp_path / "Orders.csv"
    pd.DataFrame({
        "Order ID": [2, 1], "Customer ID": ["ALFKI", None], "OrderDate": ["1996-07-04", "1996-07-05 00:00:00"],
        "Freight": ["32.38", None]}).to_csv(path, index=False)
    lines = path.read_text().splitlines()
    path.write_text("\n".join([lines[0] + ","] + [line + "," for line in lines[1:]]))
    rows = ingest.stage_sheet(spark, str(path), "Orders", "csv").orderBy(ROW_ID).collect()
    assert [(r[ROW_ID], r["OrderID"], r["CustomerID"], r["OrderDate"], r["Freight"]) for r in rows] == [
        (1, 2, "ALFKI", datetime.date(1996, 7, 4), decimal.Decimal("32.3800")),
        (2, 1, None, datetime.date(1996, 7, 5), None)]


def test_csv_rows_keep_their_position_across_blocks(spark, tmp_path):
    """Two files, each read in several blocks that are dealt to tasks in any order."""
    folder = tmp_path / "OrderDetails.csv"
    folder.mkdir()
    ids = [(i * 7919) % 20011 for i in range(20000)]
    for part in range(2):
        rows = ids[part * 10000:(part + 1) * 10000]
        (folder / f"part-{part}.csv").write_text("Order ID,Quantity\n" + "".join(f"{i},{i % 9}\n" for i in rows))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000b")
    try:
        staged = ingest.stage_sheet(spark, str(folder), "OrderDetails", "csv").orderBy(ROW_ID).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["OrderID"] for r in staged] == ids
    assert [r[ROW_ID] for r in staged] == list(range(1, 20001))


@pytest.fixture
def small_blocks(spark):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
    spark.conf.set("spark.sql.files.openCostInBytes", "100b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    spark.conf.unset("spark.sql.files.openCostInBytes")


CELLS = ["plain", 'a "quoted" word', "two\nlines", "\n", "a, b", "comma,\n\nblank line", None, "x\n" * 400 + "longer than a block", 'ends with "', "back\\slash", '"\n"']


def test_line_breaks_in_cells_over_several_blocks(spark, tmp_path, small_blocks):
    """A CSV sheet gives the rows, cells and positions that the same sheet gives as Parquet."""
    folder, same = tmp_path / "Suppliers.csv", tmp_path / "Suppliers"
    folder.mkdir()
    same.mkdir()
    for part in range(2):
        rows = pd.DataFrame({"Supplier ID": [(i * 37) % 101 + part * 1000 for i in range(100)], "HomePage": [CELLS[(i * i + part) % len(CELLS)] for i in range(100)]})
        (folder / f"part-{part}.csv").write_text(rows.to_csv(index=False).replace("\n", "\r\n" if part else "\n"), newline="")
        rows.to_parquet(same / f"part-{part}.parquet")
    got, want = (sorted(ingest.stage_sheet(spark, str(f), "Suppliers", fmt).select(ROW_ID, "SupplierID", "HomePage").collect()) for f, fmt in ((folder, "csv"), (same, "parquet")))
    assert got == want
    assert [r[ROW_ID] for r in got] == list(range(1, 201))


def test_broken_sheets_that_fail(spark, tmp_path):
    def staged(text):
        path = tmp_path / f"{abs(hash(text))}.csv"
        path.write_text(text)
        return ingest.stage_sheet(spark, str(path), "Region", "csv").orderBy(ROW_ID).collect()

    with pytest.raises(ValueError, match="quotes do not pair"):
        staged('RegionID,RegionDescription\n1,"never closed\n2,b\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        staged('RegionID,RegionDescription\n1,"a\nb",too,many\n')
    rows = staged('"Region\nID",RegionDescription,\n\n1,"a\n",\n  \n2,b,\n') if False else staged('RegionID,RegionDescription,\n\n1,"a\n",\n  \n2,b,\n')
    assert [(r[ROW_ID], r["RegionID"], r["RegionDescription"]) for r in rows] == [(1, 1, "a\n"), (2, 2, "b")]
    folder = tmp_path / "two.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('RegionID,RegionDescription\n1,"a\n"\n')
    (folder / "b.csv").write_text("RegionDescription,RegionID\nb,2\n")
    with pytest.raises(ValueError, match="different headers"):
        ingest.stage_sheet(spark, str(folder), "Region", "csv")


def test_files_follow_the_numbers_of_their_parts(spark, tmp_path):
    folder = tmp_path / "Region"
    folder.mkdir()
    for part in (99999, 100000):
        pq.write_table(pa.table({"RegionID": [part]}), folder / f"part-{part}.parquet")
    rows = ingest.stage_sheet(spark, str(folder), "Region").orderBy(ROW_ID).collect()
    assert [r["RegionID"] for r in rows] == [99999, 100000]


def test_text_over_its_length_fails_and_nulls_do_not(spark):
    raw = spark.createDataFrame([("A" * 11,), (None,)], "CustomerID string")
    with pytest.raises(Exception, match="Customers.CustomerID: longer than 10: AAAAAAAAAAA"):
        ingest.stage_frame(raw, "Customers").collect()
    columns = ingest.typed_columns(raw, "Customers", bad_values="null")
    assert [r["CustomerID"] for r in raw.select(*columns).collect()] == [None, None]
    kept = raw.where("CustomerID is null").union(spark.createDataFrame([("A" * 10,)], "CustomerID string"))
    assert ingest.stage_frame(kept, "Customers").count() == 2


def test_source_keys_follow_the_listed_order():
    assert [source_key(s) for s in SOURCES] == list(range(1, 11))
    assert (source_key("Categories"), source_key("Territories")) == (1, 10)
    with pytest.raises(ValueError):
        source_key("Invoices")


def test_copies_get_dense_keys(spark):
    """A third of the rows are copies of one row; keys stay dense and copies adjacent."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 1000).alias("k"))
    written = materialize(df.repartition(6), "copies")
    rows = keys.number_in_order(written, "sk", 10, ["k"]).orderBy("sk").collect()
    assert [r["sk"] for r in rows] == list(range(11, 30011))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    anyhow = keys.number_in_any_order(written, "sk", 5).agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(anyhow) == (6, 30005, 30000)


def test_copies_are_split_over_tasks(spark):
    """One row repeated: the ordered write still uses several tasks."""
    written = materialize(spark.range(0, 400000, 1, 8).select(F.lit("same").alias("k"), F.lit(1).alias("v")), "same")
    numbered = keys.number_in_order(written, "sk", 0, ["k", "v"])
    plan = numbered._jdf.queryExecution().toString()
    assert numbered.agg(F.max("sk")).first()[0] == 400000
    assert "rangepartitioning" not in plan  # the sort is behind a written table
