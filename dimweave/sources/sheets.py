"""CSV sheets whose cells hold line breaks, read in splits.

A line break belongs to a cell if an odd number of quotes stands before it in the file. Each block of a file counts
the quotes of its lines by itself; a running sum over blocks, one row for each, tells whether a block begins within a cell.
Then every line knows its record, also where that began in an earlier block. Lines that are whole records stay where
they are; only the lines of broken records are brought together. Breaks in cells become ``\\n``, whatever the file uses.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimweave.operators.joins import fits_broadcast
from dimweave.operators.keys import BLOCK, FILE, ROW, block_columns, file_order
from dimweave.sources.scratch import materialize
from dimweave.sources.statistics import record

#: Quotes within a quoted cell are doubled, as spreadsheets write them.
CSV_OPTIONS = {"mode": "FAILFAST", "escape": '"'}
_LINE, _ODD = "value", "_odd"


def _odd_quotes(line: str) -> Column:
    return F.pmod(F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit(""))), F.lit(2))


def has_broken_cells(spark: SparkSession, path: str) -> bool:
    """Whether some line of the sheet ends within a cell; a scan that stops at the first such line."""
    return not spark.read.text(path).where(_odd_quotes(_LINE) == 1).isEmpty()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the running numbers of lines in their block that have an even and an odd number of quotes before them."""
    lines = spark.read.text(path).select(_LINE, _odd_quotes(_LINE).alias(_ODD), *block_columns())
    order = Window.partitionBy(FILE, BLOCK).orderBy(ROW)
    before = F.pmod(F.coalesce(F.sum(_ODD).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(2))
    lines = lines.withColumn("_within", before)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = [F.sum((F.col("_within") == side).cast("long")).over(upto).alias(f"_at{side}") for side in (0, 1)]
    return materialize(lines.select("*", *running), "sheet-lines")


def _blocks(lines: DataFrame) -> DataFrame:
    """For each block: whether it begins within a cell, and the block and number of the record that is open there."""
    totals = lines.groupBy(FILE, BLOCK).agg(F.pmod(F.sum(_ODD), F.lit(2)).alias("_own"), F.max("_at0").alias("_at0"), F.max("_at1").alias("_at1"))
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    begun = totals.withColumn("_begins", F.pmod(F.coalesce(F.sum("_own").over(earlier), F.lit(0)), F.lit(2)))
    starts = F.when(F.col("_begins") == 0, F.col("_at0")).otherwise(F.col("_at1"))
    last = F.last(F.when(starts > 0, F.struct(F.col(BLOCK).alias("block"), starts.alias("number"))), ignorenulls=True).over(earlier)
    return begun.select(FILE, BLOCK, "_begins", last.alias("_open"))


def _records(lines: DataFrame) -> DataFrame:
    """File, block and number in the block of each record, with its text."""
    blocks = record(_blocks(lines), "sheet-blocks")
    if fits_broadcast(blocks):
        blocks = F.broadcast(blocks)
    number = F.when(F.col("_begins") == 0, F.col("_at0")).otherwise(F.col("_at1"))
    placed = lines.join(blocks, [FILE, BLOCK]).withColumn("_number", number)
    starts = F.col("_within") == F.col("_begins")
    whole = placed.where(starts & (F.col(_ODD) == 0)).select(FILE, BLOCK, F.col("_number").alias(ROW), _LINE)
    own = F.when(F.col("_number") > 0, F.struct(F.col(BLOCK).alias("block"), F.col("_number").alias("number"))).otherwise(F.col("_open"))
    pieces = placed.where(~(starts & (F.col(_ODD) == 0))).select(FILE, own.alias("_own"), F.struct(BLOCK, ROW, _LINE).alias("_piece"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("_piece")), lambda p: p[_LINE]), "\n")
    broken = pieces.groupBy(FILE, "_own").agg(joined.alias(_LINE)).select(FILE, F.col("_own.block").alias(BLOCK), F.col("_own.number").alias(ROW), _LINE)
    return whole.union(broken)


def read_broken_sheet(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The rows of a CSV sheet with breaks in cells, and the columns that tell their place.

    The first record of each file is its header. A file whose quotes do not pair, or whose header is not that of the others,
    fails; so does a row with too many or too few cells. Lines without any text between records are no rows.
    """
    lines = _lines(spark, path)
    unpaired = lines.groupBy(FILE).agg(F.sum(_ODD).alias("n")).where("n % 2 = 1").select(FILE).first()
    if unpaired:
        raise ValueError(f"{unpaired[0]}: quotes do not pair")
    records = materialize(_records(lines).where(F.trim(_LINE) != ""), "sheet-records")
    headers = records.groupBy(FILE).agg(F.min_by(_LINE, F.struct(BLOCK, ROW)).alias("header"), F.min(F.struct(BLOCK, ROW)).alias("at"))
    found = [r["header"] for r in headers.orderBy(*file_order()).select("header").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{path}: files have different headers")
    names = next(csv.reader(io.StringIO(found[0], newline="")))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    headers = headers.select(F.col(FILE).alias("_f"), "at")
    if fits_broadcast(headers := record(headers, "sheet-headers")):
        headers = F.broadcast(headers)
    is_header = (F.col(FILE) == F.col("_f")) & (F.struct(BLOCK, ROW) == F.col("at"))
    rows = records.join(headers, is_header, "left_anti").withColumn("_cells", F.from_csv(_LINE, schema, CSV_OPTIONS))
    # A number within a block is dense again, now that headers and blank lines are gone.
    dense = F.row_number().over(Window.partitionBy(FILE, BLOCK).orderBy(ROW))
    cells = [F.col(f"_cells.c{i}").alias(name) for i, name in enumerate(names) if name.strip()]
    return rows.select(*cells, FILE, BLOCK, dense.alias(ROW)), [FILE, BLOCK, ROW]
