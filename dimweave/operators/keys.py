"""Dense surrogate keys without a single-task stage over the rows.

The rows are written once; each then has a fixed place (file, row index). Rows per file come
from the file footers, a running sum over files gives each file its first key, and a key is that plus
the row index. Only the running sum, one row for each file or block, is a single task; it is broadcast
where it is small and joined by hash otherwise. A stated order costs one range sort before the write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimweave.operators.joins import fits_broadcast
from dimweave.sources.scratch import materialize
from dimweave.sources.statistics import collect_shuffles, record

FILE, ROW, BLOCK = "_key_file", "_key_row", "_key_block"
_SHORT = ["_key_part", "_key_piece", "_key_path"]


def file_order() -> list[Column]:
    """Files by folder, then by the number of a writer's part, then by name."""
    number = F.regexp_extract(FILE, r"/part-(\d+)[^/]*$", 1)
    return [F.regexp_extract(FILE, r"^(.*)/", 1), F.when(number != "", number.cast("long")), F.col(FILE)]


def _number_by_place(placed: DataFrame, column: str, last_key: int, within: tuple[str, ...] = ()) -> DataFrame:
    place = [FILE, *within]
    earlier = Window.orderBy(*file_order(), *within).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"), F.min(ROW).alias("_first"))
               .select(*place, (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_before")))
    offsets = record(offsets, "offsets")
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    key = (F.lit(last_key + 1) + F.col("_before") + F.col(ROW)).cast("long")
    return placed.join(offsets, place).select(key.alias(column), *[c for c in placed.columns if c not in (*place, ROW)])


def place_columns() -> list[Column]:
    """File and row index of each row; only for frames read straight from Parquet files."""
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)]


def _short_place() -> list[Column]:
    """``place_columns()`` with three numbers for the file, as its path would make up most of a row that is sorted.

    A writer's files by part, then by their number within the part; a hash tells files of several folders apart.
    """
    path = F.col("_metadata.file_path")
    number = [F.regexp_extract(path, pattern, 1).try_cast("int") for pattern in (r"/part-(\d+)[^/]*$", r"[-.]c(\d+)[^/]*$")]
    return [c.alias(name) for c, name in zip((*number, F.xxhash64(path)), _SHORT, strict=True)] + [F.col("_metadata.row_index").alias(ROW)]


def number_by_position(placed: DataFrame, column: str, last_key: int = 0) -> DataFrame:
    """Keys ``last_key + 1 ..`` in file and row order for a frame with ``place_columns()``."""
    return _number_by_place(placed, column, last_key)


def block_columns() -> list[Column]:
    """File, block and running number of each row; only for frames read straight from text files.

    A task reads a block from start to end, so the running numbers of a block ascend without gaps. They differ
    from run to run, hence the frame must be written before its rows are numbered.
    """
    return [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(ROW)]


def number_by_block(written: DataFrame, column: str, last_key: int = 0) -> DataFrame:
    """Keys ``last_key + 1 ..`` in file, block and row order for a written frame with ``block_columns()``."""
    return _number_by_place(written, column, last_key, (BLOCK,))


def number_in_any_order(written: DataFrame, column: str, last_key: int = 0) -> DataFrame:
    """Keys for every row of a written table, or of whole partition folders of it. No shuffle."""
    return number_by_position(written.select("*", *place_columns()), column, last_key)


def number_in_order(written: DataFrame, column: str, last_key: int, order_by: list[str],
                    rows: int | None = None) -> DataFrame:
    """Keys in the order of ``order_by`` (NULLs first); rows equal on all of it are told apart by place.

    ``written`` must be read straight from Parquet files, see ``materialize``. With ``rows`` known
    to be 0 the sort is left out.
    """
    if rows == 0:
        return written.select(F.lit(None).cast("long").alias(column), "*")
    in_place = written.select("*", *_short_place())
    ranged = in_place.orderBy(*[F.col(c).asc_nulls_first() for c in order_by], *_SHORT, ROW)
    table = materialize(ranged.drop(*_SHORT, ROW), f"ordered-{column}")
    collect_shuffles(written)
    # Writer task n writes part-n in range order; several files of one task end in a running number.
    return _number_by_place(table.select("*", *place_columns()), column, last_key)
