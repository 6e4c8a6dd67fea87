"""Ingest of source sheets: clean headers, apply the declared types, number the rows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimweave.operators import keys
from dimweave.sources.schemas import ROW_ID, STAGING, staged_schema
from dimweave.sources.scratch import materialize
from dimweave.sources.sheets import CSV_OPTIONS, has_broken_cells, read_broken_sheet
from dimweave.sources.statistics import collect_shuffles, discard


def clean_name(name) -> str | None:
    """Header without spaces, or None for a blank one."""
    if name is None or name != name:
        return None
    cleaned = str(name).strip().replace(" ", "")
    if not cleaned or cleaned.lower() == "nan" or cleaned.startswith("Unnamed:"):
        return None
    return cleaned


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _kept(df: DataFrame) -> list[tuple[str, str]]:
    return [(c, clean_name(c)) for c in df.columns if clean_name(c)]


def normalize_columns(df: DataFrame) -> DataFrame:
    """Drop blank headers and remove spaces from the others."""
    return df.select(*[_quoted(old).alias(new) for old, new in _kept(df)])


def _nan_to_null(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def normalize_nulls(df: DataFrame) -> DataFrame:
    """NaN becomes NULL."""
    return df.select(*[_nan_to_null(_quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def typed_columns(df: DataFrame, source: str, bad_values: str = "fail") -> list[Column]:
    """The declared columns of ``source`` out of a raw sheet.

    An unknown header fails, an absent column is NULL. A value that does not fit its type, or a
    text longer than declared, fails the load, or becomes NULL with ``bad_values="null"``.
    """
    kept = _kept(df)
    if not kept:
        raise ValueError(f"{source}: no valid columns found")
    repeated = [n for n, times in Counter(new for _, new in kept).items() if times > 1]
    unknown = sorted({new for _, new in kept} - set(STAGING[source].names))
    if repeated or unknown:
        raise ValueError(f"{source}: unknown columns {unknown}, repeated columns {repeated}")
    raw = {new: old for old, new in kept}
    out = []
    for f in STAGING[source].fields:
        if f.name not in raw:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        given = df.schema[raw[f.name]].dataType
        value = _nan_to_null(_quoted(raw[f.name]), given)
        typed = value if given == f.dataType else value.try_cast(f.dataType)
        if bad_values == "fail" and given != f.dataType:
            message = F.concat(F.lit(f"{source}.{f.name}: bad value "), value.cast("string"))
            typed = F.when(value.isNotNull() & typed.isNull(), F.raise_error(message)).otherwise(typed)
        limit = f.metadata.get("max_length")
        if limit:
            message = F.concat(F.lit(f"{source}.{f.name}: longer than {limit}: "), typed)
            too_long = F.raise_error(message) if bad_values == "fail" else F.lit(None)
            typed = F.when(F.length(typed) > limit, too_long).otherwise(typed)
        out.append(typed.alias(f.name))
    return out


def stage_frame(df: DataFrame, source: str, also_order_by: tuple[str, ...] = ()) -> DataFrame:
    """Stage any DataFrame as ``source``; row ids follow the order of all columns.

    A DataFrame has no row order of its own. ``also_order_by`` names extra columns of ``df`` that are only
    used to order rows, after all others. Where a sheet's position matters, stage its files.
    """
    extra = [df[c] for c in also_order_by]
    table = df.drop(*also_order_by)
    written = materialize(df.select(*typed_columns(table, source), *extra), f"raw-{source}")
    collect_shuffles(df)
    order = [c for c in STAGING[source].names if c in table.columns] + list(also_order_by)
    numbered = keys.number_in_order(written, ROW_ID, 0, order).select(*staged_schema(source).names)
    discard(written)  # its rows are in the ordered table
    return numbered


def read_sheet(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A raw sheet. CSV headers that are blank are dropped, as spreadsheets leave them."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported source format {fmt!r}")
    df = spark.read.option("header", True).options(**CSV_OPTIONS).csv(path)
    return df.drop(*[c for c in df.columns if c.startswith("_c") and c[2:].isdigit()])


def stage_sheet(spark: SparkSession, path: str, source: str, fmt: str = "parquet",
                bad_values: str = "fail") -> DataFrame:
    """Stage a sheet from files.

    Rows keep their place: the row id is the position in the sheet (files by name and number), without
    a sort. Parquet files tell it; CSV rows are written once with the block they were read from. A CSV sheet with line breaks
    in quoted cells is read by records, which costs a shuffle by block.
    """
    if fmt == "csv" and has_broken_cells(spark, path):
        raw, place = read_broken_sheet(spark, path)
        columns = typed_columns(raw.drop(*place), source, bad_values)
        return keys.number_by_block(materialize(raw.select(*columns, *place), f"raw-{source}"), ROW_ID)
    raw = read_sheet(spark, path, fmt)
    columns = typed_columns(raw, source, bad_values)
    if fmt == "parquet":
        placed = raw.select(*columns, *keys.place_columns())
        return keys.number_by_position(placed, ROW_ID)
    written = materialize(raw.select(*columns, *keys.block_columns()), f"raw-{source}")
    return keys.number_by_block(written, ROW_ID)
