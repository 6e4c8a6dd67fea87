"""Change detection: NULL counts as a fixed value of the column's type."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _null_stand_in(kind: T.DataType) -> Column:
    # What NULL compares equal to.
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.DateType):
        return F.lit(datetime.date(1900, 1, 1))
    return F.lit(-1).cast(kind)


def with_collation(column: Column, kind: T.DataType, collation: str | None) -> Column:
    """``column`` under a text collation; other types and no collation leave it as it is."""
    if collation and isinstance(kind, T.StringType):
        return F.collate(column, collation)
    return column


def differs(left: Column, right: Column, kind: T.DataType, collation: str | None = None) -> Column:
    """True when two values differ; NULL equals '' (text), -1 (numbers, flags), 1900-01-01 (dates)."""
    if isinstance(kind, T.BooleanType):
        left, right, kind = left.cast("int"), right.cast("int"), T.IntegerType()
    stand_in = _null_stand_in(kind)
    left = with_collation(F.coalesce(left, stand_in), kind, collation)
    right = with_collation(F.coalesce(right, stand_in), kind, collation)
    return left != right


def any_differs(old: str, new: str, fields: list[T.StructField], collation: str | None = None) -> Column:
    """True when any of ``fields`` differs between the struct columns ``old`` and ``new``."""
    return reduce(or_, [differs(F.col(f"{old}.{f.name}"), F.col(f"{new}.{f.name}"), f.dataType, collation)
                        for f in fields])


def zero_if_null(column: str, kind: T.DataType) -> Column:
    """``column`` with NULL as zero, in the column's own type so that decimals do not widen."""
    return F.coalesce(F.col(column), F.lit(0).cast(kind))
