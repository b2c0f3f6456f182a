"""Projections, filters and count (PRJ-1, 3, 4, 6, FLT-1..2, AGG-2, FN-15).

All narrow, built-in expressions except ``count_rows`` (partial + final count).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binary import decode_utf8


def add_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """PRJ-1: ``withColumn``."""
    return df.withColumn(name, expr)


def decode_column(df: DataFrame, col: str) -> DataFrame:
    """PRJ-3 / PRJ-5 / FN-11: the binary column ``col`` becomes UTF-8 text in place;
    other columns unchanged. Invalid bytes become U+FFFD; null stays null."""
    return df.select(*[decode_utf8(F.col(f"`{c}`")).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


def reproject(df: DataFrame, exprs: Sequence[Column], names: Sequence[str] | None = None) -> DataFrame:
    """PRJ-4: positional projection, then column names restored (by default the input's)."""
    names = list(names) if names is not None else df.columns
    if len(names) != len(exprs):
        raise ValueError(f"{len(exprs)} expressions for {len(names)} names")
    return df.select(*exprs).toDF(*names)


def map_column(df: DataFrame, col: str, fn: Callable[[Column], Column], out_type: T.DataType | str) -> DataFrame:
    """PRJ-6: element-wise map of one column; the result type is fixed by ``out_type``."""
    return df.withColumn(col, fn(F.col(col)).cast(out_type))


def square(c: Column) -> Column:
    """FN-15."""
    return c * c


def drop_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """FLT-1: remove the rows where ``predicate`` is true (null counts as false)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def equals_value(c: Column, value) -> Column:
    """FLT-2: null-safe equality with a literal."""
    return c.eqNullSafe(F.lit(value))


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """AGG-2 as a one-row DataFrame (stays lazy, unlike ``df.count()``)."""
    return df.agg(F.count(F.lit(1)).alias(name))
