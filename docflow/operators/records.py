"""REC-1..5: align a (nested) DataFrame to a target table schema.

Fields are matched by name, recursively through structs and arrays of structs;
missing fields become null; types are cast. Two conversions are not plain casts:

* bigint → timestamp uses the unit declared on the target field
  (``metadata={"unit": "micros"|"millis"}``, default micros, as for a
  ``timestamp-micros`` column) — REC-4;
* binary → decimal reads big-endian two's-complement bytes at the target's
  scale — REC-5 / FN-12.

Everything is one projection of built-in expressions (``transform`` for arrays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binary import be_bytes_to_decimal
from ..functions.convert import PERMISSIVE, STRICT


def _convert(c: Column, src: T.DataType, dst: T.DataType, meta: dict, mode: str) -> Column:
    if isinstance(dst, T.StructType):
        if not isinstance(src, T.StructType):
            raise TypeError(f"cannot align {src.simpleString()} to {dst.simpleString()}")
        return F.when(c.isNotNull(), _struct(c, src, dst, mode))
    if isinstance(dst, T.ArrayType):
        if not isinstance(src, T.ArrayType):
            raise TypeError(f"cannot align {src.simpleString()} to {dst.simpleString()}")
        if src.elementType == dst.elementType:
            return c
        return F.transform(c, lambda x: _convert(x, src.elementType, dst.elementType, meta, mode))
    if isinstance(dst, T.TimestampType) and isinstance(src, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(c) if meta.get("unit") == "millis" else F.timestamp_micros(c)
    if isinstance(dst, T.DecimalType) and isinstance(src, T.BinaryType):
        return be_bytes_to_decimal(c, dst.scale, dst.precision, mode)
    if src == dst:
        return c
    if isinstance(dst, T.StringType):
        return c.cast(dst)
    # the same whatever the session's ANSI flag says
    cast = c.try_cast(dst)
    if mode == PERMISSIVE:
        return cast
    message = F.concat(F.lit(f"cannot convert to {dst.simpleString()}: '"), c.cast("string"), F.lit("'"))
    return F.coalesce(cast, F.when(c.isNotNull(), F.raise_error(message)))


def _required(c: Column, f: T.StructField, mode: str) -> Column:
    if f.nullable or mode == PERMISSIVE:
        return c
    return F.coalesce(c, F.raise_error(F.lit(f"missing value for the required field {f.name}")))


def _struct(c: Column, src: T.StructType, dst: T.StructType, mode: str) -> Column:
    by_name = {f.name: f for f in src.fields}
    parts = []
    for f in dst.fields:
        s = by_name.get(f.name)
        v = F.lit(None).cast(f.dataType) if s is None else _convert(c.getField(f.name), s.dataType, f.dataType, f.metadata, mode)
        parts.append(_required(v, f, mode).alias(f.name))
    return F.struct(*parts)


def align_to_schema(df: DataFrame, schema: T.StructType, mode: str = STRICT) -> DataFrame:
    """Project ``df`` onto ``schema`` (by name, recursively, with casts). A value
    that does not convert and a missing required value raise in strict mode and
    are null in permissive mode."""
    by_name = {f.name: f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        s = by_name.get(f.name)
        if s is None:
            cols.append(_required(F.lit(None).cast(f.dataType), f, mode).alias(f.name))
        else:
            cols.append(_required(_convert(F.col(f"`{f.name}`"), s.dataType, f.dataType, f.metadata, mode), f, mode).alias(f.name))
    return df.select(*cols)
