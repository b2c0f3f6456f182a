"""Passing a table's other columns through an Arrow pass, whatever they are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(documents: DataFrame, run: Callable, new: list[tuple[str, T.DataType]], drop: tuple[str, ...] = (), **inputs: Column) -> DataFrame:
    """``documents`` (without ``drop`` and columns named as new ones) plus the ``new``
    columns that ``run`` makes. ``run`` maps Arrow batches of the column ``row`` (all
    kept columns as one struct) and the ``inputs`` to batches of ``row`` and the new ones."""
    names = {n for n, _ in new}
    keep = [c for c in documents.columns if c not in names and c not in drop]
    row = F.struct(F.lit(True).alias(free_name(keep, "any")), *[F.col(f"`{c}`") for c in keep])
    packed = documents.select(row.alias("row"), *[c.alias(n) for n, c in inputs.items()])
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), *[T.StructField(n, t) for n, t in new]])
    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *[F.col(n) for n, _ in new])
