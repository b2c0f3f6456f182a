"""Vectors as exact integers: which rows take part, and Arrow lists as matrices."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components are held within this; squared distances over 64 of them fit 64 bits.
HELD = 1 << 27


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return vector.isNotNull() & fine


def id_and_vector(rows: DataFrame, id_col: str, vector_col: str, *others: Column) -> DataFrame:
    """``vec_id``, ``vector`` (doubles) and ``others`` of the rows that :func:`usable` keeps."""
    picked = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"), *others)
    return picked.where(usable(F.col("vector")))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as int64, held within ``HELD``; ``scale`` is a power of two, so it is exact."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * float(scale)), -HELD, HELD).astype(np.int64)


def matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Lists of ``dims`` doubles each as an integer matrix."""
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)


def one_list(values: pa.Array) -> pa.Array:
    """An Arrow column of one row that is the list of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
