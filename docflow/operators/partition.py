"""Partition-level transforms with setup and cleanup (PAR-1..3, UDF-3).

User code runs on Arrow record batches (``mapInArrow``): one setup per
partition, then a function per batch, then cleanup — in a ``try/finally`` of a
generator, so cleanup runs after the last batch and nothing buffers a whole
partition. Output batches may be smaller than the input (rows dropped) or empty.
Tasks are retried as a whole after an executor loss, so setup/cleanup must be
idempotent per partition (they are re-run with the task).
"""

from __future__ import annotations

from typing import Any, Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BatchFn = Callable[[pa.RecordBatch, Any], pa.RecordBatch | None]


def map_partitions(
    df: DataFrame,
    fn: BatchFn,
    schema: T.StructType | str | None = None,
    setup: Callable[[], Any] | None = None,
    cleanup: Callable[[Any], None] | None = None,
) -> DataFrame:
    """Apply ``fn(batch, state)`` to every Arrow batch; ``state = setup()`` once per
    partition and ``cleanup(state)`` after the last batch (PAR-1 / PAR-2).
    ``schema`` is the output schema (default: the input's)."""
    out_schema = schema if schema is not None else df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        try:
            for batch in batches:
                out = fn(batch, state)
                if out is not None and out.num_rows:
                    yield out
        finally:
            if cleanup:
                cleanup(state)

    return df.mapInArrow(run, out_schema)


def passthrough(batch: pa.RecordBatch, state: Any) -> pa.RecordBatch:
    """Identity batch function (the pass-through of PAR-1)."""
    return batch


def drop_value(column: str, value: Any) -> BatchFn:
    """Batch function that drops rows whose ``column`` equals ``value`` (PAR-3);
    a null never equals the value, so null rows are kept."""

    def fn(batch: pa.RecordBatch, state: Any) -> pa.RecordBatch:
        hit = pc.fill_null(pc.equal(batch.column(column), pa.scalar(value)), False)
        return batch.filter(pc.invert(hit))

    return fn


def drop_rows_in_partitions(df: DataFrame, column: str, value: Any) -> DataFrame:
    """PAR-3: partition map whose output omits the rows with ``column == value``."""
    return map_partitions(df, drop_value(column, value))
