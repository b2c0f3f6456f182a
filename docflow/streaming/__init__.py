"""Structured Streaming use of the same operators.

``extract_xml`` and ``lookup_with_default`` are stateless (a projection and a
stream-static join), so they apply unchanged to a streaming DataFrame. This
module adds the sink side: an append to files with a checkpoint in the cluster's
shared folder, run once over what is available (``availableNow``) or continuously;
and a lookup whose reference is looked at anew with every micro-batch
(:func:`append_with_fresh_lookup`).
"""

from __future__ import annotations

import hashlib
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.lookup import lookup_with_default
from ..session import _hadoop_path, checkpoint_base, source_version
from ..sources.sinks import _read, _write


def sink_checkpoint(spark: SparkSession, path: str) -> str:
    """The checkpoint folder of the sink ``path``: the same for every run into it."""
    sink = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = sink.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(sink).toString()
    name = hashlib.sha256(full.rstrip("/").encode()).hexdigest()
    return "/".join([checkpoint_base(spark).rstrip("/"), "stream-checkpoints", name])


def append_stream(
    df: DataFrame,
    path: str,
    *,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start ``df.writeStream`` in append mode to ``path``. Unless given, the
    checkpoint is the folder of the shared ``spark.checkpoint.dir`` that belongs
    to this sink path: another run into the same sink goes on where the last one
    stopped, so every input file is written exactly once."""
    cp = checkpoint or sink_checkpoint(df.sparkSession, path)
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", cp)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path)


def run_available_now(df: DataFrame, path: str, **kw) -> None:
    """Process everything available now, then stop (batch-like run of a stream)."""
    q = append_stream(df, path, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream source with a fixed schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _snapshot(spark: SparkSession, sink: str, batch_id: int, reference: Callable[[], DataFrame], sources: Iterable[str]) -> DataFrame:
    """The reference of a micro-batch: the sources' present state, written once per version.
    The first attempt at a batch notes its version, so an attempt after a failure reads
    the same rows whatever the sources hold by then."""
    note = f"{sink}/_reference/batch-{batch_id}"
    path, fs = _hadoop_path(spark, note)
    if fs.exists(path):
        version = _read(spark, fs, path)
    else:
        version = hashlib.sha256(source_version(spark, *sources).encode()).hexdigest()[:24]
        folder = f"{sink}/_reference/{version}"
        if not fs.exists(_hadoop_path(spark, folder + "/_SUCCESS")[0]):
            reference().write.mode("overwrite").parquet(folder)
        _write(spark, note, version)
    return spark.read.parquet(f"{sink}/_reference/{version}")


def append_with_fresh_lookup(
    stream: DataFrame,
    reference: Callable[[], DataFrame],
    sources: Iterable[str],
    key: str,
    ref_key: str,
    ref_value: str,
    out_col: str,
    path: str,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    **lookup,
) -> StreamingQuery:
    """LKP-1 in a stream whose reference changes: every micro-batch is looked up in the
    reference as it is when the batch is first tried (``reference()`` reads it; ``sources``
    are the paths whose files tell its version; an unchanged version is neither read nor
    written again), and written as a folder of its own, ``batch=<id>``, under ``path``.

    A batch that is tried again (a restart after a failure) overwrites its folder with the
    same rows from the same snapshot, so each input row is written once. The snapshots lie
    in ``path/_reference``, which readers of the sink pass over. Read the sink with
    :func:`read_batches`."""
    sources, path = list(sources), path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        ref = _snapshot(batch.sparkSession, path, batch_id, reference, sources)
        rows = lookup_with_default(batch, ref, key, ref_key, ref_value, out_col, **lookup)
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    cp = checkpoint or sink_checkpoint(stream.sparkSession, path)
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", cp)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows that :func:`append_with_fresh_lookup` wrote, with the ``batch`` of each."""
    return spark.read.parquet(path)
