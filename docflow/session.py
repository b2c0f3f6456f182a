"""Session defaults and the shared folder for materialised intermediate data."""

from __future__ import annotations

import re
import threading
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "docflow", conf: dict | None = None) -> SparkSession:
    """A session with AQE (coalescing, skew-join splitting) and UTC on.
    On a cluster, pass no master and let the submit configuration decide."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **(conf or {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate data.

    Read from the session: ``spark.checkpoint.dir`` as configured, else a
    directory set with ``setCheckpointDir``. With neither, a ``local`` master
    (one machine, tests) gets a folder under the warehouse; any other master is
    an error, because the driver's own disk is not the executors'.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        wh = spark.conf.get("spark.sql.warehouse.dir")
        sc.setCheckpointDir(wh.rstrip("/") + "/_docflow_checkpoints")
        base = sc.getCheckpointDir()
    return base


def _application_dir(spark: SparkSession) -> str:
    return "/".join([checkpoint_base(spark).rstrip("/"), "docflow-" + spark.sparkContext.applicationId])


#: The folders written by the step that the present thread is in, if any.
_STEP: ContextVar[list[str] | None] = ContextVar("docflow_step", default=None)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under this application's part of :func:`checkpoint_base`."""
    path = "/".join([_application_dir(spark), *parts, uuid.uuid4().hex])
    step = _STEP.get()
    if step is not None:
        step.append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession, *, keep: list[str] | None = None):
    """What the present thread writes to the shared folder inside this block is deleted
    at its end, but for tables that other jobs share (:func:`derived_table`) and the
    folders added to ``keep``. Blocks may nest, and run in several threads at a time."""
    mine: list[str] = []
    token = _STEP.set(mine)
    try:
        yield
    finally:
        _STEP.reset(token)
        stay = {*(keep or ()), *_DERIVED.values()}
        for path in mine:
            if path not in stay:
                drop_folder(spark, path)
        outer = _STEP.get()
        if outer is not None:
            outer.extend(keep or ())


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_intermediates(spark: SparkSession) -> None:
    """Deletes what this application wrote to the shared folder (materialised and
    derived tables). Call it when the results that read them are written, at the
    latest before ``spark.stop()``; stream checkpoints stay."""
    path, fs = _hadoop_path(spark, _application_dir(spark))
    fs.delete(path, True)
    with _DERIVING:
        for k in [k for k in _DERIVED if k[0] == spark.sparkContext.applicationId]:
            del _DERIVED[k]


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to a fresh folder under the shared checkpoint folder and
    read it back: the lineage is cut (a lost executor does not recompute it) and
    later size checks read the written table instead of recomputing ``df``."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def materialize_step(spark: SparkSession, build, name: str) -> tuple[DataFrame, str]:
    """``build()`` materialised, and its folder. What the step itself wrote to the
    shared folder on the way is deleted once the result is complete, so a chain of
    steps holds one step's intermediates at a time."""
    kept: list[str] = []
    with intermediates(spark, keep=kept):
        df = build()
        path = shared_dir(spark, name)
        df.write.parquet(path)
        kept.append(path)
    return spark.read.parquet(path), path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes one folder of :func:`shared_dir`."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def source_version(spark: SparkSession, *paths: str) -> str:
    """What changes when files of the source paths do: bytes, file count and the
    time of the last change, from one file system call each per path."""
    parts = []
    for p in paths:
        path, fs = _hadoop_path(spark, p)
        held = fs.getContentSummary(path)
        parts.append(f"{p}:{held.getLength()}:{held.getFileCount()}:{fs.getFileStatus(path).getModificationTime()}")
    return "|".join(parts)


_DERIVED: dict[tuple[str, str], str] = {}
_DERIVING = threading.RLock()


def derived_table(spark: SparkSession, key: str, build, sources: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> str:
    """A derived input shared by several jobs of one application (such as the
    order documents built from ``orders`` + ``lineitem``): ``build()`` is
    written once to a fresh folder under the shared checkpoint folder, and every
    call with the same ``key`` and unchanged ``sources`` (paths) in the same
    application scans that table instead of re-running the build (its shuffles
    included). The folder is registered only after the write commits, so a
    failed build is simply redone; threads that ask at once wait for one build.
    ``partition_by``: columns of few values that readers filter on."""
    k = (spark.sparkContext.applicationId, f"{key}|{source_version(spark, *sources)}")
    with _DERIVING:
        path = _DERIVED.get(k)
        if path is None:
            path = shared_dir(spark, "derived")
            build().write.partitionBy(*partition_by).parquet(path)
            _DERIVED[k] = path
        return path


MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def size_checked(df: DataFrame, max_rows: int, *, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` written once to the shared folder, and whether it has at most
    ``max_rows`` rows that take at most ``max_bytes`` as JSON text. Both are
    measured exactly, by one aggregate over the written table: every task sends
    one row, whatever its size."""
    df = materialize(df, "broadcast-candidate")
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return df, stats["n"] <= max_rows and (stats["b"] or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int, *, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when :func:`size_checked` finds it small; else ``df`` with a
    shuffle-merge hint (a shuffle join, with AQE's skew splitting), so that no
    size estimate of the written table turns it into a broadcast."""
    df, small = size_checked(df, max_rows, max_bytes=max_bytes)
    return F.broadcast(df) if small else df.hint("shuffle_merge")
