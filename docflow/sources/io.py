"""Scans and sinks (SRC-1..3, SNK-1..3).

* ``read_table``: any file format Spark knows (parquet by default; Avro when the
  spark-avro package is on the classpath), schema from the files.
* ``query_scan``: a table defined by SQL text over named DataFrames (or over
  tables already in the catalog) — the warehouse-side query of the reference.
* ``append``: append to a path or a catalog table through Spark's commit
  protocol (task retries and executor loss leave no partial files behind).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """SRC-1."""
    return spark.read.format(fmt).options(**options).load(path)


def tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query_scan(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SRC-2: run ``sql`` with ``views`` bound as temporary views for its analysis;
    afterwards they are gone, and a view of the caller's that had such a name is back.

    The SQL goes through Catalyst like any DataFrame code, so filters and column
    pruning reach the underlying scans."""
    callers = {name: spark.table(name) for name in views or {} if _is_temporary(spark, name)}
    try:
        for name, df in (views or {}).items():
            df.createOrReplaceTempView(name)
        return spark.sql(sql)  # resolved here: the result holds the plans, not the names
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)
        for name, df in callers.items():
            df.createOrReplaceTempView(name)


def _is_temporary(spark: SparkSession, name: str) -> bool:
    try:
        return spark.catalog.getTable(name).isTemporary
    except AnalysisException:  # no such table
        return False


def append(df: DataFrame, target: str, fmt: str = "parquet", *, table: bool = False, compression: str = "snappy",
           partition_by: list[str] | None = None, **options) -> None:
    """SNK-1 / SNK-2 / SNK-3: append ``df``; date, timestamp and decimal columns keep
    their logical types in parquet/orc/avro."""
    w = df.write.mode("append").format(fmt).option("compression", compression).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.saveAsTable(target)
    else:
        w.save(target)
