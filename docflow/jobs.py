"""End-to-end jobs (PIP-1..3), as Python functions with keyword arguments.

Each job is one Spark plan from scan to sink: no ``collect`` of data to the
driver, no per-row Python except where the caller passes a partition function.
"""

from __future__ import annotations

from typing import Any, Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.binary import decode_utf8
from .functions.rejects import reject_cause
from .operators import partition as P
from .operators import shape
from .operators.lookup import DEFAULT, lookup_with_default
from .operators.records import align_to_schema
from .operators.xml import extract_xml
from .plans.spec import MappingSpec
from .sources import io


def enrich(
    spark: SparkSession,
    data: DataFrame,
    lookup_sql: str,
    views: dict[str, DataFrame],
    *,
    key: str = "name",
    body: str = "body",
    out_col: str = "uname",
    default: str = DEFAULT,
    setup: Callable[[], Any] | None = None,
    cleanup: Callable[[Any], None] | None = None,
) -> DataFrame:
    """PIP-1 without the sink: data ⟕ (SQL-defined lookup) with default, binary
    body decoded to text, then a partition pass with setup/cleanup."""
    ref = io.query_scan(spark, lookup_sql, views)
    ref_key, ref_value = ref.columns[0], ref.columns[1]
    enriched = lookup_with_default(data, ref, key, ref_key, ref_value, out_col, default=default)
    decoded = enriched.withColumn(body, decode_utf8(F.col(body)))
    if setup is None and cleanup is None:
        return decoded
    return P.map_partitions(decoded, P.passthrough, setup=setup, cleanup=cleanup)


def enrich_and_append(spark: SparkSession, data: DataFrame, lookup_sql: str, views: dict[str, DataFrame],
                      target: str, fmt: str = "parquet", **kw) -> None:
    """PIP-1: enrich, then append to ``target``."""
    io.append(enrich(spark, data, lookup_sql, views, **kw), target, fmt)


def extract_xml_and_append(docs: DataFrame, xml_col: str, spec: MappingSpec, target: str,
                           fmt: str = "parquet", **kw) -> None:
    """PIP-2: documents → typed rows of the spec's table schema → append.
    Date, timestamp and decimal columns keep their types in the sink."""
    rows = extract_xml(docs, xml_col, spec, **kw)
    io.append(align_to_schema(rows, spec.to_struct()), target, fmt)


def extract_xml_and_route(docs: DataFrame, xml_col: str, spec: MappingSpec, target: str, *, keep: tuple[str, ...] = (), **kw) -> dict[str, int]:
    """PIP-2 where documents may be malformed (XML-12): typed rows and rejects are written in
    one pass over the documents, as the folders ``outcome=row`` and ``outcome=reject`` of
    ``target``; a reject has its text and ``cause`` (line, position, reason). Returns the
    counts that were observed while writing: ``documents``, ``rows``, ``rejects``."""
    rows = extract_xml(docs, xml_col, spec, keep=keep, malformed="permissive", corrupt_col="document", **kw)
    bad = F.col("document").isNotNull()
    out = rows.withColumn("cause", reject_cause(F.col("document"))).withColumn("outcome", F.when(bad, "reject").otherwise("row"))
    seen = Observation()
    counts = {"documents": F.count(F.lit(1)), "rows": F.count_if(~bad), "rejects": F.count_if(bad)}
    out = out.observe(seen, *[c.alias(n) for n, c in counts.items()])
    out.write.mode("append").partitionBy("outcome").parquet(target)
    return {n: int(seen.get.get(n, 0)) for n in counts}


def transform_and_filter(df: DataFrame, column: str, drop_in_map: Any, drop_after: Any) -> DataFrame:
    """PIP-3: a partition map that drops rows (``column == drop_in_map``), a
    null-safe filter (``column == drop_after`` removed) and a row count. The map
    drops whole rows and changes none, so the filter goes below it: rows that it
    removes never leave the JVM."""
    kept = shape.drop_rows(df, shape.equals_value(F.col(f"`{column}`"), drop_after))
    return shape.count_rows(P.drop_rows_in_partitions(kept, column, drop_in_map))
