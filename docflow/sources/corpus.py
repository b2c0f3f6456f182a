"""Order documents derived from the ``orders`` and ``lineitem`` tables.

One XML document per order (``F.to_xml`` on the order's fields and its lines)::

    <order key=".." ts="epoch ms" urgent="TRUE|yes|false" chunk="0" n_chunks="1">
      <status>O</status>
      <info><date>epoch days</date><total>123.45</total></info>
      <cust key="..">5-LOW</cust>
      <lines><line n=".." qty=".." part=".."><price>..</price><disc>..</disc></line>...</lines>
    </order>

An order without lines has no ``lines`` element. Lines inside a document are
sorted by the whole line (``sort_array`` of the struct), so "first line" is
well defined even where ``(l_orderkey, l_linenumber)`` repeats.

Scale: documents are built by grouping lines per order. An order with more than
``max_lines_per_doc`` lines (a hot key) is split over several documents
(``chunk`` 0, 1, ...), so no group and no document grows with the data; the set
of hot orders is stored once and broadcast only when its size is checked to be
small. The line data is shuffled once, on ``(order, chunk)``; orders meet the
line groups there through one left outer merge join, which also gives every
order exactly one chunk-0 document.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import spec as S
from ..session import bounded_broadcast

MAX_LINES_PER_DOC = 4096
MAX_BROADCAST_HOT_ORDERS = 1_000_000


def epoch_days(ts_ntz: Column) -> Column:
    """Days since 1970-01-01 of a timestamp_ntz / date (no time zone involved)."""
    return F.unix_date(ts_ntz.cast("date"))


def epoch_millis_ntz(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a timestamp_ntz, read as UTC wall time (no session time zone)."""
    day_ms = epoch_days(ts_ntz).cast("bigint") * F.lit(86_400_000)
    sec_ms = F.floor(F.date_part(F.lit("SECOND"), ts_ntz) * 1000).cast("bigint")
    return day_ms + F.hour(ts_ntz) * 3_600_000 + F.minute(ts_ntz) * 60_000 + sec_ms


def urgent_text(priority: Column) -> Column:
    """'TRUE' for urgent orders, 'yes' for high ones (not a true value), else 'false'."""
    return (
        F.when(priority == "1-URGENT", F.lit("TRUE"))
        .when(priority == "2-HIGH", F.lit("yes"))
        .otherwise(F.lit("false"))
    )


def _line_struct() -> Column:
    return F.struct(
        F.col("l_linenumber").alias("_n"),
        F.col("l_quantity").alias("_qty"),
        F.col("l_partkey").alias("_part"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"),
    )


def row_identity(df: DataFrame) -> Column:
    """A per-row value that separates exact copies: the file and row position of a
    file scan (deterministic, so a retried task after an executor loss assigns
    every row to the same chunk again); other sources fall back to
    ``monotonically_increasing_id`` (Spark then re-runs the stages that depend on
    it as a whole when a shuffle output is lost)."""
    try:
        held = df.select("_metadata").schema["_metadata"].dataType.fieldNames()
    except AnalysisException:  # no such column: not a file scan
        held = []
    if {"file_path", "row_index"} <= set(held):
        return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return F.monotonically_increasing_id()


def order_line_groups(
    lineitem: DataFrame, max_lines_per_doc: int = MAX_LINES_PER_DOC
) -> tuple[DataFrame, DataFrame]:
    """(line groups keyed by (l_orderkey, chunk) with the sorted ``line`` array,
    hot orders with their chunk count)."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_extendedprice", "l_discount")
    counts = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    hot = counts.where(F.col("n_lines") > max_lines_per_doc).select(
        F.col("l_orderkey").alias("hot_key"),
        F.ceil(F.col("n_lines") / F.lit(max_lines_per_doc)).cast("int").alias("n_chunks"),
    )
    # written once (a few rows: only orders over the line limit), then counted
    # and joined twice from the stored copy instead of aggregating lineitem
    # again for each use
    hot = bounded_broadcast(hot, MAX_BROADCAST_HOT_ORDERS)
    tagged = li.withColumn("row_tag", row_identity(lineitem))
    chunk = (
        F.when(F.col("n_chunks").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64("row_tag"), F.col("n_chunks")))
        .cast("int")
    )
    # collect_list has nothing to combine map-side, so shuffle on the group key
    # first: the one exchange the grouping needs anyway, and the list building
    # then runs on every reduce task (hot orders spread over their chunks)
    lines = (
        tagged.join(hot, tagged.l_orderkey == hot.hot_key, "left")
        .withColumn("chunk", chunk)
        .repartition("l_orderkey", "chunk")
        .groupBy("l_orderkey", "chunk")
        .agg(F.sort_array(F.collect_list(_line_struct())).alias("line"))
    )
    return lines, hot


def order_document_rows(
    orders: DataFrame, lineitem: DataFrame, *, max_lines_per_doc: int = MAX_LINES_PER_DOC
) -> DataFrame:
    """``(o_orderkey, chunk, n_chunks, <document fields>)``: the fields of each order
    document as columns (attributes prefixed with ``_``), ready for ``to_xml`` or the
    XML writer. Every order has a chunk 0 (without ``lines`` when it has no line
    there); ``n_chunks`` is 1 for every order that is not split."""
    lines, hot = order_line_groups(lineitem, max_lines_per_doc)
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    # One orders row per (order, chunk): a hot order is repeated once per chunk
    # (few rows). The join then runs on (order, chunk), the key the grouped lines
    # are already partitioned by, so the line data is not shuffled a second time
    # and no task receives a hot order whole. The join is outer on the orders
    # side: orders without lines keep their chunk 0 (no anti join, no union), and
    # a chunk of a hot order that received no line is dropped unless it is chunk 0.
    # The line groups grow with the data: they are never broadcast (the hint
    # keeps AQE from doing so where they look small), and the merge join keeps
    # their (order, chunk) partitioning, so the documents come out spread over
    # as many tasks as the grouping had.
    chunk_ids = (
        F.when(F.col("n_chunks").isNull(), F.array(F.lit(0)))
        .otherwise(F.sequence(F.lit(0), F.col("n_chunks") - 1))
    )
    o_chunks = o.join(hot, F.col("o_orderkey") == F.col("hot_key"), "left").select(
        *o.columns, F.coalesce(F.col("n_chunks"), F.lit(1)).alias("n_chunks"), F.explode(chunk_ids).alias("chunk")
    )
    docs = (
        o_chunks.join(
            lines.hint("shuffle_merge"),
            (F.col("o_orderkey") == F.col("l_orderkey")) & (o_chunks.chunk == lines.chunk),
            "left",
        )
        .where(F.col("line").isNotNull() | (o_chunks.chunk == 0))
        .select(*o.columns, "n_chunks", o_chunks.chunk, "line")
    )
    return docs.select(
        "o_orderkey",
        "chunk",
        "n_chunks",
        F.col("o_orderkey").alias("_key"),
        epoch_millis_ntz(F.col("o_orderdate")).alias("_ts"),
        urgent_text(F.col("o_orderpriority")).alias("_urgent"),
        F.col("chunk").alias("_chunk"),
        F.col("n_chunks").alias("_n_chunks"),
        F.col("o_orderstatus").alias("status"),
        F.struct(
            epoch_days(F.col("o_orderdate")).alias("date"),
            F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("total"),
        ).alias("info"),
        F.struct(F.col("o_custkey").alias("_key"), F.col("o_orderpriority").alias("_VALUE")).alias("cust"),
        F.when(F.col("line").isNotNull(), F.struct(F.col("line").alias("line"))).alias("lines"),
    )


#: Documents per XML file: a rowTag file is read by one task.
RECORDS_PER_FILE = 20_000

DOC_FIELDS = ["_key", "_ts", "_urgent", "_chunk", "_n_chunks", "status", "info", "cust", "lines"]


def order_documents(
    orders: DataFrame,
    lineitem: DataFrame,
    *,
    max_lines_per_doc: int = MAX_LINES_PER_DOC,
    as_binary: bool = False,
) -> DataFrame:
    """``(o_orderkey, chunk, n_chunks, xml)``: one document per order (per chunk of a
    hot order; ``n_chunks`` > 1 marks those)."""
    rows = order_document_rows(orders, lineitem, max_lines_per_doc=max_lines_per_doc)
    xml = F.to_xml(F.struct(*DOC_FIELDS), {"rowTag": "order", "indent": ""})
    if as_binary:
        xml = xml.cast("binary")
    return rows.select("o_orderkey", "chunk", "n_chunks", xml.alias("xml"))


def write_document_files(rows: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Document rows as XML files (``<orders><order>..</order>...</orders>``) through
    Spark's XML writer and commit protocol. A document carries its ``chunk`` and
    ``n_chunks`` as attributes; files are kept small because one task reads one."""
    rows.select(*DOC_FIELDS).write.mode("overwrite").format("xml").option("rowTag", "order").option(
        "rootTag", "orders"
    ).option("maxRecordsPerFile", records_per_file).save(path)


def write_order_files(orders: DataFrame, lineitem: DataFrame, path: str, **kw) -> None:
    """Order documents derived from the tables, written as XML files."""
    write_document_files(order_document_rows(orders, lineitem, **kw), path)


# Mapping for the order documents (one field per shape the extraction supports).
_LINE = S.record(
    S.fld("n", "int", "@n", nullable=False),
    S.fld("qty", "double", "@qty", nullable=False),
    S.fld("part", "long", "@part", nullable=False),
    S.fld("price", "double", "price", nullable=False),
    S.fld("disc", "double", "disc"),
    name="line",
)

ORDER_SPEC = S.spec(
    S.fld("key", "long", "@key", nullable=False),
    S.fld("ts", S.scalar("timestamp", unit="millis"), "@ts"),
    S.fld("urgent", "boolean", "@urgent"),
    S.fld("chunk", "int", "@chunk"),
    S.fld("n_chunks", "int", "@n_chunks"),
    S.fld("status", "string", "status"),
    S.fld("status_bytes", "bytes", "status"),
    S.fld("order_date", "date", "info/date"),
    S.fld("total", S.scalar("decimal", precision=38, scale=9), "info/total"),
    S.fld("info", S.record(S.fld("date", "date", "date"), S.fld("total", S.scalar("decimal"), "total")), "info"),
    S.fld("cust", S.record(S.fld("key", "long", "@key"), S.fld("priority", "string", ".")), "cust"),
    S.fld("priority_len", "int", "cust", function="string_length"),
    S.fld("status_len", "int", "status", function="string_length"),
    S.fld("lines", S.array(_LINE), "lines/line"),
    S.fld("lines_rec", S.record(S.fld("line", S.array(_LINE), "line")), "lines"),
    S.fld("parts", S.array("long"), "lines/line/@part"),
    S.fld("prices", S.array("double"), "lines/line/price"),
    S.fld("first_n", "int", "lines/line/@n"),
    S.fld("first_qty", "double", "lines/line/@qty"),
    S.fld("first_part", "long", "lines/line/@part"),
    S.fld("first_price", "double", "lines/line/price"),
    S.fld("sum_n", "int", "lines/line/@n", function="sum_values"),
    S.fld("sum_qty", "int", "lines/line/@qty", function="sum_values"),
    root="order",
    name="order",
)
