"""PAR-1..3, SRC-1..3, SNK-1..3, PIP-1..3, streaming, skewed documents."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow import jobs
from docflow.operators import partition as P
from docflow.operators.xml import explode_records, extract_xml, read_xml, read_xml_files
from docflow.plans import spec as S
from docflow.sources import io
from docflow.sources.corpus import ORDER_SPEC, order_documents, write_order_files
from conftest import SF_SMALL
from fixtures import OVEN, PARTS, RECIPE_JSON


def test_partition_map_drops_rows(spark):
    df = spark.range(0, 90, numPartitions=3).selectExpr("id", "CASE WHEN id % 9 = 0 THEN NULL WHEN id % 3 = 0 THEN 'out' ELSE 'in' END AS mark")
    out = P.drop_rows_in_partitions(df, "mark", "out")
    assert out.groupBy("mark").count().where("mark IS NULL OR mark = 'in'").agg(F.sum("count")).first()[0] == out.count() == 70
    assert P.drop_rows_in_partitions(df.where("id < 0"), "mark", "out").count() == 0


def _log(folder):
    """Hooks that write what they do to one file per partition."""
    import uuid

    def setup():
        path = os.path.join(folder, uuid.uuid4().hex)
        with open(path, "a") as f:
            f.write("setup\n")
        return path

    def count(batch, path):
        with open(path, "a") as f:
            f.write(f"batch {batch.num_rows}\n")
        if batch.num_rows and batch.column(0)[0].as_py() < 0:
            raise ValueError("bad batch")
        return pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "path": [path]})

    def cleanup(path):
        with open(path, "a") as f:
            f.write("cleanup\n")

    return setup, count, cleanup


def test_hooks_run_once_per_partition_in_order(spark, tmp_path):
    setup, count, cleanup = _log(str(tmp_path))
    df = spark.range(0, 1000, numPartitions=4)
    out = P.map_partitions(df, count, "rows long, path string", setup=setup, cleanup=cleanup).collect()
    assert sum(r.rows for r in out) == 1000
    logs = {p: open(os.path.join(tmp_path, p)).read().split("\n")[:-1] for p in os.listdir(tmp_path)}
    assert len(logs) == 4 and {os.path.basename(r.path) for r in out} == set(logs)
    for lines in logs.values():
        assert lines[0] == "setup" and lines[-1] == "cleanup" and lines.count("setup") == lines.count("cleanup") == 1
        assert sum(int(x.split()[1]) for x in lines[1:-1]) == 250


def test_cleanup_runs_when_a_batch_fails(spark, tmp_path):
    setup, count, cleanup = _log(str(tmp_path))
    with pytest.raises(Exception, match="bad batch"):
        P.map_partitions(spark.range(-5, 0, numPartitions=1), count, "rows long, path string", setup=setup, cleanup=cleanup).collect()
    (log,) = os.listdir(tmp_path)
    assert open(os.path.join(tmp_path, log)).read().split("\n")[:-1] == ["setup", "batch 5", "cleanup"]


def test_transform_and_filter(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "name string")
    assert jobs.transform_and_filter(df, "name", "A", "C").collect()[0].n == 2


def test_append_keeps_logical_types(spark, scratch):
    df = spark.sql(
        "SELECT 1 AS id, DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 03:04:05' AS ts, CAST(1.5 AS DECIMAL(38,9)) AS m"
    )
    io.append(df, scratch)
    io.append(df, scratch)
    back = spark.read.parquet(scratch)
    assert back.schema.simpleString() == df.schema.simpleString() and back.count() == 2


def test_avro_scan_if_available(spark, scratch):
    df = spark.createDataFrame([("a", bytearray(b"x"))], "name string, body binary")
    try:
        io.append(df, scratch, fmt="avro")
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"spark-avro package not on the classpath: {str(e)[:80]}")
    assert io.read_table(spark, scratch, "avro").count() == 1


def test_query_scan(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    out = io.query_scan(spark, "SELECT DISTINCT name, UPPER(name) AS uname FROM t_names", {"t_names": df})
    assert sorted(tuple(r) for r in out.collect()) == [("a", "A"), ("b", "B")]
    assert not spark.catalog.tableExists("t_names")  # no view is left behind
    spark.range(3).createOrReplaceTempView("t_names")
    assert io.query_scan(spark, "SELECT COUNT(*) AS n FROM t_names", {"t_names": df}).first().n == 3
    assert spark.table("t_names").columns == ["id"]  # the caller's view is back
    spark.catalog.dropTempView("t_names")


def test_one_document_per_file(spark, tmp_path):
    for i, doc in enumerate((PARTS, OVEN)):
        (tmp_path / f"doc{i}.xml").write_text(doc)
    out = read_xml_files(spark, str(tmp_path), S.from_json(RECIPE_JSON), columns=["title", "grams"])
    assert sorted((r.title, r.grams) for r in out.collect()) == [("Plum cake", None), ("Soup", [250, 80])]
    assert out.columns == ["path", "title", "grams"]


def test_row_tag_files_match_in_memory_documents(spark, scratch):
    o, l = io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem")
    write_order_files(o, l, scratch)
    cols = ["key", "status", "total", "lines"]
    files = read_xml(spark, scratch, ORDER_SPEC, "order", columns=cols)
    mem = extract_xml(order_documents(o, l), "xml", ORDER_SPEC, columns=cols)
    assert files.exceptAll(mem).count() == 0 and mem.exceptAll(files).count() == 0


def test_extract_and_append(spark, scratch):
    o, l = io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem")
    jobs.extract_xml_and_append(order_documents(o, l), "xml", ORDER_SPEC, scratch)
    back = spark.read.parquet(scratch)
    assert back.count() == o.count()
    assert back.schema["total"].dataType.simpleString() == "decimal(38,9)"
    assert back.schema["order_date"].dataType.simpleString() == "date"


def test_enrich_and_append(spark, scratch):
    data = spark.createDataFrame([("a", bytearray(b"hi")), ("q", bytearray(b"\xff"))], "name string, body binary")
    jobs.enrich_and_append(spark, data, "SELECT DISTINCT name, UPPER(name) AS uname FROM t_ref", {"t_ref": data.where("name = 'a'")},
                           scratch, setup=dict, cleanup=lambda s: None)
    got = {r.name: (r.body, r.uname) for r in spark.read.parquet(scratch).collect()}
    assert got == {"a": ("hi", "A"), "q": ("�", "UNKNOWN")}


def test_hot_orders_are_split_and_results_stay_whole(spark):
    """An order with more lines than the document bound is split over several
    documents; extracted lines and totals are unchanged."""
    o, l = io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem")
    # skew: every line of the table moved onto one order key
    hot = l.withColumn("l_orderkey", F.lit(0).cast("bigint"))
    docs = order_documents(o, hot, max_lines_per_doc=500)
    sizes = extract_xml(docs, "xml", ORDER_SPEC, columns=["key", "lines"]).select("key", F.size("lines").alias("n"))
    mx = sizes.agg(F.max("n")).collect()[0][0]
    n_docs_hot = sizes.where("key = 0").count()
    assert mx <= 700 and n_docs_hot >= l.count() // 500
    lines = explode_records(extract_xml(docs, "xml", ORDER_SPEC, columns=["key", "lines"]), "lines")
    assert lines.count() == l.count()
    want = hot.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_extendedprice")
    got = lines.select("key", "n", "qty", "part", "price")
    assert got.exceptAll(want).count() == 0
    # every order, hot or without lines, has exactly one chunk-0 document
    heads = docs.where("chunk = 0").groupBy("o_orderkey").count()
    assert heads.count() == o.count() and heads.where("count <> 1").count() == 0


def test_streaming_extract_matches_batch(spark, scratch):
    from docflow.streaming import read_stream, run_available_now

    o, l = io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem")
    src = scratch + "/src"
    order_documents(o, l).write.parquet(src)
    docs_schema = spark.read.parquet(src).schema
    stream = extract_xml(read_stream(spark, src, docs_schema), "xml", ORDER_SPEC, columns=["key", "status"])
    run_available_now(stream, scratch + "/out")
    out = spark.read.parquet(scratch + "/out")
    batch = extract_xml(spark.read.parquet(src), "xml", ORDER_SPEC, columns=["key", "status"])
    assert out.count() == o.count() and out.exceptAll(batch).count() == 0


def test_three_routes_give_the_same_rows(spark, scratch):
    """Differential: the whole order mapping over a string column, a binary
    column and XML files gives identical rows."""
    from pyspark.sql import functions as F

    o, l = io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem")
    cols = [f for f in ORDER_SPEC.names if f != "status_bytes"]  # binary values are not comparable in exceptAll
    text = extract_xml(order_documents(o, l), "xml", ORDER_SPEC, columns=cols)
    binary = extract_xml(order_documents(o, l, as_binary=True), "xml", ORDER_SPEC, columns=cols)
    write_order_files(o, l, scratch)
    files = read_xml(spark, scratch, ORDER_SPEC, "order", columns=cols)
    assert text.count() == o.count()
    for other in (binary, files):
        assert text.exceptAll(other).count() == 0 and other.exceptAll(text).count() == 0
    hexed = extract_xml(order_documents(o, l), "xml", ORDER_SPEC, columns=["key", "status", "status_bytes"])
    assert hexed.where(F.hex("status_bytes") != F.hex(F.encode("status", "UTF-8"))).count() == 0


def test_append_to_catalog_table_and_query_it(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    spark.sql("DROP TABLE IF EXISTS docflow_append_t")
    io.append(df, "docflow_append_t", table=True)
    io.append(df, "docflow_append_t", table=True)
    out = io.query_scan(spark, "SELECT name, SUM(n) AS n FROM docflow_append_t GROUP BY name")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2), ("b", 4)]


def test_checkpoint_base_fallback_without_config(spark):
    """Without spark.checkpoint.dir the shared folder falls back to one registered
    with setCheckpointDir (the config cannot be set at runtime)."""
    from docflow import session as Sx

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "local[4]"

        def __init__(self):
            self.dir = None

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d + "/app-uuid"

    class Fake:
        sparkContext = Ctx()
        conf = spark.conf

    base = Sx.checkpoint_base(Fake())
    assert base.endswith("_docflow_checkpoints/app-uuid")
    assert Sx.checkpoint_base(Fake()) == base  # found again, not re-registered
    own = Sx.checkpoint_base(spark).rstrip("/") + "/docflow-" + spark.sparkContext.applicationId
    assert Sx.shared_dir(spark, "x").startswith(own + "/x/")
    # a cluster without a shared folder is an error, not a folder on the driver's disk
    Fake.sparkContext = Ctx()
    Fake.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        Sx.checkpoint_base(Fake())


def test_intermediates_can_be_dropped(spark):
    from docflow import session as Sx

    was, Sx._application_dir = Sx._application_dir, lambda s: Sx.checkpoint_base(s).rstrip("/") + "/docflow-drop-test"
    try:
        df = Sx.materialize(spark.range(3), "gone")
        assert df.count() == 3
        Sx.drop_intermediates(spark)
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(df.inputFiles()[0].rsplit("/", 1)[0])
    finally:
        Sx._application_dir = was


def test_derived_tables_follow_their_sources(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    from docflow.session import derived_table

    src = scratch + "/src"
    spark.range(5).write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src)

    with ThreadPoolExecutor(4) as pool:
        paths = set(pool.map(lambda _: derived_table(spark, "follow", build, (src,)), range(4)))
    assert len(paths) == len(calls) == 1
    spark.range(5, 12).write.mode("append").parquet(src)
    assert spark.read.parquet(derived_table(spark, "follow", build, (src,))).count() == 12 and len(calls) == 2


def test_stream_goes_on_where_it_stopped(spark, scratch):
    """Runs into one sink without a given checkpoint: all rows once."""
    from docflow.streaming import read_stream, run_available_now

    src, out = scratch + "/src", scratch + "/out"
    for rows, total in (((0, 100), 100), ((100, 150), 150), (None, 150)):
        if rows:
            spark.range(*rows).write.mode("append").parquet(src)
        run_available_now(read_stream(spark, src, "id long"), out)
        got = spark.read.parquet(out)
        assert got.count() == got.distinct().count() == total


@pytest.mark.parametrize("limit", [1, 3])
def test_answers_do_not_depend_on_the_document_size(spark, limit, monkeypatch):
    import oracle_check

    from docflow import workload

    monkeypatch.setattr(workload, "MAX_LINES", limit)
    names = ["xml_status_totals", "xml_extract_lines", "xml_scalar_first_match", "xml_nested_record", "xml_primitive_array",
             "xml_null_vs_empty", "xml_typed_scalars", "xml_string_length", "xml_sum_values", "xml_malformed_permissive",
             "xml_pruned_columns", "xml_xpath_fields", "xml_from_bytes", "xml_file_scan", "pipeline_xml", "stream_xml_status_totals"]
    res = oracle_check.compare(spark, SF_SMALL, names)
    assert {n: r[0] for n, r in res.items() if r[0] != "OK"} == {}


def test_derived_table_is_built_once_per_key(spark):
    from docflow.session import derived_table

    calls = []

    def build():
        calls.append(1)
        return spark.range(0, 100).withColumnRenamed("id", "v")

    key = f"test-derived-{os.getpid()}"
    p1 = derived_table(spark, key, build)
    p2 = derived_table(spark, key, build)
    assert p1 == p2 and len(calls) == 1
    assert spark.read.parquet(p1).count() == 100

    def failing():
        raise RuntimeError("build failed")

    with pytest.raises(RuntimeError):
        derived_table(spark, key + "-bad", failing)
    # a failed build is not registered: the next call builds again
    assert spark.read.parquet(derived_table(spark, key + "-bad", build)).count() == 100
    assert len(calls) == 2


def test_order_documents_table_matches_a_fresh_build(spark):
    from docflow.workload import _docs

    fresh = order_documents(io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem"))
    stored = _docs(spark, SF_SMALL).drop("is_split")
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in fresh.schema]
    assert stored.exceptAll(fresh).count() == 0 and fresh.exceptAll(stored).count() == 0
    # the XML queries scan the stored table: no shuffle left below the parse
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_per_order_combine_shuffles_only_split_orders(spark):
    """Per-order values with one order holding every line (split over many
    documents): only that order's rows go through the aggregate, and the result
    equals a direct aggregate over the lines."""
    from docflow.workload import _per_order

    o, l = io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem")
    hot = l.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    docs = order_documents(o, hot, max_lines_per_doc=300)
    assert docs.where("n_chunks > 1").select("o_orderkey").distinct().collect() == [(0,)]
    docs = docs.withColumn("is_split", (F.col("n_chunks") > 1).cast("int"))
    ex = extract_xml(docs, "xml", ORDER_SPEC, columns=["key", "sum_n"], keep=["is_split"])
    got = _per_order(
        ex, [F.col("key").alias("k")], [F.col("sum_n").cast("bigint").alias("s")], [F.sum("sum_n").alias("s")]
    )
    want = o.join(hot, o.o_orderkey == hot.l_orderkey, "left").groupBy(F.col("o_orderkey").alias("k")).agg(
        F.coalesce(F.sum("l_linenumber"), F.lit(0)).cast("bigint").alias("s")
    )
    assert got.count() == o.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_document_build_plan_keeps_line_groups_out_of_broadcast(spark):
    """The line groups grow with the data: the join back to orders must be a
    merge join on (order, chunk) even where AQE sees them as small (a broadcast
    put the whole output into the orders scan's single task)."""
    import re

    docs = order_documents(io.tpch(spark, SF_SMALL, "orders"), io.tpch(spark, SF_SMALL, "lineitem"))
    # whether AQE would broadcast depends on runtime sizes and settings, so the
    # hint itself is checked in the optimized plan, and the merge join in the final one
    opt = docs._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, \(\(o_orderkey#\d+L = l_orderkey#\d+L\).*rightHint=\(strategy=merge\)", opt)
    docs.write.format("noop").mode("overwrite").save()
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[o_orderkey#\d+L, chunk#\d+\], \[l_orderkey#\d+L, chunk#\d+\], LeftOuter", plan)
    assert "collect_list" not in "".join(l for l in plan.splitlines() if "BroadcastExchange" in l)


def test_per_order_query_plan_shuffles_only_split_orders(spark):
    import re

    from docflow.workload import xml_sum_values

    df = xml_sum_values(spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 2  # two disjoint branches, each document parsed once
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    # each branch reads the files of its own partition only
    assert len(re.findall(r"PartitionFilters: \[[^\]]*is_split", plan)) == 2
