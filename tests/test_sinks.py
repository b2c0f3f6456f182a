"""SNK-1, SNK-2: appends that are run again, killed anywhere, or have another schema."""

import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.sources import sinks
from docflow.sources.sinks import SinkSchemaError, append_once, checked_schema, read_sink


def numbers(spark, a, b, parts=4):
    return spark.range(a, b, numPartitions=parts).select(F.col("id"), (F.col("id") % 3).cast("int").alias("k"))


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def test_a_token_appends_once(spark, scratch):
    assert append_once(numbers(spark, 0, 50), scratch, "monday")
    assert not append_once(numbers(spark, 0, 50), scratch, "monday")
    assert append_once(numbers(spark, 50, 80), scratch, "tuesday / 2")
    assert ids(spark, scratch) == list(range(80))
    assert read_sink(spark, scratch).count() == 80


class Killed(BaseException):
    pass


@pytest.mark.parametrize("after", [0, 1, 3])
@pytest.mark.parametrize("step", ["_write", "_move", "_data_files", "_hadoop_path"])
def test_killed_anywhere_and_run_again(spark, scratch, monkeypatch, step, after):
    append_once(numbers(spark, 0, 10), scratch, "first")
    real, calls = getattr(sinks, step), []

    def killed(*args):
        calls.append(args)
        if len(calls) == after + 1:
            raise Killed
        return real(*args)

    monkeypatch.setattr(sinks, step, killed)
    runs = 0
    while True:
        try:
            append_once(numbers(spark, 10, 40), scratch, "second")
            break
        except Killed:
            runs += 1
    assert runs <= 1
    monkeypatch.setattr(sinks, step, real)
    assert ids(spark, scratch) == list(range(40))
    append_once(numbers(spark, 10, 40), scratch, "second")
    assert ids(spark, scratch) == list(range(40))


def test_the_process_dies_while_files_move(spark, scratch):
    """A process of its own, ended without any cleanup after its second file."""
    code = f"""
        import os, sys
        sys.path.insert(0, {sys.path[0]!r}); sys.path.insert(0, {str(__import__("docflow").__path__[0]) + "/.."!r})
        from docflow.session import get_session
        from docflow.sources import sinks
        spark = get_session("local[2]")
        real, seen = sinks._move, []
        def move(*a):
            real(*a)
            seen.append(a)
            if len(seen) == 2:
                os._exit(9)
        sinks._move = move
        sinks.append_once(spark.range(0, 40, numPartitions=4).selectExpr("id", "cast(id % 3 as int) k"), {scratch!r}, "job")
    """
    ended = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, timeout=200)
    assert ended.returncode == 9, ended.stderr[-2000:]
    assert len(ids(spark, scratch)) == 20  # two of four files show
    assert append_once(numbers(spark, 0, 40), scratch, "job")
    assert ids(spark, scratch) == list(range(40))


def test_partitioned_targets(spark, scratch):
    for token in ("a", "b", "a"):
        append_once(numbers(spark, 0, 30), scratch, token, partition_by=["k"])
    back = spark.read.parquet(scratch)
    assert back.count() == 60 and sorted(back.columns) == ["id", "k"] and back.where("k = 1").count() == 20


def test_an_empty_job_and_an_empty_sink(spark, scratch):
    assert append_once(numbers(spark, 0, 0), scratch, "none")
    assert read_sink(spark, scratch).count() == 0
    append_once(numbers(spark, 0, 5), scratch, "some")
    assert ids(spark, scratch) == [0, 1, 2, 3, 4]


# ---------------------------------------------------------------- schemas


def test_columns_are_added_left_out_and_widened(spark, scratch):
    row = "id long, n int, x float, d decimal(10,2), s struct<a:int>, l array<int>"
    append_once(spark.createDataFrame([(1, 2, 0.5, __import__("decimal").Decimal("1.25"), (3,), [1])], row), scratch, "1")
    more = "id long, n long, x double, d decimal(20,2), s struct<a:long,b:string>, l array<long>, t timestamp_ntz"
    stamp = __import__("datetime").datetime(2024, 1, 2, 3)
    append_once(spark.createDataFrame([(2, 1 << 40, 0.25, __import__("decimal").Decimal("123456789012.5"), (1 << 40, "b"), [1 << 40], stamp)], more), scratch, "2")
    append_once(spark.createDataFrame([(3, 7)], "id long, n short"), scratch, "3")  # narrower, and most left out
    back = read_sink(spark, scratch)
    assert back.schema.simpleString() == "struct<id:bigint,n:bigint,x:double,d:decimal(20,2),s:struct<a:bigint,b:string>,l:array<bigint>,t:timestamp_ntz>"
    rows = {r["id"]: r for r in back.collect()}
    assert [rows[i]["n"] for i in (1, 2, 3)] == [2, 1 << 40, 7] and [rows[i]["x"] for i in (1, 2, 3)] == [0.5, 0.25, None]
    assert tuple(rows[1]["s"]) == (3, None) and tuple(rows[2]["s"]) == (1 << 40, "b") and rows[3]["s"] is None
    assert str(rows[1]["d"]) == "1.25" and rows[1]["t"] is None and rows[2]["t"] == stamp and rows[2]["l"] == [1 << 40] and rows[1]["l"] == [1]


@pytest.mark.parametrize(
    "sink,rows,word",
    [
        ("d decimal(10,2)", "d decimal(12,3)", "scale"),
        ("t timestamp", "t timestamp_ntz", "zone"),
        ("n int", "n string", "string against int"),
        ("n double", "n long", "bigint against double"),
        ("s struct<a:array<int>>", "s struct<a:array<string>>", r"s.a\[\]"),
        ("name string", "Name string", "case"),
        ("m map<string,int>", "m map<string,date>", "date against int"),
    ],
)
def test_conflicts_raise_before_anything_is_written(spark, scratch, sink, rows, word):
    append_once(spark.createDataFrame([], sink), scratch, "1")
    with pytest.raises(SinkSchemaError, match=word):
        append_once(spark.createDataFrame([], rows), scratch, "2")
    assert read_sink(spark, scratch).schema.simpleString() == T._parse_datatype_string(sink).simpleString()


def test_sinks_that_were_written_otherwise_are_checked_by_their_footers(spark, scratch):
    spark.createDataFrame([(1, "a")], "id int, s string").write.parquet(scratch)
    with pytest.raises(SinkSchemaError, match="id"):
        append_once(spark.createDataFrame([("x",)], "id string"), scratch, "1")
    append_once(spark.createDataFrame([(5, 0.5)], "id long, y double"), scratch, "2")
    assert sorted(map(tuple, read_sink(spark, scratch).collect()), key=str) == [(1, "a", None), (5, None, 0.5)]


def test_checked_schema_is_the_same_in_any_order_for_widening():
    a, b = T._parse_datatype_string("n int, x float"), T._parse_datatype_string("n long, x double")
    assert checked_schema(a, b) == checked_schema(b, a) == checked_schema(None, b)
