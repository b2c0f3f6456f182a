"""LKP-1, FN-13, AGG-1/2, PRJ-*, FLT-*, FN-11/12, REC-*."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.binary import be_bytes_to_decimal, decode_utf8, long_to_be_bytes
from docflow.operators import shape
from docflow.operators.lookup import lookup_with_default
from docflow.operators.records import align_to_schema


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lookup_rows(spark):
    data = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "n")], "id int, name string")
    ref = spark.createDataFrame([("a", "A"), ("n", None), (None, "NULLKEY"), ("z", "Z")], "name string, uname string")
    return data, ref


def test_lookup_default_null_key_and_null_value(spark, lookup_rows):
    data, ref = lookup_rows
    out = lookup_with_default(data, ref, "name", "name", "uname", "uname")
    got = {r.id: r.uname for r in out.collect()}
    assert got == {1: "A", 2: "UNKNOWN", 3: "UNKNOWN", 4: None}
    assert out.columns == ["id", "name", "uname"]
    assert "BroadcastHashJoin" in _plan(out)


def test_lookup_without_broadcast_when_reference_is_large(spark, lookup_rows):
    data, ref = lookup_rows
    out = lookup_with_default(data, ref, "name", "name", "uname", "uname", max_broadcast_rows=1)
    assert {r.id: r.uname for r in out.collect()}[1] == "A"
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in final and "SortMergeJoin" in final


def test_lookup_without_broadcast_when_reference_is_wide(spark, lookup_rows):
    data, ref = lookup_rows
    out = lookup_with_default(data, ref, "name", "name", "uname", "uname", max_broadcast_bytes=10)
    assert {r.id: r.uname for r in out.collect()} == {1: "A", 2: "UNKNOWN", 3: "UNKNOWN", 4: None}
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in final and "SortMergeJoin" in final


def test_lookup_duplicate_keys(spark, lookup_rows):
    data, _ = lookup_rows
    dup = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B")], "name string, uname string")
    with pytest.raises(Exception, match="duplicate lookup key: a"):
        lookup_with_default(data, dup, "name", "name", "uname", "uname").collect()
    out = lookup_with_default(data, dup, "name", "name", "uname", "uname", on_duplicate="any")
    assert out.count() == 4  # never multiplies rows
    assert {r.id: r.uname for r in out.collect()}[1] == "A"


def test_lookup_empty_input(spark, lookup_rows):
    _, ref = lookup_rows
    empty = spark.createDataFrame([], "id int, name string")
    assert lookup_with_default(empty, ref, "name", "name", "uname", "uname").count() == 0


def test_null_keys_go_round_a_shuffle_join(spark):
    data = spark.createDataFrame([(i, None if i % 2 else str(i % 7), "old", 1) for i in range(200)], "id int, `x.y` string, out string, `a b` int")
    ref = spark.createDataFrame([(str(i), f"v{i}") for i in range(5)], "`k.k` string, v string")
    want = {i: f"v{i % 7}" if i % 2 == 0 and i % 7 < 5 else "UNKNOWN" for i in range(200)}
    for rows in (100, 1):
        out = lookup_with_default(data, ref, "x.y", "k.k", "v", "out", max_broadcast_rows=rows)
        assert out.columns == data.columns and {r["id"]: r["out"] for r in out.collect()} == want  # `out` is replaced in place
    plan = _plan(out)
    assert "SinglePartition" not in plan and "isnotnull" in plan


def test_size_check_has_no_single_task(spark):
    from docflow.session import size_checked

    assert size_checked(spark.range(10), 10)[1] and not size_checked(spark.range(11), 10)[1] and not size_checked(spark.range(10), 10, max_bytes=20)[1]


def test_count_rows(spark):
    assert shape.count_rows(spark.range(7)).collect()[0].n == 7


def test_map_reproject_filter(spark):
    df = spark.createDataFrame([("a", 3), ("b", -2), (None, None)], "s string, i int")
    m = shape.map_column(shape.map_column(df, "s", F.upper, "string"), "i", shape.square, "int")
    assert [tuple(r) for r in m.collect()] == [("A", 9), ("B", 4), (None, None)]
    r = shape.reproject(df, [F.col("i"), F.col("s")], ["s", "i"])
    assert r.columns == ["s", "i"] and r.collect()[0].s == 3
    kept = shape.drop_rows(df, shape.equals_value(F.col("s"), "a"))
    assert sorted((r.s or "") for r in kept.collect()) == ["", "b"]  # null-safe: the null row stays


def test_decode_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"A\xffB"),), (None,)], "b binary")
    assert [r[0] for r in df.select(decode_utf8(F.col("b"))).collect()] == ["ok é", "A�B", None]
    d = shape.decode_column(df.withColumn("k", F.lit(1)), "b")
    assert d.schema["b"].dataType == T.StringType() and d.columns == ["b", "k"]


VALUES = [0, 1, -1, 127, 128, -128, -129, 255, 256, 2**31, -(2**31), 2**63 - 1, -(2**63), 10**20, -(10**20),
          2**64, -(2**64), 10**37, 10**38 - 1]


def _be(n: int) -> bytes:
    """Minimal big-endian two's complement (as Java's BigInteger.toByteArray)."""
    return n.to_bytes((n if n >= 0 else ~n).bit_length() // 8 + 1, "big", signed=True)


def test_be_bytes_to_decimal_exact(spark):
    df = spark.createDataFrame([(bytearray(_be(v)), str(v)) for v in VALUES], "b binary, v string")
    for r in df.select(be_bytes_to_decimal(F.col("b"), 9).alias("d"), "v").collect():
        assert r.d == Decimal(f"{r.v}E-9"), r.v


def test_be_bytes_of_any_length(spark):
    values = [0, 1, -1, 65536, -2, 10**38 - 1, 1 - 10**38]
    rows = [(v.to_bytes(n, "big", signed=True), str(v)) for v in values for n in range(1, 21) if n * 8 > (v if v >= 0 else ~v).bit_length()]
    df = spark.createDataFrame([(bytearray(b), v) for b, v in rows], "b binary, v string")
    assert all(r.d == Decimal(f"{r.v}E-9") for r in df.select(be_bytes_to_decimal(F.col("b"), 9).alias("d"), "v").collect())
    odd = spark.createDataFrame([(bytearray(),), (bytearray((10**38).to_bytes(17, "big")),), (bytearray(b"\x01" + bytes(18)),), (None,)], "b binary")
    assert [r[0] for r in odd.select(be_bytes_to_decimal(F.col("b"), 9, mode="permissive")).collect()] == [None] * 4
    for i in range(3):
        with pytest.raises(Exception, match="no decimal of the declared precision"):
            odd.limit(i + 1).where(F.col("b").isNotNull()).select(be_bytes_to_decimal(F.col("b"), 9)).collect()


def test_long_to_be_bytes_is_minimal(spark):
    vals = [v for v in VALUES if -(2**63) <= v < 2**63]
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    got = [bytes(r[0]) for r in df.select(long_to_be_bytes(F.col("n"))).collect()]
    assert got == [_be(v) for v in vals]


def test_align_to_schema(spark):
    src = spark.createDataFrame(
        [(1, (7, 1000, 1000000, bytearray(_be(1500000000)), [(1, 2.5)]))],
        "id int, rec struct<k:int, ms:bigint, us:bigint, dec:binary, arr:array<struct<n:int, q:double>>>",
    )
    target = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("rec", T.StructType([
            T.StructField("k", T.LongType()),
            T.StructField("ms", T.TimestampType(), metadata={"unit": "millis"}),
            T.StructField("us", T.TimestampType(), metadata={"unit": "micros"}),
            T.StructField("dec", T.DecimalType(38, 9)),
            T.StructField("arr", T.ArrayType(T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.StringType())]))),
            T.StructField("missing", T.StringType()),
        ])),
        T.StructField("gone", T.DateType()),
    ])
    a = align_to_schema(src, target)
    assert a.schema.simpleString() == target.simpleString()
    r = a.collect()[0]
    assert r.rec.ms == r.rec.us  # 1000 ms == 1,000,000 µs: the declared unit is used
    assert r.rec.dec == Decimal("1.5") and r.rec.arr[0].n == 1 and r.rec.arr[0].x is None
    assert r.rec.missing is None and r.gone is None


def test_lookup_shuffle_path_splits_a_hot_key(spark):
    """A third of the input rows share one key; beyond the broadcast bound the
    lookup is a sort-merge join and AQE splits the hot partition; every row stays."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        data = spark.range(30000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
        )
        ref = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v")).union(
            spark.createDataFrame([("hot", "H")], "k string, v string"))
        out = lookup_with_default(data, ref, "k", "k", "v", "v", max_broadcast_rows=10)
        counted = out.groupBy("v").count()
        got = counted.collect()
        assert {r.v: r["count"] for r in got} == {"H": 10000, "v": 13333, "UNKNOWN": 6667}
        final = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
