"""LKP-1 with a large reference: rows without a match are not shuffled."""

import pytest
from pyspark.sql import functions as F

from docflow.operators.lookup import lookup_with_default
from docflow.operators.membership import key_filter


@pytest.mark.parametrize("kind,make", [("long", "id"), ("string", "concat('k', id)"), ("date", "date_from_unix_date(int(id))")])
def test_no_held_key_is_missed(spark, kind, make):
    keys = spark.range(0, 20_000, 3).select(F.expr(make).cast(kind).alias("k"))
    held = key_filter(keys, "k", 6_667)
    asked = spark.range(20_000).select("id", F.expr(make).cast(kind).alias("k")).select("id", held.may_hold(F.col("k")).alias("may"))
    yes = {r["id"] for r in asked.where("may").collect()}
    assert set(range(0, 20_000, 3)) <= yes
    assert len(yes) - 6_667 < 0.05 * 13_333 and 0 < held.share < 0.5
    assert not asked.select(held.may_hold(F.lit(None).cast(kind)).alias("m")).where("m").count()


def test_a_filter_that_is_too_full_is_none(spark):
    keys = spark.range(200_000).withColumnRenamed("id", "k")
    assert key_filter(keys, "k", 200_000, max_bits=1 << 15) is None
    assert key_filter(keys.where("k < 0"), "k", 0).share == 0


def test_large_references_give_the_same_rows_and_shuffle_fewer(spark):
    data = spark.range(30_000).select(F.col("id"), F.expr("CASE WHEN id % 10 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id * 5 END").alias("k"))
    ref = spark.range(3_000).select((F.col("id") * 7).alias("rk"), F.when(F.col("id") != 1, F.col("id").cast("string")).alias("rv"))
    small = lookup_with_default(data, ref, "k", "rk", "rv", "v")
    large = lookup_with_default(data, ref, "k", "rk", "rv", "v", max_broadcast_rows=10)
    plain = lookup_with_default(data, ref, "k", "rk", "rv", "v", max_broadcast_rows=10, prefilter=False)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(small) == rows(large) == rows(plain)

    plans = [str(df._jdf.queryExecution().optimizedPlan()) for df in (large, plain)]
    assert ["scalar-subquery" in p for p in plans] == [True, False] and all("Join LeftOuter" in p for p in plans)
    # what the shuffle's filter lets pass
    held = key_filter(ref, "rk", 3_000)
    passing = data.where(held.may_hold(F.col("k"))).count()
    matching = data.join(ref, F.col("k") == F.col("rk")).count()
    assert matching <= passing < matching + 0.05 * 27_000 < data.where("k IS NOT NULL").count()
