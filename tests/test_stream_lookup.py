"""LKP-1 in streams: a reference that changes between micro-batches, and restarts."""

import pytest

from docflow import streaming as ST


def put(spark, folder, rows, schema="k string, n int"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def refer(spark, folder, rows):
    spark.createDataFrame(rows, "rk string, rv string").coalesce(1).write.mode("overwrite").parquet(folder)


def run(spark, scratch, reads=None):
    def reference():
        if reads is not None:
            reads.append(1)
        return spark.read.parquet(scratch + "/ref")

    stream = ST.read_stream(spark, scratch + "/in", "k string, n int")
    q = ST.append_with_fresh_lookup(stream, reference, [scratch + "/ref"], "k", "rk", "rv", "out", scratch + "/out")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def written(spark, scratch):
    return sorted((r["k"], r["n"], r["out"]) for r in ST.read_batches(spark, scratch + "/out").collect())


def test_each_batch_sees_the_reference_of_its_time(spark, scratch):
    reads = []
    refer(spark, scratch + "/ref", [("a", "A1")])
    put(spark, scratch + "/in", [("a", 1), ("b", 1)])
    run(spark, scratch, reads)
    put(spark, scratch + "/in", [("a", 2)])
    run(spark, scratch, reads)  # unchanged: neither read nor written again
    assert len(reads) == 1
    refer(spark, scratch + "/ref", [("a", "A3"), ("b", "B3")])
    put(spark, scratch + "/in", [("a", 3), ("b", 3)])
    run(spark, scratch, reads)
    run(spark, scratch, reads)  # nothing new
    assert written(spark, scratch) == [("a", 1, "A1"), ("a", 2, "A1"), ("a", 3, "A3"), ("b", 1, "UNKNOWN"), ("b", 3, "B3")]
    assert len(reads) == 2


@pytest.mark.parametrize("after_write", [True, False])
def test_a_batch_tried_again_writes_its_rows_once_from_its_snapshot(spark, scratch, monkeypatch, after_write):
    refer(spark, scratch + "/ref", [("a", "old")])
    put(spark, scratch + "/in", [("a", 1), ("b", 1)])
    real = ST.lookup_with_default
    tries = []

    def fails(batch, *args, **kw):
        rows = real(batch, *args, **kw)
        tries.append(1)
        if len(tries) == 1:
            if after_write:  # the rows are written, the batch isn't committed
                rows.write.mode("overwrite").parquet(scratch + "/out/batch=0")
            raise RuntimeError("lost")
        return rows

    monkeypatch.setattr(ST, "lookup_with_default", fails)
    with pytest.raises(Exception, match="lost"):
        run(spark, scratch)
    refer(spark, scratch + "/ref", [("a", "new"), ("b", "new")])
    put(spark, scratch + "/in", [("a", 2)])
    run(spark, scratch)
    assert written(spark, scratch) == [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "UNKNOWN")]
