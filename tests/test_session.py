"""Intermediates: each step deletes its own, whatever other threads write meanwhile."""

import threading
import time

import pytest

from docflow.session import _hadoop_path, derived_table, intermediates, materialize, materialize_step, shared_dir


def there(spark, path):
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def test_a_step_deletes_its_own_intermediates_only(spark):
    paths = {}

    def build(name, wait):
        def inner():
            df = materialize(spark.range(10), name)
            paths[name] = df.inputFiles()[0].rsplit("/", 1)[0]
            time.sleep(wait)  # other steps begin and end meanwhile
            return df.selectExpr("id * 2 AS id")
        return inner

    results = {}

    def run(name, wait):
        results[name] = materialize_step(spark, build(name, wait), name)

    threads = [threading.Thread(target=run, args=(f"step{i}", w)) for i, w in enumerate((3.0, 0.0, 1.0))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(results) == ["step0", "step1", "step2"]
    for name, (df, path) in results.items():
        assert df.agg({"id": "sum"}).first()[0] == 90 and there(spark, path) and not there(spark, paths[name])


def test_blocks_nest_and_keep_shared_tables(spark):
    with intermediates(spark):
        outer = shared_dir(spark, "outer")
        spark.range(3).write.parquet(outer)
        kept, path = materialize_step(spark, lambda: materialize(spark.range(5), "inner"), "step")
        held = derived_table(spark, f"test-{outer}", lambda: spark.range(4))
        assert kept.count() == 5 and there(spark, outer)
    assert not there(spark, outer) and not there(spark, path) and there(spark, held)
    with pytest.raises(ZeroDivisionError), intermediates(spark):
        failed = shared_dir(spark, "failed")
        spark.range(1).write.parquet(failed)
        raise ZeroDivisionError
    assert not there(spark, failed)
    free = shared_dir(spark, "free")
    spark.range(1).write.parquet(free)
    assert there(spark, free)
