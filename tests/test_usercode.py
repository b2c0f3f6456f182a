"""UDF-1, UDF-2, XML-11: user code in Python over one Arrow pass."""

import datetime as dt
import sys
import time
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

from docflow.functions import pyfields, registry
from docflow.operators.lookup import apply_with_reference
from docflow.operators.xml import explode_records, extract_xml
from docflow.plans import spec as S

SMALL = "/root/testdata/sf0.001"
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers can't import the tests


@registry.register_python("t_join")
def joined(values, string_value):
    return "+".join(values)


@registry.register_python("t_picky")
def picky(values, string_value):
    if "bad" in values:
        raise ValueError("bad")
    return len(values)


@registry.register_python("t_any")
def anything(values, string_value):
    return {"i": 7, "text": "seven", "big": 1 << 40, "d": dt.date(2024, 2, 29), "dec": Decimal("1.5"), "none": None, "b": b"x"}[string_value]


DOCS = [
    "<r><a>1</a><a>2</a><s><a k='x'>3</a></s><g><a>4</a><a>bad</a></g><g/><g><a>5</a></g></r>",
    "<r><a>bad</a></r>",
    None,
    "<r/>",
]


def extracted(spark, spec, docs=DOCS, **kw):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, x string").repartition(2)
    ex = extract_xml(df, "x", spec, keep=["i"], **kw)
    plan = str(ex._jdf.queryExecution().executedPlan())
    return plan, sorted(ex.collect(), key=lambda r: r["i"])


def test_fields_everywhere_in_one_pass(spark):
    spec = S.spec(
        S.fld("all", "string", "a", function="t_join"),
        S.fld("n", "int", "a", function="t_picky"),
        S.fld("sum", "int", "a", function="sum_values"),
        S.fld("s", S.record(S.fld("inner", "string", "a", function="t_join"), S.fld("k", "string", "a/@k", function="t_join")), "s"),
        S.fld("g", S.array(S.record(S.fld("n", "int", "a", function="t_picky"), S.fld("first", "string", "a"), S.fld("all", "string", "a", function="t_join"))), "g"),
        root="r",
    )
    plan, rows = extracted(spark, spec)
    assert plan.count("from_xml(") == 1 and plan.count("ArrowEvalPython") == 1
    a, bad, null, empty = rows
    assert (a["all"], a["n"], a["sum"], tuple(a["s"])) == ("1+2", 2, 3, ("3", "x"))
    assert [tuple(g) for g in a["g"]] == [(None, "4", "4+bad"), (0, None, ""), (1, "5", "5")]
    assert (bad["all"], bad["n"], bad["sum"], bad["s"], bad["g"]) == ("bad", None, None, None, [])
    assert [null[c] for c in ("all", "n", "sum", "s", "g")] == [None] * 5
    assert (empty["all"], empty["n"], empty["sum"], empty["g"]) == ("", 0, 0, [])


def test_values_that_the_type_cannot_hold_are_null(spark):
    names = ["i", "text", "big", "d", "dec", "none", "b", "missing"]
    for kind, good in (("int", {"i": 7}), ("long", {"i": 7, "big": 1 << 40}), ("string", {"text": "seven"}), ("date", {"d": dt.date(2024, 2, 29)})):
        _, rows = extracted(spark, S.spec(S.fld("v", kind, ".", function="t_any"), root="r"), [f"<r>{n}</r>" for n in names])
        got = {n: r["v"] for n, r in zip(names, rows, strict=True)}
        assert {n: v for n, v in got.items() if v is not None and n in good} == good
        assert got["none"] is None and got["missing"] is None


def test_required_python_fields_and_places_that_are_refused(spark):
    spec = S.spec(S.fld("n", "int", "a", nullable=False, function="t_picky"), root="r")
    with pytest.raises(Exception, match="missing required field n"):
        extracted(spark, spec)
    assert [r["n"] for r in extracted(spark, spec, mode="permissive")[1]] == [2, None, None, 0]
    deep = S.record(S.fld("h", S.array(S.record(S.fld("n", "int", "a", function="t_picky"))), "h"))
    with pytest.raises(S.SpecError, match=r"g\[\].h\[\].n|Python field function"):
        extracted(spark, S.spec(S.fld("g", S.array(deep), "g"), root="r"))


def test_pruning_drops_the_python_pass(spark):
    spec = S.spec(S.fld("n", "int", "a", function="t_picky"), S.fld("first", "string", "a"), root="r")
    plan, _ = extracted(spark, spec, columns=["first"])
    assert "Python" not in plan


def test_python_fields_in_a_stream(spark, scratch):
    from docflow.streaming import read_stream, run_available_now

    spark.createDataFrame([(d,) for d in DOCS], "x string").write.parquet(scratch + "/in")
    spec = S.spec(S.fld("all", "string", "a", function="t_join"), S.fld("g", S.array(S.record(S.fld("n", "int", "a", function="t_picky"))), "g"), root="r")
    rows = explode_records(extract_xml(read_stream(spark, scratch + "/in", "x string"), "x", spec), "g")
    run_available_now(rows, scratch + "/out")
    assert sorted((r["all"], str(r["n"])) for r in spark.read.parquet(scratch + "/out").collect()) == [("1+2", "0"), ("1+2", "1"), ("1+2", "None")]


def test_the_query_parses_once_and_has_one_python_stage_per_branch(spark):
    from docflow.workload import QUERIES

    plan = str(QUERIES["xml_python_fields"](spark, SMALL)._jdf.queryExecution().executedPlan())
    assert plan.count("from_xml(") == plan.count("ArrowEvalPython") == 2  # single and split orders


MATCH = pa.struct([("values", pa.list_(pa.field("element", pa.string()))), ("string", pa.string())])


def test_matches_of_a_batch_with_nulls_and_slices():
    rows = [{"values": ["a", None], "string": "x"}, None, {"values": [], "string": ""}, {"values": ["c"], "string": "c"}, {"values": ["d", "e", "f"], "string": "d"}]

    def fn(values, string):
        return 2**40 if string == "x" else len(values) // (string != "c")  # too large, and an error

    def plain(m):
        return None if m is None or m["string"] == "c" else fn(m["values"], m["string"])

    flat, kind = pa.array(rows, MATCH), pa.list_(pa.field("element", pa.int32()))
    for part in (slice(0, 5), slice(1, 4), slice(2, 2)):
        assert pyfields._called(fn, flat[part]) == [plain(m) for m in rows[part]]
    held = [rows[:2], None, [], rows[2:], [None]]
    many = pa.array(held, pa.list_(pa.field("element", MATCH)))
    for part in (slice(0, 5), slice(1, 4), slice(3, 5), slice(2, 2)):
        got = pyfields._called_many(fn, many[part], kind)
        assert got.type == kind
        assert got.to_pylist() == [None if a is None else [None if plain(m) == 2**40 else plain(m) for m in a] for a in held[part]]


def test_matches_reach_python_column_by_column(spark, monkeypatch):
    """A Python object for every match struct and list takes more time than all else."""
    monkeypatch.setattr(pyfields.F, "arrow_udf", lambda run, kind: lambda given: run)
    run = pyfields.python_fields([(lambda values, string: len(values), pyfields.F.lit(None), T.IntegerType(), False)])
    matches = pa.array([{"values": [str(i), "1", "2", "3"], "string": str(i)} for i in range(50_000)], MATCH)
    batch = pa.StructArray.from_arrays([matches], names=["f0"])
    assert set(run(batch).field(0).to_pylist()) == {4}

    def best(work):
        times = []
        for _ in range(3):
            t = time.process_time()
            work()
            times.append(time.process_time() - t)
        return min(times)

    assert best(lambda: run(batch)) < best(matches.to_pylist)


# ---------------------------------------------------------------- user code with a reference


def labelled(reference, key, number):
    return f"{reference.get(key)}/{number}"


def case(spark):
    data = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", None)], "k string, n int").repartition(3)
    ref = spark.createDataFrame([("a", "A"), ("b", None), (None, "N"), ("z", "Z")], "rk string, rv string")
    return data, ref


@pytest.mark.parametrize("max_rows", [100, 0])
def test_reference_semantics_small_and_large(spark, max_rows):
    data, ref = case(spark)
    out = apply_with_reference(data, labelled, ["k", "n"], ref, "k", "rk", "rv", "out", max_broadcast_rows=max_rows)
    plan = str(out._jdf.queryExecution().executedPlan())
    assert out.columns == ["k", "n", "out"]
    got = {(r["k"], r["n"]): r["out"] for r in out.collect()}
    assert got == {("a", 1): "A/1", ("a", None): "A/None", ("b", 2): "None/2", ("c", 3): "UNKNOWN/3", (None, 4): "UNKNOWN/4"}
    # beyond the bound null keys go round the join: one Arrow stage in each branch
    assert plan.count("ArrowEvalPython") == (1 if max_rows else 2) and ("Join" in plan) == (max_rows == 0)


def test_types_other_keys_and_errors(spark):
    data, ref = case(spark)
    sizes = apply_with_reference(data, lambda ref, k: len(ref.get("z") + (ref.get(k) or "")), ["k"], ref, "k", "rk", "rv", "k", "int", default="")
    assert sorted(r["k"] for r in sizes.collect()) == [1, 1, 1, 2, 2] and sizes.schema["k"].dataType.simpleString() == "int"
    other = apply_with_reference(data, lambda ref, k: ref.get("z"), ["k"], ref, "k", "rk", "rv", "o", max_broadcast_rows=0)
    with pytest.raises(Exception, match="only the row's own key"):
        other.collect()
    with pytest.raises(Exception, match="duplicate lookup key"):
        apply_with_reference(data, labelled, ["k", "n"], ref.unionByName(ref), "k", "rk", "rv", "out").collect()
    empty = apply_with_reference(data.where("n > 9"), labelled, ["k", "n"], ref.where("rk = 'q'"), "k", "rk", "rv", "out")
    assert empty.count() == 0
