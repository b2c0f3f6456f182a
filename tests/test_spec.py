import json

import pytest
from pyspark.sql import types as T

from docflow.plans import spec as S
from docflow.plans.compile import raw_schema
from docflow.plans.paths import parse_path
from fixtures import RECIPE_JSON


def test_to_struct_types_and_nullability():
    s = S.from_json(json.dumps(RECIPE_JSON))
    st = s.to_struct()
    f = {x.name: x for x in st.fields}
    assert f["servings"].dataType == T.IntegerType() and not f["servings"].nullable
    assert f["price"].nullable and f["source"].nullable and not f["vegan"].nullable
    assert f["price"].dataType == T.DecimalType(12, 4)
    assert f["published"].dataType == T.TimestampType() and f["tested"].dataType == T.DateType()
    assert f["photo"].dataType == T.BinaryType() and f["grams"].dataType == T.ArrayType(T.LongType())
    assert [x.name for x in f["steps"].dataType.elementType] == ["minutes", "said", "no"]
    assert f["method"].dataType["steps"].dataType == f["steps"].dataType and not f["method"].dataType["steps"].nullable
    assert s.root == "recipe"


def test_missing_xpath_is_a_clear_error():
    bad = {"type": "record", "fields": [{"name": "a", "type": "int"}]}
    with pytest.raises(S.SpecError, match="'a' has no 'xpath'"):
        S.from_json(bad)


@pytest.mark.parametrize("t", ["map", {"type": "enum", "symbols": ["A"]}, {"type": "fixed", "size": 2},
                               ["int", "string"], {"type": "int", "logicalType": "time-millis"}])
def test_unsupported_types(t):
    with pytest.raises(S.SpecError):
        S.from_json({"type": "record", "fields": [{"name": "a", "type": t, "xpath": "a"}]})


def test_paths():
    assert parse_path(".") == []
    assert [(s.name, s.attr) for s in parse_path("a/b/@c")] == [("a", False), ("b", False), ("c", True)]
    assert [(s.name, s.attr) for s in parse_path("x:t/@x:a")] == [("x:t", False), ("x:a", True)]
    for bad in ["/a", "a[1", "../a", "a/@b/c", "count(a)", "a/text()", ""]:
        with pytest.raises(S.SpecError, match="unsupported path|empty path"):
            parse_path(bad, "f")


def test_prune_and_raw_schema_only_needed_fields():
    s = S.from_json(RECIPE_JSON)
    p = s.prune(["vegan", "tags"])
    assert p.names == ["vegan", "tags"]
    raw = raw_schema(p)
    assert raw.fieldNames() == ["@vegan", "tags"]
    with pytest.raises(S.SpecError, match="no field"):
        s.prune(["nope"])


def test_shared_prefix_paths_merge_into_one_element():
    s = S.from_json(RECIPE_JSON)
    raw = raw_schema(s)
    assert raw["method"].dataType.elementType.fieldNames() == ["step"]  # array path and record share the element
    assert raw.fieldNames().count("method") == 1


def test_function_needs_scalar():
    with pytest.raises(S.SpecError):
        S.fld("x", S.array("int"), "a", function="sum_values")


def test_load_spec_file(tmp_path):
    p = tmp_path / "mapping.json"
    p.write_text(json.dumps(RECIPE_JSON))
    s = S.load(p)
    assert s.names == [f["name"] for f in RECIPE_JSON["fields"]]
    assert s.field("method").type.fields[0].path == "step"


def test_prune_nested_subfields():
    s = S.from_json(RECIPE_JSON)
    p = s.prune(["steps.no", "method.steps.said", "oven.heat", "oven", "title"])
    assert p.names == ["steps", "method", "oven", "title"]
    assert [f.name for f in p.field("steps").type.element.fields] == ["no"]
    assert [f.name for f in p.field("method").type.fields[0].type.element.fields] == ["said"]
    assert [f.name for f in p.field("oven").type.fields] == ["heat", "fan"]  # whole field wins
    with pytest.raises(S.SpecError, match="no field 'nope' in 'steps'"):
        s.prune(["steps.nope"])
    with pytest.raises(S.SpecError, match="no subfields"):
        s.prune(["title.x"])
