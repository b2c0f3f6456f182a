"""XML-1..15, FN-2..10, AGG-3/4: extraction rules on small hand-written documents."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docflow.operators.xml import explode_records, extract_xml
from docflow.plans import spec as S
from fixtures import ATTRIBUTES, BARE, NO_YIELD, OVEN, PARTS, RECIPE_JSON, STEPS

SPEC = S.from_json(RECIPE_JSON)


def one(spark, doc, spec, **kw):
    df = spark.createDataFrame([(doc,)], "x string")
    return extract_xml(df, "x", spec, **kw).collect()[0]


def test_attributes_and_defaults(spark):
    r = one(spark, ATTRIBUTES, SPEC)
    assert (r.title, r.servings, r.vegan) == ("Rye", 12, True)  # "True": any case
    assert r.published == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)  # epoch millis, UTC session
    assert r.source is None  # a default is never applied
    assert one(spark, STEPS, SPEC).vegan is False


def test_arrays_of_records_over_a_repeated_parent(spark):
    r = one(spark, STEPS, SPEC)
    assert [(s.no, s.minutes, s.said) for s in r.steps] == [(1, 2.5, "mix"), (2, 40.0, "rise"), (3, None, "bake")]
    assert [s.no for s in r.method.steps] == [1, 2]  # a record is the first node that matches


def test_records_take_the_first_node(spark):
    r = one(spark, OVEN, SPEC)
    assert (r.oven.heat, r.oven.fan) == (182.5, True)
    assert (r.author.id, r.author.name) == (77, "R. Baker")  # '.' path beside an attribute


def test_values_that_are_absent_or_blank_are_skipped(spark):
    r = one(spark, PARTS, SPEC)
    assert r.grams == [250, 80] and r.tags == ["warm", "quick"]
    assert r.price == Decimal("1250.7500") and r.tested == dt.date(2024, 3, 18) and bytes(r.photo) == b"YQ=="


def test_no_match_gives_null_or_an_empty_array(spark):
    r = one(spark, BARE, SPEC)
    assert r.tags is None and r.grams is None  # array of primitive: null when no match
    assert r.steps == []  # array of records: empty when no match
    assert r.oven is None and r.method is None and r.price is None  # records and scalars: null


def test_missing_required_field_fails_in_strict_mode(spark):
    with pytest.raises(Exception, match="missing required field servings"):
        one(spark, NO_YIELD, SPEC)
    assert one(spark, NO_YIELD, SPEC, mode="permissive").servings is None


def test_null_document_gives_null_row(spark):
    df = spark.createDataFrame([(None,)], "x string")
    r = extract_xml(df, "x", SPEC).collect()[0]
    assert all(v is None for v in r)


def test_bytes_input_column(spark):
    df = spark.createDataFrame([(bytearray(PARTS.encode()),)], "x binary")
    r = extract_xml(df, "x", SPEC, columns=["servings", "grams"]).collect()[0]
    assert (r.servings, r.grams) == (2, [250, 80])


EDGE = """<r a="" b="1" x:n="ns">
  <t/><t>   </t><t>v1</t><t>v2</t>
  <mix>first<b/>last</mix>
  <x:t>pre</x:t>
  <c><![CDATA[<not a tag> & more]]></c>
  <e>a &amp; b &lt; c</e>
  <p q="1"/><p/><p q="3"/>
  <deep><p q="9"/></deep>
</r>"""


def test_edge_rules(spark):
    sp = S.spec(
        S.fld("a", "string", "@a"),
        S.fld("ts", S.array("string"), "t"),
        S.fld("t1", "string", "t"),
        S.fld("mix_last", "string", "mix", text="last"),
        S.fld("mix_first", "string", "mix"),
        S.fld("ns_el", "string", "x:t"),
        S.fld("ns_at", "string", "@x:n"),
        S.fld("cdata", "string", "c"),
        S.fld("ent", "string", "e"),
        S.fld("qs", S.array("int"), "p/@q"),
        S.fld("deep_q", "int", "deep/p/@q"),
        S.fld("xp", "string", "/r/deep/p/@q", engine="xpath"),
        root="r",
    )
    r = one(spark, EDGE, sp)
    assert r.a == ""  # an empty attribute is a value
    assert r.ts == ["v1", "v2"] and r.t1 == "v1"  # empty and blank elements are skipped
    assert r.mix_last == "last" and r.mix_first == "first"
    assert r.ns_el == "pre" and r.ns_at == "ns"  # prefixes are part of the names
    assert r.cdata == "<not a tag> & more" and r.ent == "a & b < c"
    assert r.qs == [1, 3]  # p/@q: only elements that have the attribute
    assert r.deep_q == 9 and r.xp == "9"


def test_ignore_namespace(spark):
    sp = S.spec(S.fld("t", "string", "t"))
    assert one(spark, "<x:r xmlns:x='u'><x:t>v</x:t></x:r>", sp, ignore_namespace=True).t == "v"


@pytest.mark.parametrize("bad", ["<r><a></r>", "", "<r>unclosed"])
def test_malformed_failfast_and_permissive(spark, bad):
    sp = S.spec(S.fld("a", "string", "a"))
    df = spark.createDataFrame([(bad,), ("<r><a>ok</a></r>",)], "x string")
    with pytest.raises(Exception):
        extract_xml(df, "x", sp).collect()
    rows = sorted(extract_xml(df, "x", sp, malformed="permissive").collect(), key=lambda r: r.a or "")
    assert rows[0].a is None and rows[0]._corrupt_record == bad
    assert rows[1].a == "ok" and rows[1]._corrupt_record is None


VALUES = """<v i="x" j=" 5" k="+7" big="3000000000" b1="yes" b2="TRUE " b3="tRuE" d10="0.1234567891"
  d9="0.123456789" dz="1.50000000000" de="1.5e-10" day="30000" neg="-1" ts="1" f="2.5"/>"""


def test_conversion_rules_permissive(spark):
    sp = S.spec(
        S.fld("i", "int", "@i"), S.fld("j", "int", "@j"), S.fld("k", "int", "@k"), S.fld("big", "int", "@big"),
        S.fld("bigl", "long", "@big"),
        S.fld("b1", "boolean", "@b1"), S.fld("b2", "boolean", "@b2"), S.fld("b3", "boolean", "@b3"),
        S.fld("d10", S.scalar("decimal"), "@d10"), S.fld("d9", S.scalar("decimal"), "@d9"),
        S.fld("dz", S.scalar("decimal"), "@dz"), S.fld("de", S.scalar("decimal"), "@de"),
        S.fld("day", "date", "@day"), S.fld("neg", "date", "@neg"),
        S.fld("tus", S.scalar("timestamp", unit="micros"), "@ts"), S.fld("f", "float", "@f"),
    )
    r = one(spark, VALUES, sp, mode="permissive")
    assert r.i is None and r.j is None and r.k == 7 and r.big is None and r.bigl == 3000000000
    assert (r.b1, r.b2, r.b3) == (False, False, True)
    assert r.d10 is None and r.d9 == Decimal("0.123456789") and r.dz == Decimal("1.5") and r.de is None
    assert r.day == dt.date(2052, 2, 20) and r.neg == dt.date(1969, 12, 31)
    assert r.tus == dt.datetime(1970, 1, 1, 0, 0, 0, 1)
    assert r.f == 2.5


@pytest.mark.parametrize("field", [S.fld("i", "int", "@i"), S.fld("d", S.scalar("decimal"), "@d10")])
def test_conversion_errors_raise_in_strict_mode(spark, field):
    with pytest.raises(Exception, match="cannot convert"):
        one(spark, VALUES, S.spec(field))


def test_field_functions(spark):
    sp = S.spec(
        S.fld("len", "int", "name", function="string_length"),
        S.fld("len_none", "int", "nothing", function="string_length"),
        S.fld("sum_attr", "int", "n/@v", function="sum_values"),
        S.fld("sum_text", "int", "n", function="sum_values"),
        S.fld("sum_none", "int", "zzz", function="sum_values"),
        S.fld("sum_bad", "int", "bad", function="sum_values"),
    )
    doc = "<r><name>héllo</name><n v='1'>10</n><n v='2'>20</n><n v='-4'>5</n><bad>1</bad><bad>x</bad></r>"
    r = one(spark, doc, sp)
    assert (r.len, r.len_none) == (5, 0)
    assert (r.sum_attr, r.sum_text, r.sum_none, r.sum_bad) == (-1, 35, 0, None)


def test_unknown_function_fails_on_driver(spark):
    with pytest.raises(S.SpecError, match="unknown field function"):
        extract_xml(spark.createDataFrame([("<r/>",)], "x string"), "x", S.spec(S.fld("a", "int", "a", function="nope")))


def test_user_registered_function(spark):
    from docflow.functions import registry

    registry.register("count_matches", lambda m: F.size(m.values))
    r = one(spark, "<r><a>1</a><a/><a>2</a></r>", S.spec(S.fld("n", "int", "a", function="count_matches")))
    assert r.n == 2


def test_explode_records_inner_and_outer(spark):
    df = spark.createDataFrame([(1, "<r><l n='1'/><l n='2'/></r>"), (2, "<r/>")], "id int, x string")
    ex = extract_xml(df, "x", S.spec(S.fld("ls", S.array(S.record(S.fld("n", "int", "@n"))), "l")), keep=["id"])
    assert sorted(tuple(r) for r in explode_records(ex, "ls").collect()) == [(1, 1), (1, 2)]
    assert sorted(tuple(r) for r in explode_records(ex, "ls", outer=True).collect()) == [(1, 1), (1, 2), (2, None)]


def test_one_parse_per_document_in_plan(spark):
    df = spark.createDataFrame([(STEPS,)], "x string")
    ex = explode_records(extract_xml(df, "x", SPEC, columns=["title", "steps"]), "steps")
    plan = ex._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml(") == 1


def test_bytes_in_another_encoding(spark):
    doc = '<r name="Müller"><c>ça</c></r>'.encode("iso-8859-1")
    df = spark.createDataFrame([(bytearray(doc),)], "x binary")
    sp = S.spec(S.fld("name", "string", "@name"), S.fld("c", "string", "c"))
    r = extract_xml(df, "x", sp, encoding="ISO-8859-1").collect()[0]
    assert (r.name, r.c) == ("Müller", "ça")


def test_xpath_engine_string_value_of_element(spark):
    sp = S.spec(
        S.fld("len_all", "int", "/r/mix", engine="xpath", function="string_length"),
        S.fld("len_own", "int", "mix", function="string_length"),
        S.fld("texts", S.array("string"), "/r/mix//text()", engine="xpath"),
        root="r",
    )
    r = one(spark, "<r><mix>first<b>mid</b>last</mix></r>", sp)
    assert r.len_all == len("firstmidlast")  # XPath string value: all descendant text
    assert r.len_own == len("firstlast")  # own text, all runs (documented)
    assert r.texts == ["first", "mid", "last"]


def test_nested_pruning_gives_the_same_values(spark):
    full = one(spark, STEPS, SPEC)
    r = one(spark, STEPS, SPEC, columns=["steps.minutes", "method.steps.no", "title"])
    assert [s.asDict() for s in r.steps] == [{"minutes": s.minutes} for s in full.steps]
    assert [s.no for s in r.method.steps] == [s.no for s in full.method.steps] and r.title == full.title
    assert one(spark, OVEN, SPEC, columns=["oven.heat"]).oven.asDict() == {"heat": 182.5}
    assert one(spark, BARE, SPEC, columns=["steps.no"]).steps == []  # still empty, not null


def test_text_runs_inside_records(spark):
    sp = S.spec(
        S.fld("rs", S.array(S.record(S.fld("a", "string", "m"), S.fld("z", "string", "m", text="last"), S.fld("n", "int", "m", function="string_length"))), "r"),
        S.fld("ms", S.array("string"), "r/m"),
    )
    r = one(spark, "<d><r><m>one<b/>two</m></r><r><m/><m>x<!-- c -->y</m></r><r/></d>", sp)
    assert [(x.a, x.z, x.n) for x in r.rs] == [("one", "two", 6), ("x", "y", 0), (None, None, 0)]
    assert r.ms == ["one", "x"]


def test_first_match_is_linear(spark):
    """A scalar over very many matches costs about what the array of them costs."""
    import time

    n = 60_000
    doc = "<r>" + "".join(f"<a><b>{i}</b></a>" for i in range(n)) + "</r>"
    df = spark.createDataFrame([(doc,)], "x string")
    took = {}
    for name, f in (("array", S.fld("v", S.array("int"), "a/b")), ("scalar", S.fld("v", "int", "a/b"))):
        extract_xml(df, "x", S.spec(f)).collect()
        t = time.time()
        v = extract_xml(df, "x", S.spec(f)).first().v
        took[name] = time.time() - t
        assert v == 0 if name == "scalar" else len(v) == n
    assert took["scalar"] < 3 * took["array"] + 2


def test_names_in_any_script_and_case(spark):
    sp = S.spec(S.fld("v", "int", "été/@größe"), S.fld("w", "string", "名"))
    r = one(spark, "<r><été größe='3'/><名>n</名></r>", sp)
    assert (r.v, r.w) == (3, "n")
    both = S.spec(S.fld("up", "string", "A"), S.fld("low", "string", "a"))
    with pytest.raises(S.SpecError, match="caseSensitive"):
        one(spark, "<r><A>1</A><a>2</a></r>", both)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        r = one(spark, "<r><A>1</A><a>2</a></r>", both)
        assert (r.up, r.low) == ("1", "2")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_declared_encodings(spark):
    text = "<?xml version='1.0' encoding='{}'?><r n='Ünï'/>"
    docs = [text.format(e).encode(e) for e in ("UTF-8", "iso-8859-1", "UTF-16")] + ["<r n='Ünï'/>".encode()]
    df = spark.createDataFrame([(bytearray(d),) for d in docs], "x binary")
    assert [r.n for r in extract_xml(df, "x", S.spec(S.fld("n", "string", "@n"))).collect()] == ["Ünï"] * 4


def test_trailing_line_end_is_no_integer(spark):
    sp = S.spec(S.fld("n", "int", "n"), S.fld("s", "int", "n", function="sum_values"))
    r = one(spark, "<r><n>5\n</n></r>", sp, mode="permissive")
    assert (r.n, r.s) == (None, None)
    with pytest.raises(Exception, match="cannot convert"):
        one(spark, "<r><n>5\n</n></r>", sp)
