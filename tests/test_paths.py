"""XML-3, XML-15: paths with conditions and descendants, against plain loops over an element tree."""

import random
import xml.etree.ElementTree as ET

import pytest

from docflow.operators.xml import extract_xml
from docflow.plans import spec as S
from docflow.plans.paths import Compare, Logic, Position, Step, build_trie, parse_path

DOCS = [
    "<shelf id='s1'><box n='1' size='4'><jar w='2'>fig</jar><jar w='10'>plum</jar></box><box n='2'><jar>pear</jar></box><note>x</note></shelf>",
    "<shelf><box n='3' size=' 9 '><jar w='abc'>fig</jar><lid><jar w='7'>deep</jar></lid></box><box/><box n='2'><note>y</note></box></shelf>",
    "<shelf id=''/>",
    "<shelf><note>z</note><box size='4.0'><jar w='-1'>7</jar><jar w='3'> 12 </jar><jar/></box></shelf>",
]


def number(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


def text(e):
    return "".join([e.text or "", *[c.tail or "" for c in e]])


#: path -> the same selection by hand, from the root element
CASES = {
    "box[1]/jar": lambda r: [j for b in r.findall("box")[:1] for j in b.findall("jar")],
    "box/jar[1]": lambda r: [j for b in r.findall("box") for j in b.findall("jar")[:1]],
    "box/jar[last()]": lambda r: [j for b in r.findall("box") for j in b.findall("jar")[-1:]],
    "box/jar[last()-1]": lambda r: [j for b in r.findall("box") for j in b.findall("jar")[-2:-1] if len(b.findall("jar")) > 1],
    "box[position()>1]/jar": lambda r: [j for b in r.findall("box")[1:] for j in b.findall("jar")],
    "box[position()<=2][2]/jar": lambda r: [j for b in r.findall("box")[1:2] for j in b.findall("jar")],
    "box[@n]/jar": lambda r: [j for b in r.findall("box") if b.get("n") is not None for j in b.findall("jar")],
    "box[@n='2']/jar": lambda r: [j for b in r.findall("box") if b.get("n") == "2" for j in b.findall("jar")],
    "box[@n!='2']/jar": lambda r: [j for b in r.findall("box") if b.get("n") not in (None, "2") for j in b.findall("jar")],
    "box[@size=4]/jar": lambda r: [j for b in r.findall("box") if number(b.get("size")) == 4 for j in b.findall("jar")],
    "box[5 < @size]/jar": lambda r: [j for b in r.findall("box") if (number(b.get("size")) or 0) > 5 for j in b.findall("jar")],
    "box[jar='fig']/jar": lambda r: [j for b in r.findall("box") if any(text(j) == "fig" for j in b.findall("jar")) for j in b.findall("jar")],
    "box[jar>6]/jar": lambda r: [j for b in r.findall("box") if any((number(text(j)) or 0) > 6 for j in b.findall("jar")) for j in b.findall("jar")],
    "box[lid]/jar": lambda r: [j for b in r.findall("box") if b.find("lid") is not None for j in b.findall("jar")],
    "box[not(lid) and @n]/jar": lambda r: [j for b in r.findall("box") if b.find("lid") is None and b.get("n") is not None for j in b.findall("jar")],
    "box[lid or @n='2' and note]/jar": lambda r: [j for b in r.findall("box") if b.find("lid") is not None or (b.get("n") == "2" and b.find("note") is not None) for j in b.findall("jar")],
    "box[(lid or @n='2') and jar]/jar": lambda r: [j for b in r.findall("box") if (b.find("lid") is not None or b.get("n") == "2") and b.findall("jar") for j in b.findall("jar")],
    "box/jar[.='fig']": lambda r: [j for b in r.findall("box") for j in b.findall("jar") if text(j) == "fig"],
    "box/jar[.>=7]": lambda r: [j for b in r.findall("box") for j in b.findall("jar") if (number(text(j)) or 0) >= 7],
    "box/jar[@w>1 and position()!=1]": lambda r: [j for b in r.findall("box") for i, j in enumerate(b.findall("jar")) if (number(j.get("w")) or 0) > 1 and i != 0],
    "box/jar[@w][1]": lambda r: [j for b in r.findall("box") for j in [x for x in b.findall("jar") if x.get("w") is not None][:1]],
    "box/jar[position()=last()]": None,
    "box[9]/jar": lambda r: [],
    "//jar[1]": lambda r: [j for e in r.iter() for j in e.findall("jar")[:1]],
    "box//jar": lambda r: [j for b in r.findall("box") for j in b.iter("jar")],
}


def values(nodes):
    return sorted(t for t in (text(n) for n in nodes) if t.strip())


@pytest.mark.parametrize("path", [p for p, f in CASES.items() if f])
def test_conditions_select_what_loops_do(spark, path):
    spec = S.spec(S.fld("v", S.array("string"), path), root="shelf", elements=("box/lid", "box/jar"))
    df = spark.createDataFrame(list(enumerate(DOCS)), "i int, x string")
    got = {r["i"]: sorted(r["v"] or []) for r in extract_xml(df, "x", spec, keep=["i"]).collect()}
    assert got == {i: values(CASES[path](ET.fromstring(d))) for i, d in enumerate(DOCS)}


def test_attributes_records_and_functions_under_conditions(spark):
    spec = S.spec(
        S.fld("w", S.array("string"), "box[@n='1']/jar/@w"),
        S.fld("last", "string", "box[last()]/jar[1]"),
        S.fld("first", "string", "box[jar][last()]/@size"),
        S.fld("boxes", S.array(S.record(S.fld("n", "int", "@n"), S.fld("second", "string", "jar[2]"), S.fld("light", S.array("string"), "jar[@w<5]"))), "box[jar]"),
        S.fld("heavy", S.record(S.fld("w", "string", "@w"), S.fld("name", "string", ".")), "box/jar[@w>5]"),
        S.fld("sum", "int", "box[@n='1']/jar/@w", function="sum_values"),
        S.fld("len", "int", "box[2]/jar", function="string_length"),
        S.fld("deep", S.record(S.fld("w", "string", "@w"), S.fld("said", "string", ".")), "//lid/jar"),
        root="shelf",
    )
    df = spark.createDataFrame(list(enumerate(DOCS)), "i int, x string").repartition(2)
    ex = extract_xml(df, "x", spec, keep=["i"])
    assert str(ex._jdf.queryExecution().executedPlan()).count("from_xml(") == 1
    a, b, c, d = sorted(ex.collect(), key=lambda r: r["i"])
    assert a["w"] == ["2", "10"] and a["last"] == "pear" and a["first"] is None and a["sum"] == 12 and a["len"] == 4
    assert [(x["n"], x["second"], x["light"]) for x in a["boxes"]] == [(1, "plum", ["fig"]), (2, None, None)]
    assert tuple(a["heavy"]) == ("10", "plum") and a["deep"] is None
    assert tuple(b["deep"]) == ("7", "deep") and b["first"] == " 9 " and b["heavy"] is None and b["len"] == 0
    assert c["w"] is None and c["boxes"] == [] and c["sum"] == 0
    assert [(x["n"], x["second"], x["light"]) for x in d["boxes"]] == [(None, " 12 ", ["7", " 12 "])]


def test_descendants_know_all_declared_places_also_when_pruned(spark):
    spec = S.spec(S.fld("every", S.array("string"), "//jar"), S.fld("note", "string", "note"), S.fld("in_lid", "string", "box/lid/jar"), root="shelf")
    df = spark.createDataFrame(list(enumerate(DOCS)), "i int, x string")
    for columns in (None, ["every"], ["every", "note"]):
        got = {r["i"]: sorted(r["every"] or []) for r in extract_xml(df, "x", spec, keep=["i"], columns=columns).collect()}
        assert got == {i: values(ET.fromstring(d).iter("jar")) for i, d in enumerate(DOCS)}


def test_random_paths_equal_loops(spark):
    rng = random.Random(12)

    def tree(depth):
        e = ET.Element(rng.choice("ab"))
        if rng.random() < 0.6:
            e.set("k", str(rng.randint(0, 3)))
        if depth:
            for _ in range(rng.randint(0, 4)):
                e.append(tree(depth - 1))
        if not len(e):
            e.text = str(rng.randint(0, 4))
        return e

    docs = []
    for _ in range(40):
        root = ET.Element("root")
        for _ in range(rng.randint(0, 4)):
            root.append(tree(2))
        docs.append(root)
    conditions = [
        ("", lambda i, n, e: True), ("[1]", lambda i, n, e: i == 0), ("[last()]", lambda i, n, e: i == n - 1), ("[@k='2']", lambda i, n, e: e.get("k") == "2"),
        ("[@k<2]", lambda i, n, e: e.get("k") in ("0", "1")), ("[not(@k)]", lambda i, n, e: e.get("k") is None), ("[a]", lambda i, n, e: e.find("a") is not None),
        ("[b>1]", lambda i, n, e: any((number(text(x)) or 0) > 1 for x in e.findall("b"))), ("[position()>1]", lambda i, n, e: i > 0),
    ]
    fields, expected = [], []
    for f in range(40):
        path, chosen = [], []
        for _ in range(rng.randint(1, 3)):
            name, (cond, test) = rng.choice("ab"), rng.choice(conditions)
            path.append(name + cond)
            chosen.append((name, test))

        def select(e, chosen=tuple(chosen)):
            nodes = [e]
            for name, test in chosen:
                nodes = [c for x in nodes for i, c in enumerate(x.findall(name)) if test(i, len(x.findall(name)), c)]
            return [text(n) for n in nodes if text(n).strip()]

        fields.append(S.fld(f"f{f}", S.array("string"), "/".join(path)))
        expected.append(select)
    df = spark.createDataFrame([(i, ET.tostring(d, encoding="unicode")) for i, d in enumerate(docs)], "i int, x string")
    for r in extract_xml(df, "x", S.spec(*fields, root="root"), keep=["i"]).collect():
        assert [r[f"f{f}"] or [] for f in range(40)] == [e(docs[r["i"]]) for e in expected]


def test_parsed_form():
    assert parse_path("a[2]/b[@c='x/]y']/@d") == [Step("a", tests=(Position(2),)), Step("b", tests=(Compare("@c", "=", "x/]y"),)), Step("d", attr=True)]
    assert parse_path(".//p:a[not(b) or .>3]") == [Step("p:a", tests=(Logic("or", (Logic("not", (Compare("b"),)), Compare(".", ">", 3.0))),), descend=True)]
    trie = build_trie((S.fld("x", "string", "a//b"), S.fld("y", "string", "a/c/d")))
    assert sorted(trie.children["a"].places["b"]) == [(), ("c",), ("c", "d")]


@pytest.mark.parametrize(
    "path",
    ["/a", "a/", "a//", "///a", "a///b", "//", "a[", "a[]", "a]", "a[1", "a['x']", "a[@]", "a[1.5]", "a[position()]", "a[b=]", "a[=2]", "a[b and]", "a[not(b]", "a[b]c",
     "a/@b/c", "@b[1]", "a//@b", "a/*", "a/text()", "a[b()]", "..", "a/..", "a[@b='x]", "a[b=c]"],
)
def test_unusable_paths_name_the_field(path):
    with pytest.raises(S.SpecError, match="field 'f'"):
        build_trie((S.fld("f", "string", path),))


def test_conditions_keep_one_parse_and_narrow_plans(spark):
    from docflow.workload import QUERIES

    for name in ("xml_conditional_paths", "xml_positional_paths"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml(") <= 2 and "Python" not in plan
