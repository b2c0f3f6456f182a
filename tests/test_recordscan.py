"""SRC-3, XML-9, XML-13: splittable scans of large files, against an XML parser."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from docflow.operators.recordscan import open_tags, records_in, scan_chunks, scan_records, state_after
from docflow.operators.xml import explode_records, read_xml, read_xml_documents
from docflow.plans import spec as S


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(tmp_path, *texts):
    for i, t in enumerate(texts):
        (tmp_path / f"f{i}.xml").write_text(t)
    return str(tmp_path)


def canonical(xml):
    return ET.canonicalize(xml, strip_text=False, with_comments=False)


def expected(text, tag):
    return sorted(canonical(ET.tostring(e, encoding="unicode").rsplit(">", 1)[0] + ">") for e in ET.fromstring(text).iter(tag))


def scanned(df):
    return sorted(canonical(r["xml"]) for r in df.collect())


def test_plain_files_stay_in_the_jvm_and_split(spark, tmp_path, small_splits):
    text = "<?xml version='1.0'?>\n<all>\n" + "".join(f"<rec n='{i}'><v>é{i}</v><record>no</record></rec>\n" for i in range(100)) + "</all>\n"
    df = scan_records(spark, write(tmp_path, text), "rec")
    assert df.rdd.getNumPartitions() > 5 and scanned(df) == expected(text, "rec")
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


MARKED = [
    "<all><!-- <rec n='0'>gone</rec> --><rec n='1'>a<!-- </rec> -->b</rec><rec n='2'><![CDATA[</rec><rec>]]></rec></all>",
    "<all><rec n='1'/><rec n='2' x='a>b'/>\n<rec n='3'>x</rec ><rec n='4'>y</rec\n></all>",
    "<all>" + "".join(f"<rec n='{i}'>{'<!-- ' + '</rec><rec> ' * (i % 60) + '-->' if i % 3 == 0 else ''}t{i}</rec>" for i in range(80)) + "</all>",
    "<all><!--" + "<rec n='x'>old</rec>\n" * 100 + "--><rec n='1'>new</rec>" + "<rec n='2'><![CDATA[" + "</rec> <!-- " * 150 + "]]></rec></all>",
    "<all><rec>--> ]]&gt; </rec><!-- <![CDATA[ --><rec>k</rec><![CDATA[ <!-- ]]><rec>l</rec></all>",
    "<all/>",
    "<rec>root itself</rec>",
]


@pytest.mark.parametrize("i", range(len(MARKED)))
def test_marks_and_unusual_records(spark, tmp_path, small_splits, i):
    assert scanned(scan_records(spark, write(tmp_path, MARKED[i]), "rec")) == expected(MARKED[i], "rec")


def test_many_files_at_once_with_random_marks(spark, tmp_path, small_splits):
    rng = random.Random(5)
    texts = [m for m in MARKED if m.startswith("<all>")]
    for _ in range(12):
        parts = []
        for n in range(rng.randint(0, 40)):
            fill = rng.choice(["", "x" * rng.randint(0, 200), "<!--" + "</rec>" * rng.randint(0, 90) + "-->", "<![CDATA[" + "<rec>" * rng.randint(0, 90) + "</rec>]]>", "<a><b/></a>"])
            parts.append(f"<rec n='{n}'>{fill}</rec>" if rng.random() < 0.8 else f"<rec n='{n}'/>")
            parts.append(rng.choice(["", "\n", "<!-- <rec n='no'>" + "-" * 1 + "</rec> -->", "<other>text</other>"]))
        texts.append("<all>" + "".join(parts) + "</all>")
    assert scanned(scan_records(spark, write(tmp_path, *texts), "rec")) == sorted(x for t in texts for x in expected(t, "rec"))


def test_read_xml_splits_a_file(spark, tmp_path, small_splits):
    text = "<all>" + "".join(f"<rec n='{i}'><v>{i * 2}</v></rec>" for i in range(200)) + "</all>"
    spec = S.spec(S.fld("n", "int", "@n"), S.fld("v", "long", "v"))
    path = write(tmp_path, text)
    one, many = read_xml(spark, path, spec, "rec", splittable=False), read_xml(spark, path, spec, "rec")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) == [(i, 2 * i) for i in range(200)]
    assert many.rdd.getNumPartitions() > one.rdd.getNumPartitions()
    assert read_xml(spark, path, spec, "rec", columns=["v"]).agg(F.sum("v")).first()[0] == sum(range(200)) * 2


# ---------------------------------------------------------------- documents larger than a row


def document(name, n, footer=True, group="rows"):
    rows = "".join(f"<row k='{i}'><v>{i % 7}</v></row>" + ("\n" if i % 5 else "<!-- </row> -->") for i in range(n))
    return f"<doc name='{name}'><made by='x'/><note>a &lt; b</note><{group}>{rows}</{group}>" + ("<total>9</total>" if footer else "") + "</doc>"


DOC_SPEC = S.spec(
    S.fld("name", "string", "@name"), S.fld("note", "string", "note"), S.fld("by", "string", "made/@by"), S.fld("total", "int", "total"),
    S.fld("rows", S.array(S.record(S.fld("k", "int", "@k"), S.fld("v", "int", "v"))), "rows/row"), root="doc",
)


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_chunks_carry_the_document_start(spark, tmp_path, small_splits, rows):
    sizes = {"a": 150, "b": 0, "c": 3, "d": 90, "e": 1}
    text = "<docs>" + "\n".join(document(n, k, footer=n != "d") for n, k in sizes.items()) + "<doc name='f'/></docs>"
    path = write(tmp_path, text, document("alone", 40))
    sizes |= {"f": 0, "alone": 40}
    chunks = scan_chunks(spark, path, "doc", "row", rows=rows)
    held = chunks.collect()
    assert all(ET.fromstring(c["xml"]) is not None for c in held)
    assert max(c["xml"].count("<row ") for c in held) <= rows
    assert sum(c["first"] for c in held) == sum(c["last"] for c in held) == len(sizes)
    docs = read_xml_documents(spark, path, DOC_SPEC, "doc", "row", rows=rows)
    got = explode_records(docs, "rows").groupBy("name", "note", "by").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"), F.sum("v").alias("v"))
    assert sorted(map(tuple, got.collect())) == sorted((n, "a < b", "x", k, sum(range(k)), sum(i % 7 for i in range(k))) for n, k in sizes.items() if k)
    totals = docs.where("last").select("name", "total").collect()
    assert {r["name"]: r["total"] for r in totals} == {n: None if n in ("d", "f") else 9 for n in sizes}


def test_groups_that_close_and_open_again_stay_well_formed(spark, tmp_path, small_splits):
    text = "<doc name='a'>" + "".join(f"<g i='{i}'><rows><row>{i}</row><row>x</row></rows></g>" for i in range(50)) + "</doc>"
    chunks = scan_chunks(spark, write(tmp_path, text), "doc", "row", rows=3).collect()
    found = [r.text for c in sorted(chunks, key=lambda c: (c["block"], c["seq"])) for r in ET.fromstring(c["xml"]).iter("row")]
    assert found == [x for i in range(50) for x in (str(i), "x")]


def test_one_document_of_many_rows_in_bounded_chunks(spark, tmp_path):
    n = 200_000
    with open(tmp_path / "big.xml", "w") as f:
        f.write("<doc name='big'><note>n</note><rows>")
        f.writelines(f"<row k='{i}'><v>{i % 7}</v></row>" for i in range(n))
        f.write("</rows><total>5</total></doc>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        docs = read_xml_documents(spark, str(tmp_path), DOC_SPEC, "doc", "row", rows=500)
        assert docs.rdd.getNumPartitions() >= 10
        row = explode_records(docs, "rows").agg(F.count(F.lit(1)), F.sum(F.col("k").cast("long")), F.min("name"), F.max("name")).first()
        assert tuple(row) == (n, n * (n - 1) // 2, "big", "big")
        assert docs.agg(F.max(F.size("rows"))).first()[0] <= 500 and docs.where("total = 5").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_parts():
    assert state_after("a <!-- <![CDATA[ ", 0) == 1 and state_after(" ]]> ", 1) == 1 and state_after("]]> <!-- -->", 2) == 0
    assert records_in("x<r/><!--<r>--><r a='>'>1</r ><rr/><r>2</r>", "r") == ["<r/>", "<r a='>'>1</r >", "<r>2</r>"]
    assert open_tags("<a x='>'><b/><!-- <c> --><d></d><e>") == ["a", "e"]
    with pytest.raises(ValueError, match="element name"):
        scan_records(None, "x", "a b")
