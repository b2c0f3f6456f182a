"""Property test: random records → XML text → extract_xml gives the same values back.

One Hypothesis example is a whole batch of records, extracted by one Spark job.
"""

import datetime as dt
from decimal import Decimal
from xml.sax.saxutils import escape, quoteattr

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docflow.operators.xml import extract_xml
from docflow.plans import spec as S

SPEC = S.spec(
    S.fld("id", "long", "@id", nullable=False),
    S.fld("name", "string", "@name"),
    S.fld("note", "string", "note"),
    S.fld("amount", S.scalar("decimal", precision=20, scale=4), "amount"),
    S.fld("day", "date", "day"),
    S.fld("flag", "boolean", "@flag"),
    S.fld("tags", S.array("string"), "tags/tag"),
    S.fld("items", S.array(S.record(S.fld("q", "int", "@q"), S.fld("label", "string", "."))), "item"),
)

text = st.text(
    alphabet=st.characters(blacklist_categories=("Cs", "Cc"), blacklist_characters="\r"), min_size=1, max_size=12
).filter(lambda s: s.strip() != "")
record = st.fixed_dictionaries({
    "name": st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), max_size=8)),
    "note": st.one_of(st.none(), text),
    "amount": st.decimals(min_value=-10**9, max_value=10**9, places=4, allow_nan=False, allow_infinity=False),
    "day": st.integers(min_value=-30000, max_value=60000),
    "flag": st.sampled_from(["true", "TRUE", "false", "yes", "1", ""]),
    "tags": st.lists(text, max_size=4),
    "items": st.lists(st.tuples(st.integers(-2**31, 2**31 - 1), text), max_size=3),
})


def to_xml(i, r):
    parts = [f"<rec id=\"{i}\" flag={quoteattr(r['flag'])}" + (f" name={quoteattr(r['name'])}" if r["name"] is not None else "") + ">"]
    if r["note"] is not None:
        parts.append(f"<note>{escape(r['note'])}</note>")
    parts.append(f"<amount>{r['amount']}</amount><day>{r['day']}</day>")
    if r["tags"]:
        parts.append("<tags>" + "".join(f"<tag>{escape(t)}</tag>" for t in r["tags"]) + "</tags>")
    parts += [f"<item q=\"{q}\">{escape(lbl)}</item>" for q, lbl in r["items"]]
    return "".join(parts) + "</rec>"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=40))
def test_values_survive_the_round_trip(spark, recs):
    df = spark.createDataFrame([(i, to_xml(i, r)) for i, r in enumerate(recs)], "i long, x string")
    got = {r.id: r for r in extract_xml(df, "x", SPEC).collect()}
    for i, r in enumerate(recs):
        g = got[i]
        assert g.name == r["name"]
        assert g.note == r["note"]
        assert g.amount == Decimal(r["amount"])
        assert g.day == dt.date(1970, 1, 1) + dt.timedelta(days=r["day"])
        assert g.flag is (r["flag"].lower() == "true")
        assert g.tags == (r["tags"] or None)
        assert [(it.q, it.label) for it in g.items] == r["items"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=40), st.sampled_from(["items.q", "items.label"]))
def test_nested_pruning_equals_projection_of_full_extraction(spark, recs, sub):
    df = spark.createDataFrame([(i, to_xml(i, r)) for i, r in enumerate(recs)], "i long, x string")
    field = sub.split(".")[1]
    full = {r.id: [getattr(it, field) for it in r.items] for r in extract_xml(df, "x", SPEC, columns=["id", "items"]).collect()}
    pruned = extract_xml(df, "x", SPEC, columns=["id", sub])
    assert pruned.schema["items"].dataType.elementType.fieldNames() == [field]
    got = {r.id: [getattr(it, field) for it in r.items] for r in pruned.collect()}
    assert got == full


def test_bytes_of_any_length_equal_python_integers(spark):
    import random
    from decimal import Context, Decimal

    from docflow.functions.binary import be_bytes_to_decimal

    rng = random.Random(17)
    values = [0, 1, -1, 127, 128, -128, -129, 2**63 - 1, 2**63, -(2**63), -(2**63) - 1, 2**64, -(2**64), 10**38 - 1, -(10**38) + 1, 10**38, -(10**38), 2**127 - 1, -(2**127)]
    values += [rng.choice([1, -1]) * rng.getrandbits(rng.randint(1, 126)) for _ in range(300)]
    rows = []
    for v in values:
        size = (v.bit_length() + 8) // 8
        for extra in (0, 1, 5, 12):
            rows.append((v.to_bytes(size + extra, "big", signed=True), v))
    rows += [(b"\x00" + b"\xff" * 16, 2**128 - 1), (b"\xff" + b"\x00" * 16, -(2**128)), (b"\x00\x80" + b"\x00" * 15, 2**127), (b"", None), (None, None)]
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(rows)], "i int, b binary").repartition(3)
    got = {r["i"]: r["v"] for r in df.select("i", be_bytes_to_decimal(df.b, 9, 38, "permissive").cast("string").alias("v")).collect()}
    for i, (_, v) in enumerate(rows):
        want = None if v is None or abs(v) >= 10**38 else Decimal(v).scaleb(-9, Context(prec=60))
        assert (got[i] is None) == (want is None), rows[i]
        assert want is None or Decimal(got[i]) == want and len(got[i].split(".")[1]) == 9, rows[i]
