"""WARC records and a Merkle fixity audit of replicas.

Pages become WARC/1.0 resource records. Records belong to archives by their number
(``archive``) and have an order in them (``slot``); their offsets follow from the
lengths of the records before them. Every replica is hashed into a tree: a record's
SHA-256 and length, the records of a slot, ranges of ``FANOUT`` slots, archives, ranges
of ``FANOUT`` archives, and so on to one root. A node's digest is that of its children
in order, with their numbers; it also has the offset range or count that it covers.

The audit compares the roots and goes down only below nodes that differ, one join per
level over the children of mismatching nodes, until the records. A damaged record so
costs one path; equal replicas cost the comparison of two roots.

Defined results: null urls and pages count as empty; records without number are dealt
over archives of their own by their hash; copies of a record (same number, same bytes)
are one record with a count; an empty replica has no root, and every record of the
other is reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.session import materialize

from .carry import map_rows

SLOTS, FANOUT = 1_024, 32
DATE = "2024-01-01T00:00:00Z"
_LOST = -(1 << 40)  # archives of records without number count down from here


def record_text(number: Column, url: Column, body: Column) -> Column:
    """The WARC record of a page, as text (its bytes are the UTF-8 of it)."""
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(number.cast("string"), F.lit("none")),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.coalesce(F.octet_length(body), F.lit(0)).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, F.coalesce(body, F.lit("")), F.lit("\r\n\r\n"))


def parse_records(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """Records of concatenated WARC bytes: the other columns plus ``record_no, offset,
    length, record_id, uri, body, ok`` (``ok`` false: the rest of the file is no record)."""

    def records(raw: bytes) -> Iterator[tuple]:
        at, no = 0, 0
        while at < len(raw):
            split = raw.find(b"\r\n\r\n", at)
            fields = dict(x.split(b": ", 1) for x in raw[at:split].split(b"\r\n")[1:] if b": " in x) if split >= 0 else {}
            size = fields.get(b"Content-Length", b"")
            end = split + 4 + int(size) + 4 if size.isdigit() else -1
            if not raw.startswith(b"WARC/1.", at) or end < 0 or end > len(raw) or raw[end - 4 : end] != b"\r\n\r\n":
                yield no, at, len(raw) - at, None, None, raw[at:], False
                return
            yield no, at, end - at, fields.get(b"WARC-Record-ID", b"").decode(), fields.get(b"WARC-Target-URI", b"").decode(), raw[split + 4 : end - 4], True
            at, no = end, no + 1

    new = [
        ("record_no", T.LongType()), ("offset", T.LongType()), ("length", T.LongType()), ("record_id", T.StringType()),
        ("uri", T.StringType()), ("body", T.BinaryType()), ("ok", T.BooleanType()),
    ]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.bool_()]

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                rows = list(records(b.column("content")[k].as_py() or b""))
                kept = b.column("row").take(pa.array([k] * len(rows), pa.int64()))
                cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([kept, *cols], names=["row", *(n for n, _ in new)])

    return map_rows(archives, run, new, drop=(content_col,), content=F.col(f"`{content_col}`").cast("binary"))


def leaves(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(archive, slot, number, sha256, length, copies, offset)`` of ``records (number, record)``.
    Only hashes and lengths are shuffled; copies meet in a map-side combined count."""
    raw = F.encode("record", "UTF-8")
    hashed = records.select(F.col("number").cast("long").alias("number"), F.sha2(raw, 256).alias("sha256"), F.octet_length("record").cast("long").alias("length"))
    kinds = hashed.groupBy("number", "sha256", "length").agg(F.count(F.lit(1)).alias("copies"))
    lost = F.pmod(F.xxhash64("sha256"), F.lit(slots))
    placed = kinds.select(
        F.when(F.col("number").isNull(), F.lit(_LOST) - F.pmod(F.xxhash64("sha256", F.lit(1)), F.lit(slots))).otherwise(F.floor(F.col("number") / slots)).cast("long").alias("archive"),
        F.coalesce(F.pmod("number", F.lit(slots)), lost).cast("long").alias("slot"),
        "number", "sha256", "length", "copies",
    )
    order = Window.partitionBy("archive").orderBy("slot", "sha256").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum(F.col("length") * F.col("copies")).over(order), F.lit(0)))


def _node(children: DataFrame, keys: list[Column], no: str) -> DataFrame:
    """Nodes over ``children (no, digest, first, last)``: digests in order of number."""
    row = F.struct(F.col(no).alias("no"), "digest")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda c: F.concat_ws(":", c["no"].cast("string"), c["digest"])), "\n")
    return children.groupBy(*keys).agg(F.sha2(joined.cast("binary"), 256).alias("digest"), F.min("first").alias("first"), F.max("last").alias("last"))


def _height(sides: list[DataFrame], fanout: int) -> int:
    """Levels above the archives until their ranges are 0 (numbered records) and -1 (the others), the same for all replicas."""
    ends = [s.agg(F.min("archive").alias("a"), F.max("archive").alias("b")).first() for s in sides]
    a, b = min([-1, *(e["a"] for e in ends if e["a"] is not None)]), max([0, *(e["b"] for e in ends if e["b"] is not None)])
    height = 0
    while a < -1 or b > 0:
        a, b, height = a // fanout, b // fanout, height + 1
    return height


def merkle_tree(leaf: DataFrame, height: int, slots: int = SLOTS, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels from the slots up to the root, each ``(id, parent, digest, first, last)``.
    ``first`` and ``last``: the byte range in the archive (slots and their ranges), else the archives."""
    record = F.sha2(F.concat_ws(":", "sha256", F.col("length").cast("string"), F.col("copies").cast("string")).cast("binary"), 256)
    own = (F.col("archive") * slots + F.col("slot")).alias("id")
    records = leaf.select(own, record.alias("digest"), F.col("offset").alias("first"), (F.col("offset") + F.col("length") * F.col("copies")).alias("last"))
    levels: list[DataFrame] = []

    def add(children: DataFrame, by: str, no: str, share: int) -> DataFrame:
        nodes = _node(children, [F.col(by).alias("id")], no)
        if len(levels) == 2:
            nodes = nodes.withColumns({"first": F.col("id"), "last": F.col("id")})
        parent = F.floor(F.col("id") / share).cast("long")
        levels.append(materialize(nodes.select("id", parent.alias("parent"), "digest", "first", "last"), "merkle"))
        return levels[-1]

    top = add(records, "id", "digest", fanout)  # slots
    top = add(top, "parent", "id", -(-slots // fanout))  # ranges of slots
    top = add(top, "parent", "id", fanout)  # archives
    for _ in range(height):
        top = add(top, "parent", "id", fanout)
    root = _node(top.withColumn("root", F.lit(0).cast("long")), [F.col("root").alias("id")], "id")
    levels[-1] = materialize(top.drop("parent").withColumn("parent", F.lit(0).cast("long")), "merkle")
    levels.append(materialize(root.withColumn("parent", F.lit(0).cast("long")), "merkle"))
    return levels


def audit(left: DataFrame, right: DataFrame, slots: int = SLOTS, fanout: int = FANOUT) -> DataFrame:
    """Damage between two replicas ``(number, record)``: ``(number, kind, archive, offset_a,
    length_a, sha256_a, offset_b, length_b, sha256_b)``; ``kind``: altered, missing (in the
    right one), added, or copies (their count differs)."""
    if slots % fanout:
        raise ValueError("slots must be a multiple of the fan-out")
    sides = [materialize(leaves(r, slots), "leaves") for r in (left, right)]
    height = _height(sides, fanout)
    trees = [merkle_tree(s, height, slots, fanout) for s in sides]
    suspects = None
    for a, b in zip(*map(reversed, trees), strict=True):
        if suspects is not None:  # children of mismatching nodes only
            a, b = (x.join(suspects, x["parent"] == suspects["bad"], "left_semi") for x in (a, b))
        both = a.select("id", F.col("digest").alias("da")).join(b.select("id", F.col("digest").alias("db")), "id", "full_outer")
        suspects = materialize(both.where(~F.col("da").eqNullSafe(F.col("db"))).select(F.col("id").alias("bad")), "suspects")
    own = F.col("archive") * slots + F.col("slot")
    at = [s.withColumn("id", own) for s in sides]
    a, b = (x.join(suspects, x["id"] == suspects["bad"], "left_semi") for x in at)
    # within a mismatching slot: equal records first, then what is left side by side in order of hash
    key = ["id", "number", "sha256", "length", "copies"]
    a, b = (x.join(y.select(*[F.col(c).alias(f"o_{c}") for c in key]), F.expr(" AND ".join(f"{c} <=> o_{c}" for c in key)), "left_anti") for x, y in ((a, b), (b, a)))
    rank = Window.partitionBy("id", "number").orderBy("sha256", "copies")
    a, b = (
        x.select("id", "number", "archive", F.row_number().over(rank).alias("rn"), *[F.col(c).alias(f"{c}_{s}") for c in ("offset", "length", "sha256", "copies")])
        for x, s in ((a, "a"), (b, "b"))
    )
    b = b.select(*[F.col(c).alias(f"b_{c}") if c in ("id", "number", "archive", "rn") else F.col(c) for c in b.columns])
    pair = a.join(b, F.expr("id = b_id AND number <=> b_number AND rn = b_rn"), "full_outer")
    kind = (
        F.when(F.col("sha256_b").isNull(), F.lit("missing")).when(F.col("sha256_a").isNull(), F.lit("added"))
        .when(F.col("sha256_a") == F.col("sha256_b"), F.lit("copies")).otherwise(F.lit("altered"))
    )
    return pair.select(
        F.coalesce("number", "b_number").alias("number"), kind.alias("kind"), F.coalesce("archive", "b_archive").alias("archive"),
        "offset_a", "length_a", "sha256_a", "offset_b", "length_b", "sha256_b",
    )
