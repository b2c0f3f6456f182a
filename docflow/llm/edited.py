"""Fingerprints of documents beside those of edited copies.

Every text is compared with its edited copy (its last third replaced by the start of
the next document's text, in descending order of ids; after the last comes the first)
and with that next text. The order is made by ranges of (id, text hash), so rows without
id, or of one id, spread like others. One pass over those two numbers lets Spark cut them
evenly; where the ranges begin (two numbers a partition) goes to the tasks as a table that
they search. The first row of each range is also sent to the range before, so every task
holds the successor of each of its rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bottomk as B
from .wordhash import doc_blocks, text_buffer


def _keys(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """16 bytes per row that sort as the documents do: larger ids first, then by text hash."""
    high = ~(ids.view(np.uint64) ^ np.uint64(1 << 63))
    low = hashes.view(np.uint64) ^ np.uint64(1 << 63)
    return np.frombuffer(np.stack([high, low], axis=1).astype(">u8").tobytes(), "S16")


def _column_keys(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    return _keys(ids.to_numpy(zero_copy_only=False).astype(np.int64), hashes.to_numpy(zero_copy_only=False).astype(np.int64))


def _least(batches):
    """The smallest key of a partition."""
    least = None
    for b in batches:
        if b.num_rows:
            ids, hashes = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "th"))
            k = int(_keys(ids, hashes).argmin())
            here = (ids[k : k + 1], hashes[k : k + 1])
            if least is None or _keys(*here)[0] < _keys(*least)[0]:
                least = here
    if least is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in least], names=["id", "th"])


def _with_successors(documents: DataFrame, n: int) -> DataFrame:
    """Rows ``(range, extra, doc_id, text)`` in partitions by range, sorted; an ``extra``
    row closes its range with a copy of the row that follows the range's last."""
    spark, last = documents.sparkSession, -(1 << 63)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("th", F.xxhash64("text"))
    # Spark's range partitioner cuts the keys evenly; the first key of each part is where a range begins
    dealt = rows.select("id", "th").repartitionByRange(n, F.col("id").desc(), "th")
    starts = dealt.mapInArrow(_least, "id long, th long").collect()  # a row per partition at most
    bounds = np.sort(_keys(np.array([r["id"] for r in starts], np.int64), np.array([r["th"] for r in starts], np.int64)))
    held, ranges = spark.sparkContext.broadcast(bounds.tobytes()), max(1, len(bounds))

    def place(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        keys, begins = _column_keys(ids, hashes), np.frombuffer(held.value, "S16")
        of = np.maximum(np.searchsorted(begins, keys, side="right") - 1, 0)
        return pa.StructArray.from_arrays([pa.array(of, pa.int32()), pa.array(begins[of] == keys)], names=["range", "first"])

    placed = rows.withColumn("place", F.arrow_udf(place, "range int, first boolean")("id", "th"))
    at = F.col("place.range")
    own = F.struct(at.alias("range"), F.lit(0).alias("extra"))
    ahead = F.struct(F.when(at == 0, F.lit(ranges - 1)).otherwise(at - 1).alias("range"), F.lit(1).alias("extra"))
    to = F.explode(F.when(F.col("place.first"), F.array(own, ahead)).otherwise(F.array(own))).alias("to")
    sent = placed.select("doc_id", "id", "th", "text", to).select("to.range", "to.extra", "doc_id", "id", "th", "text")
    return (
        sent.repartitionById(ranges, F.col("range"))
        .sortWithinPartitions("range", "extra", F.col("id").desc(), "th", "text")
        .select("range", "extra", "doc_id", "text")
    )


def _edited(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compare(size: int, k: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles", "containment_edited"]

    def emit(pairs):
        """pairs: (id, text, sketch, next text, next sketch)"""
        texts = [_edited(t, nt) for _, t, _, nt, _ in pairs]
        raw = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        other = B.sketch_texts(np.frombuffer(b"".join(raw), np.uint8), off, size, k)
        cols = [
            [p[0] for p in pairs],
            [len(p[1]) for p in pairs],
            [hashlib.sha256(r).hexdigest() for r in raw],
            [B.encode(p[2]) for p in pairs],
            [B.encode(e) for e in other],
            [B.resemblance(p[2], e, k) for p, e in zip(pairs, other, strict=True)],
            [B.resemblance(p[2], p[4], k) for p in pairs],
            [B.distinct(p[2], k) for p in pairs],
            [B.containment(p[2], e, k) for p, e in zip(pairs, other, strict=True)],
        ]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    def run(batches):
        held = None  # the last row read: (range, id, text, sketch), waiting for its successor
        for b in batches:
            data, off = text_buffer(b.column("text"))
            ranges, extras, ids = (b.column(c).to_pylist() for c in ("range", "extra", "doc_id"))
            for first, last in doc_blocks(off):
                sketches = B.sketch_texts(data, off[first : last + 1], size, k)
                pairs = []
                for i in range(first, last):
                    text, sketch = data[off[i] : off[i + 1]].tobytes().decode(), sketches[i - first]
                    if held is not None and held[0] == ranges[i]:
                        pairs.append((held[1], held[2], held[3], text, sketch))
                    # of several copies of the row that follows, the first counts
                    held = None if extras[i] else (ranges[i], ids[i], text, sketch)
                if pairs:
                    yield emit(pairs)

    return run


def edited_fingerprints(documents: DataFrame, size: int = B.SHINGLE, k: int = B.K, partitions: int | None = None) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_shingles, containment_edited)``, one row per row of ``documents
    (doc_id, text)``.

    Rows of one id follow each other by their texts' hashes; rows without id come last. A
    single document is its own successor. The edited copy of an empty text is empty."""
    n = partitions or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _with_successors(documents, n).mapInArrow(
        _compare(size, k),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_shingles double, containment_edited double",
    )
