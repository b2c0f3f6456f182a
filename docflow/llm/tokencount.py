"""Token counts of whole texts by a compiled byte-level BPE tokenizer (see :mod:`.transducer`).

Texts are cut into chunks in the scan; every chunk is counted on its own and only its
state map travels on: a number and two short strings. Texts of one chunk are done
then; the maps of a longer text are composed, in a balanced fold, by the task that
holds its key.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give
repeated results; special strings inside texts are one token each.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import materialize

from .transducer import ChunkMap, Tokenizer
from .wordhash import doc_blocks, text_buffer

CHUNK_CHARS = 1 << 16
_COMPILED: dict[str, Tokenizer] = {}


def compiled(spec: str) -> Tokenizer:
    """The tokenizer of this process for a vocabulary file's text."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Tokenizer(spec)
    return _COMPILED[key]


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 1024, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``documents
    (doc_id, text)``; ``vocabulary`` is the path of a ``tokenizer.json``."""
    spark = documents.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def maps(batches):
        tok = compiled(spec.value)
        for b in batches:
            data, off = text_buffer(b.column("chunk"))
            head, count, tail, left = [None] * b.num_rows, [0] * b.num_rows, [None] * b.num_rows, [-1] * b.num_rows
            single = b.column("n_chunks").to_numpy() == 1
            for first, last in doc_blocks(off):
                if single[first:last].all():
                    count[first:last] = tok.count_texts(data, off[first : last + 1]).tolist()
                    continue
                for i in range(first, last):
                    text = data[off[i] : off[i + 1]].tobytes().decode()
                    if single[i]:
                        count[i] = tok.count_text(text)
                    else:
                        head[i], count[i], tail[i], left[i] = tok.chunk_map(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "key", "no", "n_chunks", "n_bytes")] + [pa.array(head, pa.string()), pa.array(count, pa.int64()), pa.array(tail, pa.string()), pa.array(left, pa.int32())],
                names=["doc_id", "key", "no", "n_chunks", "n_bytes", "head", "count", "tail", "left"],
            )

    def fold(batches):
        tok = compiled(spec.value)
        for b in batches:
            rows = b.to_pylist()
            totals = [tok.total([ChunkMap(m["head"], m["count"], m["tail"], m["left"]) for m in r["maps"]]) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("copies"), b.column("n_bytes"), pa.array(totals, pa.int64())], names=["doc_id", "copies", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id"), text.alias("text"))
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    long = F.length("text") > chunk_chars
    chunks = F.when(long, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))).otherwise(F.array("text"))
    cut = docs.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        # tells texts of one id apart where chunks of a text must meet again
        F.when(long, F.sha2(F.col("text").cast("binary"), 256)).alias("key"),
        chunks.alias("chunks"),
    ).select("doc_id", "n_bytes", "key", F.size("chunks").alias("n_chunks"), F.posexplode("chunks").alias("no", "chunk"))
    done = materialize(
        cut.mapInArrow(maps, f"doc_id {doc_type}, key string, no int, n_chunks int, n_bytes long, head string, count long, tail string, left int"),
        "chunk-maps",
    )
    short = done.where("n_chunks = 1").select("doc_id", "n_bytes", F.col("count").alias("n_tokens"))
    meet = done.where("n_chunks > 1").groupBy("doc_id", "key", "n_bytes").agg(
        F.count_if(F.col("no") == 0).cast("int").alias("copies"),
        F.array_sort(F.collect_set(F.struct("no", "head", "count", "tail", "left"))).alias("maps"),
    )
    folded = meet.mapInArrow(fold, f"doc_id {doc_type}, copies int, n_bytes long, n_tokens long")
    folded = folded.select(F.explode(F.sequence(F.lit(1), "copies")), "doc_id", "n_bytes", "n_tokens").drop("col")
    return short.unionByName(folded).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
