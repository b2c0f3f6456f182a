"""Document fingerprints: bottom-k sketches of word-shingle hashes.

The ``k`` smallest distinct hashes of a text's shingles (five words; a shorter text is
one shingle) stand for its shingle set. Sketches of parts merge into the sketch of the
whole: union, then the ``k`` smallest. From two sketches follow resemblance (share of
the union's ``k`` smallest that both hold), containment and the number of distinct
shingles (from the k-th smallest hash; exact below ``k``).

As text, a sketch is each hash's upper 48 bits in URL-safe base64 (eight letters a
hash, ascending); equal texts have equal sketches.

Defined results: a null text counts as empty; an empty text has the empty sketch;
two empty sketches are alike (1), an empty and another one are not (0).
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .carry import map_rows
from .wordhash import NON_SPACE, doc_blocks, mix, text_buffer, word_hashes

K, SHINGLE = 128, 5
_WEIGHT = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_KEEP = np.uint64(16)  # hashes have 48 bits
RANGE = float(1 << 48)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """48-bit hashes of the shingles of one text's word hashes; fewer words than ``size`` are one shingle."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        return mix((words * _WEIGHT[:n]).sum(keepdims=True) + np.uint64(n)) >> _KEEP
    acc = words[: n - size + 1] * _WEIGHT[0]
    for j in range(1, size):
        acc = acc + words[j : n - size + 1 + j] * _WEIGHT[j]
    return mix(acc + np.uint64(size)) >> _KEEP


def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct hashes, ascending."""
    size = 4 * k
    while len(hashes) > size:  # the small ones suffice unless many repeat
        low = np.unique(np.partition(hashes, size)[:size])
        if len(low) >= k:
            return low[:k]
        size *= 4
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts together. Shingles across their border belong to one of the parts."""
    return np.union1d(a, b)[:k]


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimate of the number of distinct shingles."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * RANGE / float(sketch[-1])


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of the Jaccard similarity of two shingle sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of the share of a's shingles that b holds too."""
    if not len(a):
        return 1.0
    j, own, union = resemblance(a, b, k), distinct(a, k), distinct(merge(a, b, k), k)
    return min(1.0, j * union / own)


def encode(sketch: np.ndarray) -> str:
    if not len(sketch):
        return ""
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.urlsafe_b64encode(raw.tobytes()).decode()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.urlsafe_b64decode(text), np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (2, 0))).copy().view(">u8").ravel().astype(np.uint64)


def sketch_texts(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE, k: int = K) -> list[np.ndarray]:
    """One sketch per text."""
    words, doc = word_hashes(data, offsets, NON_SPACE)
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    return [smallest(shingle_hashes(words[cuts[i] : cuts[i + 1]], size), k) for i in range(len(offsets) - 1)]


def fingerprints(documents: DataFrame, text_col: str = "text", size: int = SHINGLE, k: int = K) -> DataFrame:
    """``documents`` plus ``fingerprint`` (text form of the sketch) and ``n_shingles`` (estimate). One narrow pass."""

    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column("text"))
            prints, sizes = [], []
            for first, last in doc_blocks(off):
                for s in sketch_texts(data, off[first : last + 1], size, k):
                    prints.append(encode(s))
                    sizes.append(distinct(s, k))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(prints, pa.string()), pa.array(sizes, pa.float64())], names=["row", "fingerprint", "n_shingles"])

    new = [("fingerprint", T.StringType()), ("n_shingles", T.DoubleType())]
    return map_rows(documents, run, new, text=F.col(f"`{text_col}`").cast("string"))


def merge_fingerprints(parts: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """``keys`` and the ``fingerprint`` of all their parts together: distinct hashes
    ranked natively, so parts of a hot key are combined before they meet."""
    width = 8
    pieces = F.when(F.length("fingerprint") > 0, F.regexp_extract_all("fingerprint", F.lit(f".{{{width}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    # base64 letters don't sort as the hashes do: their bytes' hex form does
    hexed = F.transform(pieces, lambda p: F.hex(F.unbase64(F.translate(p, "-_", "+/"))))
    lists = parts.select(*keys, F.spark_partition_id().alias("part"), hexed.alias("hashes"))
    def least(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hashes")))), 1, k).alias("hashes"))

    whole = least(least(lists, [*keys, "part"]), keys)
    letters = F.transform("hashes", lambda h: F.translate(F.base64(F.unhex(h)), "+/", "-_"))
    return whole.select(*keys, F.array_join(letters, "").alias("fingerprint"))
