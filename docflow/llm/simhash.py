"""SimHash near-duplicates through pivot distance tables.

A text's fingerprint has 64 bits: bit i is 1 where more than half of its word
shingles' XXH64 values have it. Equal fingerprints form a class; classes within
``max_bits`` differing bits are linked, and components of links get the smallest
document id in them.

* Every class's Hamming distances to ``PIVOTS`` reference fingerprints are computed
  once and stored. By the triangle inequality a pair within ``max_bits`` differs by
  at most that in every coordinate, so a pair whose largest coordinate difference
  exceeds it is discarded; survivors are verified bit by bit.
* A pivot keeps about 57 % of random pairs, so the table alone would still read
  every pair of classes. The pairs that it is applied to therefore come from an
  exact cover: the bits are cut into blocks, and a pair within ``max_bits`` bits
  agrees on all but at most ``max_bits`` blocks, so it meets in a bucket of the
  blocks it agrees on. The number of blocks grows with the number of classes (every
  choice finds the same links; more blocks give more, smaller buckets).
* Buckets hold classes, so copies meet once. A bucket of many classes is cut into
  tiles, and pairs of tiles are compared in different tasks. A bucket gives a
  spanning forest of its links, never all its pairs.

Defined results: a null or blank text has fingerprint zero and is linked like any
other; a text with fewer words than a shingle is one shingle; repeated rows keep one
row each; a component whose documents all lack an id has a null component id.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import materialize

from .components import connected_components
from .wordhash import NON_SPACE, doc_blocks, text_buffer

PIVOTS = 16
#: Classes of a bucket that one tile holds; a task compares two tiles at a time.
TILE = 4_096
_STEP = 100_000


def _pivots(count: int) -> list[int]:
    """Reference fingerprints: random ones, fixed by the seed."""
    return [int(x) for x in np.random.Generator(np.random.PCG64(64)).integers(-(1 << 63), 1 << 63, count, dtype=np.int64)]


#: Per byte place (most significant first) and value, its eight bits.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_PLACE = (np.arange(8) * 256)[None, :]


def _fingerprint(text: bytes, starts: np.ndarray, ends: np.ndarray, words: int) -> int:
    """``text``: words joined by one space, word i from starts[i] to ends[i]."""
    n = len(starts)
    if n == 0:
        return 0
    if n <= words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: n - words + 1], ends[words - 1 :]
    total = len(starts)
    counts = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, _STEP):
        h = np.array(
            [digest(text[a:b], 42) for a, b in zip(starts[at : at + _STEP].tolist(), ends[at : at + _STEP].tolist(), strict=True)],
            dtype=">u8",
        )
        by_value = np.bincount((h.view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
        counts += by_value @ _BITS
    return int.from_bytes(np.packbits(counts.ravel() * 2 > total).tobytes(), "big", signed=True)


def _fingerprints(words: int, carried: tuple[str, ...]):
    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column("text"))
            out = np.zeros(b.num_rows, np.int64)
            for first, last in doc_blocks(off):
                base = int(off[first])
                block = NON_SPACE[data[base : int(off[last])]]
                # keep words and one space before each word that is not a text's first
                solid = block != 0
                before = np.zeros(len(block), bool)
                before[1:] = solid[:-1]
                cuts = off[first:last] - base
                before[cuts[cuts < len(block)]] = False
                begin = solid & ~before
                sizes = np.diff(np.append(np.flatnonzero(begin[solid]), int(solid.sum())))
                where = np.flatnonzero(begin)  # first byte of each word
                doc = np.searchsorted(off[first : last + 1] - base, where, side="right") - 1
                joined = np.full(int(solid.sum()) + len(where), 32, np.uint8)
                letters = np.arange(int(solid.sum())) + np.repeat(np.arange(len(where)), sizes)
                joined[letters] = block[solid]
                joined[joined == 255] = 0  # NUL, see NON_SPACE
                text = joined.tobytes()
                starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
                ends = starts + sizes
                per_doc = np.searchsorted(doc, np.arange(last - first + 1))
                for i in range(last - first):
                    lo, hi = per_doc[i], per_doc[i + 1]
                    if hi > lo:
                        out[first + i] = _fingerprint(text, starts[lo:hi], ends[lo:hi], words)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in carried], pa.array(out)], names=[*carried, "fp"])

    return run


def fingerprints(documents: DataFrame, shingle_words: int = 4) -> DataFrame:
    """``(doc_id, fp)`` of ``documents (doc_id, text)``; ``fp`` is a 64-bit long."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle_words, ("doc_id",)), "doc_id long, fp long")


def _block_count(classes: int, max_bits: int) -> int:
    """The fewest blocks at which a bucket of random fingerprints holds about two classes at most."""
    blocks = max_bits + 2
    while blocks < 2 * max_bits and classes > 2 * 2 ** (64 * (blocks - max_bits) // blocks):
        blocks += 1
    return blocks


def _buckets(blocks: int, max_bits: int):
    """For each choice of ``blocks - max_bits`` blocks, a column with the choice's number and those bits."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        mask = sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(number).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return keys


def _forest(group: np.ndarray, fp: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Rows (sorted by group) joined by verified links: a spanning forest of each group."""
    parent = np.arange(len(fp))
    left, right = [], []

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    step, i = 1, np.arange(len(fp))
    while True:  # pairs of rows `step` apart within a group
        i = i[: np.searchsorted(i, len(fp) - step)]
        i = i[group[i] == group[i + step]]
        if not len(i):
            return left, right
        a = i[parent[i] != parent[i + step]]
        for pivot in range(table.shape[1]):  # discard by the coordinates, one after another
            if not len(a):
                break
            a = a[np.abs(table[a, pivot] - table[a + step, pivot]) <= max_bits]
        a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= max_bits]
        for x in a.tolist():
            p, q = root(x), root(x + step)
            if p != q:
                parent[max(p, q)] = min(p, q)
                left.append(x)
                right.append(x + step)
        if len(a):
            while not np.array_equal(up := parent[parent], parent):
                parent = up
        step += 1


def _link(max_bits: int):
    def solve(part: pa.Table):
        group = part.column("group").to_numpy()
        fp = part.column("fp").to_numpy()
        flat = part.column("pivots").combine_chunks()
        table = flat.flatten().to_numpy().reshape(len(fp), -1).astype(np.int16)
        left, right = _forest(group, fp.view(np.uint64), table, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(fp[left]), pa.array(fp[right])], names=["u", "v"])

    def run(batches):
        rest = None  # rows of the last group, which the next batch may continue
        for b in batches:
            part = pa.Table.from_batches([b])
            part = pa.concat_tables([rest, part]) if rest is not None else part
            group = part.column("group").to_numpy()
            cut = int(np.searchsorted(-(group != group[-1]).astype(np.int8), 0)) if len(group) else 0
            if cut:
                yield solve(part.slice(0, cut))
            rest = part.slice(cut)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return run


def fingerprint_links(classes: DataFrame, max_bits: int = 4, pivots: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints ``classes (fp)``: within each
    bucket a spanning forest of the pairs with at most ``max_bits`` differing bits,
    so their components are those of all such pairs."""
    table = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte") for p in _pivots(pivots)])
    precomputed = materialize(classes.select("fp", table.alias("pivots")), "pivot-table")
    keys = F.explode(F.array(*_buckets(_block_count(precomputed.count(), max_bits), max_bits))).alias("key")
    met = (
        precomputed.select(keys)
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("classes"))
        .where("classes > 1")
        .select("key", F.ceil(F.col("classes") / tile).cast("int").alias("tiles"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(own, t).alias("i"), F.greatest(own, t).alias("j"))
    )
    tiled = precomputed.select("fp", "pivots", keys).join(met, "key").select("fp", "pivots", "key", F.explode(others).alias("pair"))
    grouped = tiled.select(F.xxhash64("key", "pair").alias("group"), "fp", "pivots")
    return grouped.repartition("group").sortWithinPartitions("group").mapInArrow(_link(max_bits), "u long, v long")


def _linked(classes: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, least, label)`` of ``classes (fp, least)``; ``label`` names the component."""
    labels = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    return classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )


def near_duplicates(documents: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``documents (doc_id, text)``.

    Fingerprints are computed once and written; from there on only 64-bit values
    travel. Copies collapse to one class in an aggregation with map-side
    combining, before any bucket is formed."""
    prints = materialize(fingerprints(documents, shingle_words), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    linked = _linked(classes, max_bits)
    component = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = linked.join(component, "label").select("fp", "component_id")
    return prints.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_rows(documents: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(key)`` of one row of every component of ``documents (doc_id, text, key)``: the
    row of smallest id, rows without id last, then of smallest ``key`` (a string)."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "key")
    prints = materialize(rows.mapInArrow(_fingerprints(shingle_words, ("doc_id", "key")), "doc_id long, key string, fp long"), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    classes = materialize(prints.groupBy("fp").agg(F.min(row).alias("least")), "classes")
    return _linked(classes, max_bits).groupBy("label").agg(F.min("least").alias("least")).select("least.key")
