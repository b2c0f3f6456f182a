"""Vector code compression: product codes learnt and assigned over Hilbert-sorted blocks.

Vectors become integers (``floor(256 * x)``) and are cut into equal parts. Every shard (a
run of bounded length of one scan partition) sorts each part position's points along a
Hilbert curve and cuts them into flat blocks that store the smallest and largest
coordinates of their points (the box) and the points' sums. Shards are written once, one
row each. A round reads them: the distances from an entry to the nearest and to the
farthest corner of a box bound its distance to all points of the block, so a block keeps
a shortlist of the entries that may be nearest to any of its points. A shortlist of one
settles the whole block by its stored sums; otherwise an integer kernel compares the
block's points with the entries of its shortlist. Tasks return sums and counts per entry,
numbers whose amount depends on the codebooks alone. No vector crosses the network, so
no copies, however many, meet in one task; a lost executor repeats its shards of a round.

Defined results: rows whose vector is null, or holds a null or non-finite component, are
dropped, as are those whose length is no positive multiple of ``parts`` or differs from
that of the row of smallest id. Components beyond 2^27 after scaling are held there. Rows
without id are coded too and rank last among the first entries; of equal ids the smaller
vector comes first; repeated rows count each. With fewer rows than entries the codebooks
are smaller. Labels that are null count as one. An empty table gives an empty result.
Other columns take no part, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import bounded_broadcast, materialize

from .vectors import HELD, id_and_vector, matrix, one_list, scaled

SHARD_ROWS, BLOCK = 32_768, 16
_NONE = np.iinfo(np.int64).max


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """The order of integer points along a Hilbert curve through their bounding box (at
    most 63 bits in all: coarser cells where the box is larger)."""
    if len(points) < 2:
        return np.arange(len(points))
    x = (points[:, :63] - points[:, :63].min(axis=0)).astype(np.uint64)
    n, width = x.shape
    bits = max(1, int(x.max()).bit_length())
    used = max(1, min(bits, 63 // width))
    x = np.ascontiguousarray((x >> np.uint64(bits - used)).T)
    for b in range(used - 1, 0, -1):  # undo the rotations of each level, from the top
        q = np.uint64(1 << b)
        low = q - np.uint64(1)
        for i in range(width):
            swap = np.where(x[i] & q, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] & q, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, width):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, np.uint64)
    for b in range(used - 1, 0, -1):
        flip ^= np.where(x[width - 1] & np.uint64(1 << b), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= flip
    key = np.zeros(n, np.uint64)
    for b in range(used - 1, -1, -1):
        for i in range(width):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return np.argsort(key, kind="stable")


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Per block (row) and entry: may the entry be nearest to a point of the box?"""
    below, above = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
    least = np.maximum(np.maximum(below, above), 0)
    most = np.maximum(np.abs(below), np.abs(above))
    least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
    return least <= most.min(axis=1)[:, None]


def assign(points: np.ndarray, allowed: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the first of equals) and squared distance of all points of blocks,
    ``points (block, row, component)``, each against its block's shortlist only."""
    best = np.full(points.shape[:2], _NONE, np.int64)
    code = np.zeros(points.shape[:2], np.int64)
    for e in range(len(entries)):
        mine = np.flatnonzero(allowed[:, e])
        if not len(mine):
            continue
        away = points[mine] - entries[e]
        away = (away * away).sum(axis=2)
        nearer = away < best[mine]
        best[mine] = np.where(nearer, away, best[mine])
        code[mine] = np.where(nearer, e, code[mine])
    return code, best


def _pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, "<i4").tobytes()


def _shards(parts: int, dims: int, scale: int, shard_rows: int, block: int, label_type: pa.DataType):
    width = dims // parts

    def stored(ids: list, labels: list, rows: list) -> pa.RecordBatch:
        vectors = np.concatenate(rows)
        orders, points, lows, highs, sums = [], [], [], [], []
        for p in range(parts):
            mine = vectors[:, p * width : (p + 1) * width]
            order = hilbert_order(mine)
            mine, cuts = mine[order], np.arange(0, len(order), block)
            orders.append(order)
            points.append(mine)
            lows.append(np.minimum.reduceat(mine, cuts))
            highs.append(np.maximum.reduceat(mine, cuts))
            sums.append(np.add.reduceat(mine, cuts))
        columns = [
            one_list(pa.concat_arrays(ids)),
            one_list(pa.concat_arrays(labels).cast(label_type)),
            *[pa.array([_pack(np.stack(x))], pa.binary()) for x in (orders, points, lows, highs)],
            pa.array([np.stack(sums).astype("<i8").tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "orders", "points", "low", "high", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = ([], [], []), 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, shard_rows - n)
                for column, value in zip(held, (piece.column("vec_id"), piece.column("label"), matrix(piece.column("vector"), dims, scale)), strict=True):
                    column.append(value)
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == shard_rows:
                    yield stored(*held)
                    held, n = ([], [], []), 0
        if n:
            yield stored(*held)

    return run


class _Shard:
    """One stored shard: per part position its blocks."""

    def __init__(self, batch: pa.RecordBatch, i: int, parts: int, width: int, block: int):
        def ints(name: str, kind: str = "<i4") -> np.ndarray:
            return np.frombuffer(batch.column(name)[i].as_buffer(), kind).astype(np.int64)

        self.orders = ints("orders").reshape(parts, -1)
        self.n = self.orders.shape[1]
        self.points = ints("points").reshape(parts, self.n, width)
        self.low, self.high = (ints(name).reshape(parts, -1, width) for name in ("low", "high"))
        self.sums = ints("sums", "<i8").reshape(parts, -1, width)
        self.sizes = np.diff(np.append(np.arange(0, self.n, block), self.n))
        self.block = block

    def blocks(self, p: int, which: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Points of part ``p`` as ``(block, row, component)``; the last block is filled
        up with its last point."""
        mine = self.points[p]
        fill = -self.n % self.block
        if fill:
            mine = np.concatenate([mine, np.repeat(mine[-1:], fill, axis=0)])
        return mine.reshape(-1, self.block, mine.shape[1])[which]


def _entry_sums(codebooks: np.ndarray, block: int):
    parts, m, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, m, width + 1), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = _Shard(batch, i, parts, width, block)
                for p in range(parts):
                    allowed = shortlists(shard.low[p], shard.high[p], codebooks[p])
                    one = allowed.sum(axis=1) == 1
                    sure = allowed[one].argmax(axis=1)
                    np.add.at(total[p, :, 0], sure, shard.sizes[one])
                    np.add.at(total[p, :, 1:], sure, shard.sums[p][one])
                    rest = np.flatnonzero(~one)
                    if not len(rest):
                        continue
                    points = shard.blocks(p, rest)
                    code, _ = assign(points, allowed[rest], codebooks[p])
                    real = np.arange(block)[None, :] < shard.sizes[rest][:, None]
                    np.add.at(total[p, :, 0], code[real], 1)
                    np.add.at(total[p, :, 1:], code[real], points[real])
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total.ravel()[at], pa.int64())], ["at", "value"])

    return run


def _codes(codebooks: np.ndarray, block: int, label_type: pa.DataType):
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = _Shard(batch, i, parts, width, block)
                codes = np.zeros((shard.n, parts), np.uint8)
                error = np.zeros(shard.n, np.int64)
                for p in range(parts):
                    allowed = shortlists(shard.low[p], shard.high[p], codebooks[p])
                    code, away = assign(shard.blocks(p), allowed, codebooks[p])
                    codes[shard.orders[p], p] = code.ravel()[: shard.n]
                    error[shard.orders[p]] += away.ravel()[: shard.n]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        batch.column("labels")[i].values.cast(label_type),
                        pa.array([c.tobytes().hex() for c in codes], pa.string()),
                        pa.array(error, pa.int64()),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return run


def vector_codes(
    rows: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label", shard_rows: int = SHARD_ROWS, block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every kept vector:
    two hex digits per part (``entries`` of 256 at most), the squared distance to the
    coded vector, its sum over the label, and the hash of all codebooks."""
    spark = rows.sparkSession
    label_type = pa.string()  # any label's text; only equality counts
    kept = id_and_vector(rows, id_col, vector_col, F.col(f"`{label_col}`").cast("string").alias("label"))
    kept = kept.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    low = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).collect()
    if not low:
        number = F.lit(0).cast("long")
        return kept.select("vec_id", F.lit("").alias("code"), number.alias("error"), number.alias("label_error"), F.lit("").alias("codebooks_sha256"))
    dims = len(low[0]["vector"])
    kept = kept.where(F.size("vector") == dims)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    seeds = scaled(np.array([r["vector"] for r in first], np.float64), scale)
    width, m = dims // parts, len(seeds)
    codebooks = np.ascontiguousarray(seeds.reshape(m, parts, width).transpose(1, 0, 2))
    shards = materialize(
        kept.mapInArrow(
            _shards(parts, dims, scale, shard_rows, block, label_type),
            "ids array<long>, labels array<string>, orders binary, points binary, low binary, high binary, sums binary",
        ),
        "hilbert-shards",
    )
    for _ in range(rounds):
        found = shards.drop("ids", "labels").mapInArrow(_entry_sums(codebooks, block), "at long, value long")
        total = np.zeros(codebooks.size + parts * m, np.int64)
        for row in found.groupBy("at").agg(F.sum("value").alias("value")).collect():
            total[row["at"]] = row["value"]
        total = total.reshape(parts, m, width + 1)
        used = total[:, :, 0] > 0
        codebooks = np.where(used[:, :, None], total[:, :, 1:] // np.maximum(total[:, :, :1], 1), codebooks)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    coded = materialize(shards.mapInArrow(_codes(codebooks, block, label_type), "vec_id long, label string, code string, error long"), "vector-codes")
    by_label = bounded_broadcast(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), 1_000_000)
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


assert HELD < 1 << 31  # stored as 32-bit integers
