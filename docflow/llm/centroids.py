"""Centroid clustering with an incremental distance matrix.

Vectors become integers (``floor(scale * x)``). They are stored once as chunks of a
bounded number of rows, each with the exact integer dot products of its vectors with
all centroids. A round changes a centroid in some components; the pass of that round
reads a chunk, adds ``change * component`` to its dot products for the components that
changed and no others, takes the nearest centroid anew
(``|x|^2 - 2 x.c + |c|^2``, smaller number among equals) and writes the chunk with the
sums of its clusters. The next centroids need only those sums: one narrow column of
the written table, a few numbers per chunk. No vector crosses the network, and a lost
executor repeats its chunks of one round. When no centroid moves, later rounds change
nothing and are left out.

Defined results: rows whose vector is null, has another length than ``dims`` or holds a
null or non-finite component take no part. Components beyond 2^27 after scaling are
held there. Rows without id rank last among the first centroids and are clustered like
others; of equal ids the smaller vector comes first; repeated rows count each. With
fewer than ``k`` rows there are fewer centroids. An empty table gives an empty result.
Other columns take no part, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import drop_folder, shared_dir

from .vectors import id_and_vector, matrix, one_list, scaled

CHUNK_ROWS = 4_096
_EXACT = float(1 << 53)
_STATE = "ids array<long>, vectors binary, norms binary, dots binary, sums array<long>"
_LAST = "ids array<long>, cluster array<int>, distance array<long>, sums array<long>"


def product(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """``rows @ columns`` of integers, exactly; by floating point where that is exact."""
    size = float(np.abs(rows).max(initial=0)) * float(np.abs(columns).max(initial=0)) * max(1, rows.shape[1])
    if size < _EXACT:
        return (rows.astype(np.float64) @ columns.astype(np.float64)).astype(np.int64)
    return rows @ columns


def nearest(dots: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row, and the squared distance."""
    rest = (centroids * centroids).sum(axis=1)[None, :] - 2 * dots
    best = rest.argmin(axis=1)  # the first of equals
    return best, norms + rest[np.arange(len(best)), best]


def update(dots: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> None:
    """Adds to ``dots`` what ``change`` (of every centroid) adds, from its nonzero components."""
    for c in range(len(change)):
        moved = np.flatnonzero(change[c])
        if len(moved):
            dots[:, c] += product(vectors[:, moved], change[c, moved][:, None])[:, 0]


def cluster_sums(vectors: np.ndarray, best: np.ndarray, k: int) -> np.ndarray:
    """Per centroid its rows' count and componentwise sums, as one flat list."""
    held = np.zeros((k, vectors.shape[1] + 1), np.int64)
    for c in range(k):
        mine = vectors[best == c]
        held[c, 0], held[c, 1:] = len(mine), mine.sum(axis=0)
    return held.ravel()


def moved_centroids(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Every non-empty centroid replaced by its rows' floor(sum / count)."""
    held = sums.reshape(len(centroids), -1)
    out = centroids.copy()
    full = held[:, 0] > 0
    out[full] = held[full, 1:] // held[full, :1]
    return out


def _begin(centroids: np.ndarray, scale: int, chunk_rows: int):
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(at, chunk_rows)
                vectors = matrix(part.column("vector"), dims, scale)
                norms = (vectors * vectors).sum(axis=1)
                dots = product(vectors, centroids.T)
                yield _chunk(part.column("vec_id"), vectors, norms, dots, nearest(dots, norms, centroids)[0], k)

    return run


def _chunk(ids: pa.Array, vectors: np.ndarray, norms: np.ndarray, dots: np.ndarray, best: np.ndarray, k: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            one_list(ids),
            pa.array([vectors.astype("<i4").tobytes()], pa.binary()),
            pa.array([norms.astype("<i8").tobytes()], pa.binary()),
            pa.array([np.ascontiguousarray(dots, "<i8").tobytes()], pa.binary()),
            pa.array([cluster_sums(vectors, best, k)], pa.list_(pa.int64())),
        ],
        ["ids", "vectors", "norms", "dots", "sums"],
    )


def _next(before: np.ndarray, after: np.ndarray, last: bool):
    """The pass of a round: chunks under centroids ``before`` to chunks under ``after``."""
    k, dims = after.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i]  # noqa: B023, E731
                vectors = np.frombuffer(get("vectors").as_buffer(), "<i4").reshape(-1, dims).astype(np.int64)
                norms = np.frombuffer(get("norms").as_buffer(), "<i8")
                dots = np.frombuffer(get("dots").as_buffer(), "<i8").reshape(-1, k).copy()
                update(dots, vectors, after - before)
                best, distance = nearest(dots, norms, after)
                if not last:
                    yield _chunk(get("ids").values, vectors, norms, dots, best, k)
                    continue
                inertia = [int(distance[best == c].sum()) for c in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [
                        one_list(get("ids").values),
                        one_list(pa.array(best, pa.int32())),
                        one_list(pa.array(distance, pa.int64())),
                        pa.array([inertia], pa.list_(pa.int64())),
                    ],
                    ["ids", "cluster", "distance", "sums"],
                )

    return run


def _written(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path), path


def _totals(chunks: DataFrame, n: int) -> list[int]:
    """The chunks' ``sums`` added up place by place, ``n`` exact numbers."""
    added = chunks.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = [0] * n
    for row in added.collect():
        out[row["at"]] = int(row["value"])
    return out


def centroid_clusters(
    rows: DataFrame, k: int = 8, rounds: int = 10, *, scale: int = 1024, dims: int = 64, salt: str = "3:", id_col: str = "vec_id",
    vector_col: str = "embedding", chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``: every
    vector's cluster after ``rounds`` rounds from the ``k`` rows of smallest
    ``sha256(salt + id)``, its squared distance, and per cluster the sum of distances and
    the hash of the centroid's components."""
    spark = rows.sparkSession
    kept = id_and_vector(rows, id_col, vector_col).where(F.size("vector") == dims)
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    first = kept.orderBy(order, "vec_id", "vector").limit(k).collect()
    if not first:
        return kept.select(
            "vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    centroids = scaled(np.array([r["vector"] for r in first], np.float64), scale)
    n = len(centroids)
    state, path = _written(spark, kept.mapInArrow(_begin(centroids, scale, chunk_rows), _STATE), "centroid-chunks")
    before = centroids
    for turn in range(rounds + 1):
        sums = np.array(_totals(state, n * (dims + 1)), np.int64) if turn < rounds else None
        after = before if sums is None else moved_centroids(before, sums)
        if turn == rounds or (after == before).all():
            break
        last = turn == rounds - 1
        state, newer = _written(spark, state.mapInArrow(_next(before, after, last), _LAST if last else _STATE), "centroid-chunks")
        drop_folder(spark, path)
        path, before = newer, after
    if "distance" not in state.columns:  # settled before the last round, or no round at all
        state, newer = _written(spark, state.mapInArrow(_next(before, before, True), _LAST), "centroid-chunks")
        drop_folder(spark, path)
    inertia = [min(x, (1 << 63) - 1) for x in _totals(state, n)]
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in before]
    pairs = F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("r")
    every = state.select(pairs).select(F.col("r.ids").alias("vec_id"), F.col("r.cluster").alias("cluster"), F.col("r.distance").alias("distance"))
    return every.select(
        "*",
        F.get(F.array(*[F.lit(x).cast("long") for x in inertia]), F.col("cluster")).alias("cluster_inertia"),
        F.lit(min(sum(inertia), (1 << 63) - 1)).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, hashes)), F.col("cluster")).alias("centroid_sha256"),
    )
