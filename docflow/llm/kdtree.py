"""Exact top-k by inner product: one KD-tree per shard of the vectors.

Vectors become integers (``floor(256 * x)``). Shards are regions of space: planes from the
medians of a bounded sample send every row to one, and a region of many rows (or copies)
is cut by hashes, so shards hold a bounded number of rows each. Every shard builds a tree:
splits at the median of the widest side, a tight bounding box at every node. The trees are
written once.

Queries go to trees, never trees to queries: a task reads a tree and then the stream of the
queries that meet it. For each query the nodes are visited best first by the largest inner
product that their box allows, until no box reaches the k-th score found. A query first
searches the shard of its own region. The k-th score found there decides which other
shards it meets at all, by their root boxes (a table that goes to the tasks while it is
within ``MAX_BOXES``; beyond, all shards), and prunes inside them from the start.

Work is queries times shards at worst; a task holds one tree and a block of queries, both
of bounded size, and returns at most k rows a query.

Defined results: vectors that are null, or hold a null or a non-finite component, take
no part. Shorter vectors count as filled up with zeros. Candidates are all rows with
another id than the query's, repeated rows each; a row without id is no query and
ranks last among equals. Distinct vectors of one query id are distinct queries.
Scores beyond 64 bits are held at the ends of their range.
"""

from __future__ import annotations

import heapq
import io
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.session import materialize

SHARD_ROWS, BLOCK_QUERIES, LEAF = 8_192, 2_048, 64
#: Rows that the planes between regions are taken from, regions at most, and root boxes that go to the tasks.
SAMPLE, MAX_REGIONS, MAX_BOXES = 16_384, 1_024, 65_536
_EXACT = float(1 << 53)


def _matrix(vectors, width: int = 0) -> np.ndarray:
    """Integers ``floor(256 * x)`` as doubles; shorter vectors (or all, up to ``width``) filled up with zeros."""
    rows = [np.floor(256.0 * np.asarray(v, np.float64)) for v in vectors]
    width = max([width, *(len(r) for r in rows)])
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def build(points: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """The tree over the rows of ``points``: ``order`` of the rows; per node its range
    in that order, its children (0: a leaf) and the bounds of its box."""
    order = np.arange(len(points))
    ranges, children, low, high = [], [], [], []
    todo = [(0, len(points), -1)]
    while todo:
        a, b, parent = todo.pop()
        node = len(ranges)
        if parent >= 0:
            children[parent].append(node)
        rows = points[order[a:b]]
        lo, hi = rows.min(0, initial=np.inf), rows.max(0, initial=-np.inf)
        ranges.append((a, b))
        children.append([])
        low.append(lo)
        high.append(hi)
        if b - a > leaf:
            half = (b - a) // 2
            side = int(np.argmax(hi - lo)) if len(lo) else 0
            if len(lo):
                order[a:b] = order[a:b][np.argpartition(rows[:, side], half)]
            todo += [(a, a + half, node), (a + half, b, node)]
    kids = np.array([c if c else [0, 0] for c in children], np.int64)
    return {"order": order, "ranges": np.array(ranges, np.int64), "children": kids, "low": np.array(low), "high": np.array(high)}


def search(tree: dict, ids: np.ndarray, points: np.ndarray, query: np.ndarray, own: int, k: int, bounds: np.ndarray, least: float):
    """The ``k`` best ``(score, id)`` rows of one query with scores of ``least`` or more; ``bounds``: per node, the best score its box allows."""
    best: list[tuple] = []  # a heap, the worst on top: (score, -id, row)
    kth = least
    queue = [(-bounds[0], 0)]
    ranges, children = tree["ranges"], tree["children"]
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < kth:
            break
        left, right = children[node]
        if left:
            for child in (left, right):
                if bounds[child] >= kth:
                    heapq.heappush(queue, (-bounds[child], child))
            continue
        a, b = ranges[node]
        scores = points[a:b] @ query
        for i in np.flatnonzero(scores >= kth):
            row = (scores[i], -ids[a + i], a + i)
            if ids[a + i] == own:
                continue
            if len(best) < k:
                heapq.heappush(best, row)
            elif row > best[0]:
                heapq.heapreplace(best, row)
        if len(best) == k:
            kth = max(kth, best[0][0])
    return best


_NO_ID = np.iinfo(np.int64).max


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def planes(sample: np.ndarray, regions: int) -> tuple[np.ndarray, np.ndarray]:
    """``(side, cut)`` of a complete binary tree of median planes with ``regions`` (a power
    of two) leaves."""
    side, cut = np.zeros(regions - 1, np.int64), np.full(regions - 1, np.inf)
    held = [sample]
    for node in range(regions - 1):
        mine = held[node]
        if len(mine) and mine.shape[1]:
            spread = mine.max(axis=0) - mine.min(axis=0)
            side[node] = int(spread.argmax())
            if spread.max() > 0:
                # the larger half of equal values stays together
                middle = float(np.median(mine[:, side[node]]))
                cut[node] = middle if middle < mine[:, side[node]].max() else np.nextafter(middle, -np.inf)
        right = mine[:, side[node]] > cut[node] if mine.shape[1] else np.zeros(len(mine), bool)
        held += [mine[~right], mine[right]]
    return side, cut


def region_of(rows: np.ndarray, side: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The leaf that each row lies in."""
    node = np.zeros(len(rows), np.int64)
    while len(side) and node.min(initial=len(side)) < len(side):
        node = 2 * node + 1 + (rows[np.arange(len(rows)), side[node]] > cut[node])
    return node - len(side)


def _build_shard(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("ord", kind="stable")  # the same tree however rows arrive
    points = _matrix(part["vector"])
    tree = build(points)
    ids = part["vec_id"].fillna(_NO_ID).astype(np.int64).to_numpy()
    blob = _pack(points=points[tree["order"]], ids=ids[tree["order"]], **tree)
    return pd.DataFrame({"shard": [part["shard"].iloc[0]], "tree": [blob], "low": [tree["low"][0].tolist()], "high": [tree["high"][0].tolist()]})


def _box_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The best inner product of each query with a point of each box."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def _search(tree: dict, q: np.ndarray, keys: list, owns: list, leasts: list, k: int) -> list[tuple]:
    """``(query, query_id, vec_id, score)`` of a block of queries in one tree."""
    points, ids, low, high = (tree[n] for n in ("points", "ids", "low", "high"))
    width = max(q.shape[1], points.shape[1])
    q, points, low, high = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, points, low, high))
    size = float(np.abs(points).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, width)
    if size >= _EXACT:  # beyond exact doubles: Python's integers
        points, low, high, q = (np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (points, low, high, q))
    bounds = _box_bounds(q, low, high)
    out = []
    for i, (key, own, least) in enumerate(zip(keys, owns, leasts, strict=True)):
        for score, _, row in search(tree, ids, points, q[i], own, k, bounds[i], -math.inf if least is None else least):
            out.append((key, own, None if ids[row] == _NO_ID else int(ids[row]), max(-(1 << 63), min((1 << 63) - 1, int(score)))))
    return out


_FOUND = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search_stream(k: int, block: int):
    """Rows by shard, each shard's tree first and then its queries, to what they find."""

    def run(batches):
        tree, of = None, None
        for b in batches:
            shards, blobs = b.column("shard").to_numpy(), b.column("tree")
            at = 0
            while at < b.num_rows:
                if blobs[at].is_valid:
                    with np.load(io.BytesIO(blobs[at].as_py())) as z:
                        tree, of = {name: z[name] for name in z.files}, shards[at]
                    at += 1
                    continue
                end = at
                while end < b.num_rows and end - at < block and shards[end] == shards[at] and not blobs[end].is_valid:
                    end += 1
                part = b.slice(at, end - at)
                if shards[at] == of:
                    keys, owns, leasts = (part.column(c).to_pylist() for c in ("query", "query_id", "least"))
                    found = _search(tree, _matrix(part.column("vector").to_pylist()), keys, owns, leasts, k)
                    columns = list(zip(*found, strict=True)) or [()] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)
                at = end

    return run


def _meeting(shards: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Queries to the shards (but their home) whose root box allows their k-th score."""

    def run(batches):
        for b in batches:
            q, least, home = _matrix(b.column("vector").to_pylist(), low.shape[1]), b.column("least").to_pylist(), b.column("home").to_numpy()
            lo, hi = (np.pad(m, ((0, 0), (0, q.shape[1] - m.shape[1]))) for m in (low, high))
            met = []
            for a in range(0, len(q), 256):
                rows = q[a : a + 256]
                size = max(float(np.abs(lo).max(initial=0)), float(np.abs(hi).max(initial=0))) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
                reach = _box_bounds(rows, lo, hi) if size < _EXACT else np.full((len(rows), len(lo)), np.inf)
                for i in range(len(rows)):
                    kth = least[a + i]
                    allowed = (reach[i] >= (-np.inf if kth is None else kth)) & (shards != home[a + i])
                    met.append(shards[allowed].tolist())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("query", "query_id", "vector", "least")), pa.array(met, pa.list_(pa.int32()))],
                ["query", "query_id", "vector", "least", "shards"],
            )

    return run


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return vector.isNotNull() & fine


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, max_boxes: int = MAX_BOXES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``vectors (vec_id, vector)``
    where ``is_query`` holds, the ``k`` rows of highest inner product."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(_usable(F.col("vector")))
    place = F.xxhash64("vec_id", "vector")
    total = rows.count()
    regions = min(MAX_REGIONS, 1 << max(0, -(-total // shard_rows) - 1).bit_length())
    side, cut = np.zeros(0, np.int64), np.zeros(0)
    if regions > 1:
        share = F.pmod(F.xxhash64("vector", "vec_id", F.lit(1)), F.lit(max(1, -(-total // SAMPLE)))) == 0
        side, cut = planes(_matrix(r["vector"] for r in rows.where(share).select("vector").limit(2 * SAMPLE).collect()), regions)

    def region(column: pa.Array) -> pa.Array:
        return pa.array(region_of(_matrix(column.to_pylist(), int(side.max(initial=0)) + 1), side, cut), pa.int32())

    placed = rows.withColumn("region", F.arrow_udf(region, "int")("vector") if regions > 1 else F.lit(0))
    counts = {r["region"]: r["n"] for r in placed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [max(1, -(-counts.get(r, 0) // shard_rows)) for r in range(regions)]
    first_shard = np.concatenate([[0], np.cumsum(parts)])
    of_region = lambda values: F.get(F.array(*[F.lit(int(v)) for v in values]), F.col("region"))
    # copies of one vector spread over their region's shards by their row's place in the scan
    spread = F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), of_region(parts)).cast("int")
    shard = (of_region(first_shard[:-1]) + spread).cast("int")
    trees = materialize(
        placed.select("vec_id", "vector", place.alias("ord"), shard.alias("shard")).groupBy("shard").applyInPandas(_build_shard, "shard int, tree binary, low array<double>, high array<double>"),
        "kd-trees",
    )
    # a query's home is a shard of its own region
    home = (of_region(first_shard[:-1]) + F.pmod(F.xxhash64("query", F.lit(2)), of_region(parts)).cast("int")).cast("int")
    asking = placed.where("asks").select(place.alias("query"), F.col("vec_id").alias("query_id"), "vector", "region").distinct()
    queries = asking.select("query", "query_id", "vector", home.alias("home"))
    held = trees.select("shard", "tree", *[F.lit(None).cast(t).alias(n) for n, t in (("query", "long"), ("query_id", "long"), ("vector", "array<double>"), ("least", "double"))])

    def visit(asked: DataFrame) -> DataFrame:
        """``asked (shard, query, query_id, vector, least)`` searched in their shards' trees."""
        both = held.unionByName(asked.withColumn("tree", F.lit(None).cast("binary")))
        ordered = both.repartition("shard").sortWithinPartitions("shard", F.col("tree").isNull())
        return ordered.mapInArrow(_search_stream(k, block_queries), "query long, query_id long, vec_id long, score long")

    none = F.lit(None).cast("double").alias("least")
    first = materialize(visit(queries.select(F.col("home").alias("shard"), "query", "query_id", "vector", none)), "home-shard")
    kth = first.groupBy("query", "query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("least"))
    known = queries.join(kth, ["query", "query_id"], "left").select("query", "query_id", "vector", "home", "least")
    shards = int(first_shard[-1])
    if shards <= max_boxes:
        boxes = sorted(trees.select("shard", "low", "high").collect(), key=lambda r: r["shard"])
        width = max((len(r["low"]) for r in boxes), default=0)
        low, high = (np.array([r[n] + [0.0] * (width - len(r[n])) for r in boxes], np.float64).reshape(len(boxes), width) for n in ("low", "high"))
        asked = known.mapInArrow(
            _meeting(np.array([r["shard"] for r in boxes], np.int32), low, high), "query long, query_id long, vector array<double>, least double, shards array<int>"
        )
    else:
        every = F.sequence(F.lit(0), F.lit(shards - 1))
        asked = known.withColumn("shards", F.filter(every, lambda s: s != F.col("home"))).drop("home")
    rest = visit(asked.select(F.explode("shards").alias("shard"), "query", "query_id", "vector", "least"))
    best = Window.partitionBy("query", "query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
