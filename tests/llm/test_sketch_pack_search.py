import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from llm_data import empty_documents, messy_documents
from pyspark.sql import functions as F

from docflow.llm import bottomk as B
from docflow.llm import packing as K
from docflow.llm.edited import edited_fingerprints
from docflow.llm.kdtree import top_k
from docflow.llm.wordhash import NON_SPACE, text_buffer, word_hashes


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


# ---------------------------------------------------------------- sketches


def test_word_hashes_do_not_depend_on_neighbours_or_pieces(monkeypatch):
    import docflow.llm.wordhash as W

    texts = ["Ab cd", "", "cd", "ab\ncd é中", None, "x" * 5000 + " ab"]
    whole = [word_hashes(*text_buffer(pa.array([t])), NON_SPACE)[0].tolist() for t in texts]
    data, off = text_buffer(pa.array(texts))
    for piece in (1 << 21, 7, 64):
        monkeypatch.setattr(W, "PIECE", piece)
        h, d = word_hashes(data, off, NON_SPACE)
        assert [h[d == i].tolist() for i in range(len(texts))] == whole
    assert whole[0][0] == whole[3][0] == whole[5][1] and len(whole[5]) == 2


def test_word_hashes_tell_long_words_apart():
    rng = random.Random(1)
    words = set()
    for size in (1, 5, 1023, 1024, 1025, 2048, 5000):
        word = "".join(rng.choice("ab") for _ in range(size))
        words |= {word, word + "a", "b" + word}
        for gap in (1, 512, 1024, 2048, 3072):  # two bytes exchanged
            for at in range(0, size - gap, 701):
                w = list(word)
                w[at], w[at + gap] = w[at + gap], w[at]
                words.add("".join(w))
    data, off = text_buffer(pa.array(sorted(words)))
    from docflow.llm.wordhash import EXACT, word_places

    first, second = word_places(data, off, EXACT, kinds=2)[0]
    assert len(set(first.tolist())) == len(set(second.tolist())) == len(words)
    assert not set(first.tolist()) & set(second.tolist())
    a, b = (B.sketch_texts(*text_buffer(pa.array([t])))[0].tolist() for t in ("A" * 1024 + "B" * 1024, "B" * 1024 + "A" * 1024))
    assert a != b


def test_estimates_and_merging():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    a = " ".join(rng.choice(words) for _ in range(3000))
    b = " ".join(a.split()[:2000] + [rng.choice(words) for _ in range(1000)])
    sketch = lambda t: B.sketch_texts(*text_buffer(pa.array([t])))[0]
    sa, sb = sketch(a), sketch(b)
    assert abs(B.resemblance(sa, sb) - jaccard(shingles(a), shingles(b))) < 0.13
    assert abs(B.containment(sb, sa) - len(shingles(a) & shingles(b)) / len(shingles(b))) < 0.2
    assert abs(B.distinct(sa) / len(shingles(a)) - 1) < 0.3
    every = B.shingle_hashes(word_hashes(*text_buffer(pa.array([a])), NON_SPACE)[0])
    parts = [B.smallest(x) for x in np.array_split(every, 7)]
    merged = parts[0]
    for p in parts[1:]:
        merged = B.merge(merged, p)
    assert merged.tolist() == sa.tolist() == sorted(set(every.tolist()))[: B.K]
    assert B.decode(B.encode(sa)).tolist() == sa.tolist() and B.encode(sketch("")) == ""


def test_fingerprints_and_native_merge(spark):
    messy = messy_documents(spark)
    out = B.fingerprints(messy)
    assert out.count() == messy.count() and {"a.b", "score", "fingerprint"} <= set(out.columns)
    by = {}
    for r in out.collect():
        by.setdefault(r["text"], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in by.values()) and by[None] == by[""] == {""}
    merged = B.merge_fingerprints(out.select(F.lit(1).alias("g"), "fingerprint"), ["g"]).first()["fingerprint"]
    union = sorted({h for x in by.values() for f in x for h in B.decode(f).tolist()})[: B.K]
    assert B.decode(merged).tolist() == union
    assert B.fingerprints(empty_documents(spark)).count() == 0


def check_edited(rows, got):
    signed = lambda t: xxhash.xxh64_intdigest(t, seed=42) - ((xxhash.xxh64_intdigest(t, seed=42) >> 63) << 64)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1] or ""), r[1] or ""))
    assert len(got) == len(rows)
    want = []
    for i, (k, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        want.append((k, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=key) == sorted(want, key=key)


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_edited_texts(spark, partitions):
    rng = random.Random(9)
    rows = [(rng.randint(-50, 500) if i % 17 else i * 1000, " ".join(rng.choice(["aé", "b", "中c", "dd"]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    got = edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), partitions=partitions).collect()
    check_edited(rows, got)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_edited_awkward_rows(spark):
    messy = messy_documents(spark)
    got = edited_fingerprints(messy, partitions=3).collect()
    check_edited([(r["doc_id"], r["text"]) for r in messy.collect()], got)
    assert edited_fingerprints(empty_documents(spark)).count() == 0
    one = edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0


def test_rows_of_one_id_spread_over_the_ranges_and_likeness_is_checked(spark):
    from docflow.llm.edited import _with_successors

    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    text = lambda: " ".join(rng.choice(words) for _ in range(80))
    rows = [(7 if i % 3 else None, text()) for i in range(600)] + [(1000 + i, text()) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    held = _with_successors(df, 9).where("extra = 0").groupBy("range").count().collect()
    assert len(held) >= 8 and max(r["count"] for r in held) < 3 * 900 / 9
    got = edited_fingerprints(df, partitions=9).collect()
    check_edited(rows, got)
    # likeness against exact sets: the edited copy keeps two thirds of the text, the next document has none of it
    assert all(0.3 < r["near_edited"] < 0.75 and r["near_next"] < 0.1 for r in got)


# ---------------------------------------------------------------- packing


def best_fit(sizes, p):
    """The same rules with plain scans over all bins."""
    bins, where = [], []
    for i, size in enumerate(sizes):
        fits = [(cap - used, k) for k, (cap, used) in enumerate(bins) if cap - used >= size and used < cap]
        if fits:
            room = min(fits)[0]
            k = next(k for r, k in waiting(bins, where, sizes, room) if r == room and bins[k][0] - bins[k][1] == room)
        else:
            rest = sum(sizes[i + 1 :])
            cap = min((c for c in sorted(p.capacities) if c >= size), key=lambda c: (p.cost(c) / min(c, size + rest), c))
            bins.append([cap, 0])
            k = len(bins) - 1
        where.append(k)
        bins[k][1] += size
    return where, [min(c for c in p.capacities if c >= used) for _, used in bins]


def waiting(bins, where, sizes, room):
    """Bins with this much room in the order in which they came to it."""
    last = {k: i for i, k in enumerate(where)}
    return sorted(((cap - used, k) for k, (cap, used) in enumerate(bins) if cap - used == room), key=lambda x: last[x[1]])


def test_best_fit_equals_plain_scans():
    rng = random.Random(7)
    p = K.Packing(capacities=(20, 50, 90), overhead=6.0, square=400.0)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 90) for _ in range(rng.randint(1, 80))), reverse=True)
        where, offsets, capacity = K.pack(sizes, p)
        assert (where, capacity) == best_fit(sizes, p)
        used = [0] * len(capacity)
        for size, b, at in zip(sizes, where, offsets, strict=True):
            assert at == used[b]
            used[b] += size
        assert all(u <= c and not any(u <= d < c for d in p.capacities) for u, c in zip(used, capacity, strict=True))


def test_packed_documents_are_whole(spark):
    rng = random.Random(12)
    rows = [(i, "é" * rng.randint(0, 900)) for i in range(400)] + [(900, "x" * 50_000), (7, None), (None, "y" * 10), (3, "é" * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    p = K.Packing(capacities=(512, 1024, 4096), shard=100, run=60)
    out = K.pack_documents(docs, params=p).collect()
    total = {}
    bins = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
        if r["bin_id"] is None:
            assert r["length"] == 0 and r["bin_capacity"] is None
            continue
        bins.setdefault((r["bin_id"], r["bin_capacity"]), []).append((r["bin_offset"], r["length"]))
    want = {}
    for k, t in rows:
        want[k] = want.get(k, 0) + len((t or "").encode())
    assert total == want and len({b for b, _ in bins}) == len(bins)
    for (_, capacity), parts in bins.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity in p.capacities and not any(at <= c < capacity for c in p.capacities)
    filled = sum(sum(n for _, n in parts) for parts in bins.values()) / sum(c for _, c in bins)
    assert filled > 0.9


def test_packing_awkward_rows(spark):
    messy = messy_documents(spark)
    out = K.pack_documents(messy)
    assert out.select("doc_id", "piece").where("piece = 0").count() == messy.count()
    assert K.pack_documents(empty_documents(spark)).count() == 0
    again = K.pack_documents(messy, length=F.col("size"))
    assert {r["length"] for r in again.collect()} == {5}


# ---------------------------------------------------------------- search


def brute_top(rows, k, every):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {(i, tuple(v)) for i, v in usable if i is not None and i % every == 0}
    out = []
    for i, v in queries:
        scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in usable if j != i]
        out += [(i, r, None if none else j, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, none, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vector array<double>")


@pytest.mark.parametrize("shard_rows,block,boxes", [(1000, 500, 100), (40, 7, 100), (40, 7, 0)])
def test_top_k_equals_brute_force(spark, shard_rows, block, boxes):
    rng = random.Random(10)
    rows = [(i, [round(rng.gauss(0, 0.3), 2) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(120)]  # one vector many times: ties
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [math.nan] * 6), (903, [math.inf] * 6), (910, [0.5, 0.5]), (920, []), (None, rows[7][1]), (30, rows[8][1])]
    got = top_k(vectors(spark, rows).repartition(4), F.col("vec_id") % 10 == 0, k=5, shard_rows=shard_rows, block_queries=block, max_boxes=boxes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_top(rows, 5, 10)


def test_top_k_small_and_large_values(spark):
    huge = [(0, [1e18, -1e18]), (1, [1e17, 3.0]), (2, [-2e17, 1.0]), (10, [5e15, 1e3])]
    got = top_k(vectors(spark, huge), F.col("vec_id") % 10 == 0, k=5)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_top(huge, 5, 10)
    assert top_k(vectors(spark, [(10, [0.5])]), F.col("vec_id") % 10 == 0).count() == 0
    assert top_k(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0


def test_regions_are_even_and_copies_stay_together():
    from docflow.llm.kdtree import planes, region_of

    rng = np.random.default_rng(5)
    sample = np.floor(256 * rng.normal(size=(2000, 6)))
    side, cut = planes(sample, 16)
    counts = np.bincount(region_of(sample, side, cut), minlength=16)
    assert len(counts) == 16 and counts.min() > 90 and counts.max() < 160
    copies = np.repeat(sample[:1], 500, axis=0)
    side, cut = planes(np.concatenate([copies, sample[:300]]), 8)
    assert len(set(region_of(copies, side, cut).tolist())) == 1
    assert region_of(copies[:3], np.zeros(0, np.int64), np.zeros(0)).tolist() == [0, 0, 0]
    assert len(planes(np.zeros((0, 4)), 4)[0]) == 3


def test_clustered_queries_meet_few_shards(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(12, 8)) * 4
    rows = [(i, (centers[i % 12] + rng.normal(size=8) * 0.05).tolist()) for i in range(1200)]
    got = top_k(vectors(spark, rows).repartition(4), F.col("vec_id") % 10 == 0, k=5, shard_rows=60)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_top(rows, 5, 10)
