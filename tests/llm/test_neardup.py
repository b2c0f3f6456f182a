import random
from itertools import combinations

import numpy as np
import xxhash
from llm_data import empty_documents, messy_documents

from docflow.llm import simhash as S
from docflow.llm.components import connected_components
from docflow.session import materialize


def fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) > words else [b" ".join(w)] * bool(w)
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(values, max_bits):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= max_bits:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return [root(x) for x in range(len(values))]


def expected(rows, max_bits=4):
    prints = [fingerprint(t) for _, t in rows]
    roots = components(prints, max_bits)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted([(i is None, i or 0, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots, strict=True)], key=str)


def near_copies(n=120):
    rng = random.Random(8)
    base = [[rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(150)] for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "new" + str(rng.randint(0, 9))
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    return rows


def test_groups_equal_brute_force(spark):
    rows = near_copies() + [(500, "A b c"), (501, "a B  C"), (502, "nul \x00 word here now"), (503, "é x y z w")]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted([(r[0] is None, r[0] or 0, r[1], r[2]) for r in got.collect()], key=str) == expected(rows)


def test_awkward_rows_and_empty_table(spark):
    messy = messy_documents(spark)
    got = S.near_duplicates(messy)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert sorted([(r[0] is None, r[0] or 0, r[1], r[2]) for r in got.collect()], key=str) == expected(rows)
    assert S.near_duplicates(empty_documents(spark)).count() == 0


def test_every_link_is_found_whatever_blocks_and_tiles(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    centres = rng.integers(-(1 << 63), 1 << 63, 8, dtype=np.int64).tolist()
    values = set()
    while len(values) < 600:
        v = centres[int(rng.integers(8))]
        for b in rng.integers(0, 64, int(rng.integers(0, 9))).tolist():
            v ^= (1 << b) - ((1 << 64) if b == 63 else 0)
        values.add(v)
    values = sorted(values)
    unsigned = [v % (1 << 64) for v in values]
    classes = materialize(spark.createDataFrame([(v,) for v in values], "fp long"), "classes")
    for max_bits, tile in ((4, 4_096), (4, 50), (2, 10)):
        label = {r["node"]: r["label"] for r in connected_components(S.fingerprint_links(classes, max_bits, tile=tile)).collect()}
        got = [label.get(v, v) for v in values]
        roots = components(unsigned, max_bits)
        assert len(set(zip(got, roots, strict=True))) == len(set(got)) == len(set(roots))


def test_pivots_discard_no_link():
    rng = random.Random(3)
    pivots = S._pivots(S.PIVOTS)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << k
        far = max(abs((a ^ p % (1 << 64)).bit_count() - (b ^ p % (1 << 64)).bit_count()) for p in pivots)
        assert far <= (a ^ b).bit_count() <= 4


def test_block_cover_grows_with_the_classes():
    assert S._block_count(1_000, 4) == 6 and S._block_count(50_000_000, 4) == 7 and S._block_count(10**11, 4) == 8


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[x] == 100 for x in range(100, 160))
    assert got[300] == got[301] == 300 and 200 not in got
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
