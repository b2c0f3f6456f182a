import random
import zlib

import numpy as np
from llm_data import empty_documents, messy_documents
from pyspark.sql import functions as F

from docflow.llm import toxicity as T


def corpus(spark, n=900):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rng.choice(["sun", "moon", "tree", "road", "sea", "hill"]) + str(rng.randint(0, 40)) for _ in range(40)]
        if toxic:
            for _ in range(4):
                words.insert(rng.randint(0, 40), rng.choice(["Vile", "rotten", "WRETCH"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    got = {r["doc_id"]: r for r in T.toxicity(docs, labels).collect()}
    held = [r for i, r in got.items() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert 200 < len(held) < 400
    wrong = [r for r in held if r["predicted"] != (r["doc_id"] % 5 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_labels_of_held_out_documents_change_nothing(spark):
    docs, labels = corpus(spark, 300)
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in T.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_sample_bound_and_order_independence(spark):
    docs, labels = corpus(spark, 300)
    params = T.FtrlParams(max_rows=60, epochs=2)
    a = T.fit(docs.repartition(5), labels.repartition(3), params).collect()
    b = T.fit(docs.coalesce(1), labels.coalesce(1), params).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_label_counts_around_the_bound(spark):
    docs, labels = corpus(spark, 150)
    for n in range(59, 71):
        model = T.fit(docs, labels.where(F.col("doc_id") < n), T.FtrlParams(max_rows=60, epochs=1)).collect()
        assert sum(r["idx"] == -1 for r in model) == 1


def test_long_documents_are_learnt_from_by_a_subset(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(200):
        words = [f"w{rng.randint(0, 3_000)}" for _ in range(1_500)]
        words[::25] = [rng.choice(["vile", "rotten"] if i % 2 else ["kind", "mild"]) for _ in words[::25]]
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = T.toxicity(docs, marks, T.FtrlParams(max_coordinates=1_000)).where("held_out").collect()
    assert len(got) > 40 and sum(r["predicted"] != r["doc_id"] % 2 for r in got) <= 0.2 * len(got)


def test_the_subset_is_that_of_smallest_hashes():
    rng = np.random.default_rng(2)
    key = np.unique((rng.integers(0, 5, 900) << 10) | rng.integers(0, 1 << 10, 900))
    salt = rng.integers(0, 1 << 63, 5).astype(np.uint64)
    got = T._spread_subset(key, 10, 60, salt)
    for d in range(5):
        mine = [int(k) for k in key if k >> 10 == d]
        want = sorted(sorted(mine, key=lambda k: int(T.mix(np.array([k & 1023], np.uint64) + salt[d])[0]))[:60])
        assert [int(k) for k in got if k >> 10 == d] == want
    assert T._spread_subset(key, 10, 1_000, salt) is key


def test_features_equal_plain_loops():
    import re

    import pyarrow as pa

    from docflow.llm.wordhash import text_buffer, word_hashes

    mask = (1 << 64) - 1

    def mix(h):
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & mask
        return h ^ (h >> 31)

    def word_hash(word):
        return int(word_hashes(*text_buffer(pa.array([word])))[0][0])

    texts = ["One two, THREE four", "", "ärger x1", "a", "a b a b a", "q" * 3_000 + " tail"]
    data, off = text_buffer(pa.array(texts))
    idx, doc = T.coordinates(data, off, 20)
    for d, text in enumerate(texts):
        h = [word_hash(w) for w in re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))]
        want = [mix(x * int(T._UNI) & mask) for x in h]
        want += [mix((a * int(T._LEFT) + b * int(T._NEXT)) & mask) for a, b in zip(h, h[1:], strict=False)]
        want += [mix((a * int(T._LEFT) + b * int(T._SKIP)) & mask) for a, b in zip(h, h[2:], strict=False)]
        assert sorted(idx[doc == d].tolist()) == sorted(x >> 44 for x in want)


def test_one_row_of_a_labelled_id_is_learnt_from(spark):
    docs, labels = corpus(spark, 120)
    params = T.FtrlParams(epochs=1)
    once = T.fit(docs, labels, params).collect()
    copies = T.fit(docs.unionByName(docs.where("doc_id < 30")), labels, params).collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, copies))
    other = spark.createDataFrame([(i, f"other {i} " * 30) for i in range(30)], "doc_id long, text string")
    both = [T.fit(d.repartition(n), labels, params).collect() for d, n in ((docs.unionByName(other), 5), (other.unionByName(docs), 1))]
    one = docs.unionByName(other).groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    assert sorted(map(tuple, both[0])) == sorted(map(tuple, both[1])) == sorted(map(tuple, T.fit(one, labels, params).collect()))


def test_ftrl_is_the_textbook_update():
    p = T.FtrlParams(alpha=0.5, beta=1.0, l1=0.1, l2=0.01, bits=4, epochs=1)
    rows = [(np.array([1, 3]), 1), (np.array([3, 5]), 0), (np.array([1]), 1)]
    size, z, n = 17, np.zeros(17), np.zeros(17)

    def weight(i):
        if i == 16:
            return -z[i] / ((p.beta + n[i] ** 0.5) / p.alpha)
        return 0.0 if abs(z[i]) <= p.l1 else -(z[i] - np.sign(z[i]) * p.l1) / ((p.beta + n[i] ** 0.5) / p.alpha + p.l2)

    for k in np.random.Generator(np.random.PCG64(7)).permutation(3):
        idx, y = rows[k]
        at = [*idx, size - 1]
        w = {i: weight(i) for i in at}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i in at:
            s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / p.alpha
            z[i] += g - s * w[i]
            n[i] += g * g
    idx, w, bias = T.ftrl(rows, p)
    assert np.allclose(bias, weight(16)) and all(np.isclose(x, weight(i)) for i, x in zip(idx, w, strict=True))


def test_awkward_rows_and_empty_tables(spark):
    docs, labels = corpus(spark, 60)
    model = T.fit(docs, labels, T.FtrlParams(epochs=1))
    messy = messy_documents(spark)
    scored = T.score(messy, model)
    assert scored.count() == messy.count() and set(scored.columns) == set(messy.columns)
    got = {(r["doc_id"], r["text"]): r["score"] for r in scored.collect()}
    assert got[(2, None)] == got[(3, "")] == got[(4, " \n\t ")] == got[(None, None)]
    assert got[(10, "ALPHA beta")] == got[(11, "alpha BETA")]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in T.toxicity(messy, none).collect()} == {0.5}
    assert T.toxicity(empty_documents(spark), labels).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0), (5, 1)], "doc_id long, toxic int")
    assert T.toxicity(messy, odd).count() == messy.count()
