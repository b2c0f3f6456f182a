import random
import re

from llm_data import empty_documents, messy_documents

from docflow.llm.linededup import dedup_lines


def brute(docs, min_words):
    """Longest earlier occurrence from every line on; every line of a run with enough words goes."""
    seqs = []
    for k, text in docs:
        lines = (text or "").split("\n")
        seqs.append((k, lines, [(n, tuple(re.findall(r"[^\x09-\x0D\x20]+", x))) for n, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]))
    out = {}
    for d, (k, lines, seq) in enumerate(seqs):
        gone = set()
        for a in range(len(seq)):
            longest = 0
            for e in range(d + 1):
                other = seqs[e][2]
                for b in range(len(other) if e < d else a):
                    n = 0
                    while a + n < len(seq) and b + n < len(other) and seq[a + n][1] == other[b + n][1]:
                        n += 1
                    longest = max(longest, n)
            if sum(len(w) for _, w in seq[a : a + longest]) >= min_words:
                gone |= {seq[a + i][0] for i in range(longest)}
        out[k] = (len(lines), len(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone) if gone else text_of(docs, k))
    return out


def text_of(docs, k):
    return dict(docs)[k]


def passages(n=45):
    rng = random.Random(6)
    pool = [" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 9))) for _ in range(25)]
    docs = []
    for i in range(n):
        lines = []
        while len(lines) < rng.randint(3, 16):
            if docs and rng.random() < 0.4:
                other = rng.choice(docs)[1].split("\n")
                a = rng.randrange(len(other))
                lines += other[a : a + rng.randint(1, 7)]
            else:
                lines.append(rng.choice([*pool, "", "  ", f"own {i} {len(lines)}"]))
        docs.append((i, "\n".join(lines)))
    return docs


def test_deletions_equal_longest_earlier_runs(spark):
    docs = passages()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for min_words in (8, 20):
        got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["text"]) for r in dedup_lines(table, min_words).collect()}
        want = brute(docs, min_words)
        assert got == want
        assert sum(x[1] for x in want.values()) > 20


def test_first_copy_and_clean_documents_stay(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(3, f"head\n{passage}\ntail"), (1, f"{passage}\nend"), (2, "clean text\nof two lines"), (4, passage), (5, passage.replace(" ", "  "))]
    got = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1] == (docs[1][1], 0) and got[2] == (docs[2][1], 0)
    assert got[3] == ("head\ntail", 1) and got[4] == ("", 1) and got[5] == ("", 1)


def test_awkward_rows_and_empty_table(spark):
    messy = messy_documents(spark)
    out = dedup_lines(messy)
    assert out.count() == messy.count() and {"a.b", "key", "lines", "n_deleted"} <= set(out.columns)
    rows = {(r["doc_id"], r["n_deleted"]): r["text"] for r in out.collect()}
    assert rows[(2, 0)] is None and rows[(3, 0)] == "" and rows[(4, 0)] == " \n\t "
    assert rows[(6, 1)] == "" and rows[(1, 0)] and (7, 0) in rows and (None, 0) in rows
    assert sum(1 for r in out.collect() if r["doc_id"] == 6) == 2
    assert dedup_lines(empty_documents(spark)).count() == 0


def test_long_words_that_differ_by_exchanged_bytes_are_no_copies(spark):
    tail = " ".join(f"t{i}" for i in range(60))
    a, b = "A" * 1024 + "B" * 1024, "B" * 1024 + "A" * 1024
    docs = [(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, f"{a} {tail}")]
    got = {r["doc_id"]: r["n_deleted"] for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), 50).collect()}
    assert got == {1: 0, 2: 0, 3: 1}
