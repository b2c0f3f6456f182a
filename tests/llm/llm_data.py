"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

CLASHING = "score double, label int, rank int, key string, size long, lines int, `range` int, detections string, `a.b` string, any int, text_of string, `row` string, numbers int, of_id int"


def messy_documents(spark, extra: bool = True):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns with the operators' own names."""
    rng = random.Random(11)
    words = "alpha beta gamma delta übung ñandú 中文 x1 don't".split()
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    text = " ".join(rng.choice(words) for _ in range(70))
    rows = [
        (1, text), (2, None), (3, ""), (4, " \n\t "), (5, long_text), (6, text), (6, text), (7, text + " end"),
        (None, "no id here"), (None, None), (8, "one"), (9, "The MIT License\r\n" + text), (10, "ALPHA beta"), (11, "alpha BETA"),
    ]
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    more = (None, 1, None, "k", 5, None, 3, None, "dot", 4, "of", "r", None, 6)
    return spark.createDataFrame([(*r, *more) for r in rows], "doc_id long, text string, " + CLASHING)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, score double")


def rows_of(df, *cols):
    key = lambda r: tuple((v is None, v) for v in r)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
