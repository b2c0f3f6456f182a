import math
import random
import re
import time
from itertools import accumulate, product
from re import _constants, _parser

from llm_data import empty_documents, messy_documents
from pyspark.sql import functions as F

from docflow.llm.license_rules import BASE, rules, to_regex, whole_words
from docflow.llm.licenses import _marks, _rule_table, _states, detect, scan_licenses

PHRASES = [
    "GNU General Public License, version 3", "Licensed under the Apache License, Version 2.0.", "apache  license", "CC BY-NC 4.0", "cc-by",
    "SPDX-License-Identifier: MIT", "Released under the MIT License.", "mit licensee", "https://opensource.org/licenses/MIT", "public domain",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "Copyright (c) 2019-2021", "all rights reserved", "GPLv2",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License", "either version 2 of the License, or (at your option) any later version",
    "Creative Commons Attribution-ShareAlike 4.0", "Boost Software License 1.0", "für GNU GENERAL\nPUBLIC LICENSE é", "écc by", "cc byé", "MITLicense",
]


def brute(text):
    """Every rule on the whole text, all pairs compared."""
    text = text or ""
    dets = []
    for k, (label, tier, _, _, rx) in enumerate(rules()):
        dets += [(m.start(), m.end(), tier, k, label) for m in re.finditer(rx, text, re.A)]

    def beats(e, d):
        if not (e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and e is not d):
            return False
        return (e[0], e[1]) != (d[0], d[1]) or e[2] > d[2] or e[3] < d[3]

    kept = sorted(d for d in dets if not any(beats(e, d) for e in dets))
    words = [(m.start(), m.group().translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    places = []
    for phrase, label in BASE:
        q = phrase.split()
        places += [(i, label) for i in range(len(words) - len(q) + 1) if [w for _, w in words[i : i + len(q)]] == q]
    base = sorted({x for _, x in places})
    return (
        len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
        ",".join(base), ",".join(sorted({*base, *(d[4] for d in kept)})), max([*(d[2] for d in kept), int(bool(places)), 0]) / 4, kept,
    )


def test_scan_equals_brute_force(spark):
    rng = random.Random(2)
    texts = PHRASES + [" ".join(rng.choice([*PHRASES, "und", "mit", "x", "The"]) for _ in range(rng.randint(0, 8))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    for i, t in enumerate(texts):
        r, e = got[i], brute(t)
        kept = [(d["start"], d["end"], d["tier"], d["rule"], d["label"]) for d in r["detections"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"], sorted(kept)) == e, t


def test_rule_table():
    table = rules()
    assert len(table) > 200
    for label, tier, need, hint, rx in table:
        re.compile(rx)
        assert label and tier in (1, 2, 3, 4)
        # the prefilter looks for single lower-case words only
        assert all(k and k == k.lower() and not re.search(r"\s", k) for k in (need + "|" + hint).split("|"))
    assert re.search(to_regex("mit license"), "x MIT\n--License.", re.A) and not re.search(to_regex("mit license"), "éMIT License")


def test_overlaps_are_resolved(spark):
    docs = spark.createDataFrame([(1, "Licensed under the Apache License, Version 2.0. See MIT License.")], "doc_id long, text string")
    r = scan_licenses(docs).first()
    assert [(d["label"], d["tier"]) for d in r["detections"]] == [("apache-2.0", 2), ("mit", 1)]
    assert r["base_labels"] == "apache,mit" and r["labels"] == "apache,apache-2.0,mit" and r["n_base"] == 2 and r["first_word"] == 3


def test_no_python_and_no_shuffle(spark):
    plan = scan_licenses(messy_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_awkward_rows(spark):
    messy = messy_documents(spark)
    out = scan_licenses(messy)
    assert out.count() == messy.count() and {"a.b", "key", "size", "detections"} <= set(out.columns)
    rows = out.collect()
    empty = [r for r in rows if not (r["text"] or "").strip()]
    assert len(empty) == 4 and all((r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0.0) for r in empty)
    assert [r["base_labels"] for r in rows if r["doc_id"] == 9] == ["mit"]
    assert scan_licenses(empty_documents(spark)).count() == 0


def phrases(parsed, optional):
    """Matches of a parsed pattern that take every alternative: all combinations of a short
    part, of a long one each alternative once beside the first of the others."""
    parts = []
    for op, arg in parsed:
        if op is _constants.LITERAL:
            parts.append([chr(arg)])
        elif op is _constants.IN:
            kind, first = arg[0]
            gap = (_constants.RANGE, (0, 0x2F)) in arg  # any character but a word character
            parts.append([" "] if gap else [chr(first[0] if kind is _constants.RANGE else first)])
        elif op is _constants.ANY:
            parts.append(["x"])
        elif op is _constants.BRANCH:
            parts.append([p for way in arg[1] for p in phrases(way, optional)])
        elif op is _constants.SUBPATTERN:
            parts.append(phrases(arg[3], optional))
        elif op in (_constants.MAX_REPEAT, _constants.MIN_REPEAT, _constants.POSSESSIVE_REPEAT):
            least, most, what = arg
            once = phrases(what, optional)
            filler = op is _constants.MIN_REPEAT  # between two gaps, which take all that they can
            parts.append([p * max(least, 1) for p in once] if least or filler else ["", *once] if optional and most == 1 else [""])
        elif op is _constants.ASSERT:
            parts.append([" " + p for p in phrases(arg[1], optional)])
        else:
            assert op is _constants.ASSERT_NOT, op
    if math.prod(map(len, parts)) <= 64:
        return ["".join(p) for p in product(*parts)]
    return ["".join(way if k == i else q[0] for k, q in enumerate(parts)) for i, p in enumerate(parts) for way in p]


def test_every_alternative_passes_the_gate(spark):
    table = rules()
    rows = []
    for k, (_, _, _, _, rx) in enumerate(table):
        parsed = _parser.parse(rx)
        found = dict.fromkeys(phrases(parsed, True) + phrases(parsed, False))
        rows += [(k, p) for p in found if re.search(rx, p, re.A)]  # what the rule finds without the gate
        assert rows[-1][0] == k
    rows += [(k, p) for k, p in enumerate(["under the Berkeley Software Distribution License", "Copyright C 2019", "Copyright [c] 2019"], len(table))]
    got = spark.createDataFrame(rows, "rule int, text string").withColumn("found", detect(F.col("text"))).collect()
    lost = [(table[r["rule"]][:4], r["text"]) for r in got if r["rule"] < len(table) and r["rule"] not in {d["rule"] for d in r["found"]}]
    assert len(rows) > 2 * len(table) and not lost
    labels = [{d["label"] for d in r["found"]} for r in got if r["rule"] >= len(table)]
    assert labels == [{"bsd"}, {"copyright"}, {"copyright"}]


def test_keywords_are_whole_words_of_every_match():
    for _, _, need, hint, rx in rules():
        assert whole_words(need, rx)
        parsed = _parser.parse(rx)
        for p in dict.fromkeys(phrases(parsed, True) + phrases(parsed, False)):
            found = re.search(rx, p, re.A)
            if found:
                words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", found.group().lower())
                for keys in (whole_words(need, rx), whole_words(hint, rx)):
                    assert not keys or any(w == k or k[-1] == "*" and w.startswith(k[:-1]) for w in words for k in keys), (p, keys)


def test_words_are_counted_and_keywords_kept_in_one_pass(spark):
    texts = {
        "Permit MIT, licensee": " mit licen", "unlicense xlicense Licence9": "unlicense  licen", "gnu.org GNUé égnu gnu_x": "gnu    gnu  ", "non-commercial NonCommercial": " commercial noncommercial",
        "": "", " \n": "", "éa\x00\U0001F600 cc0": "  cc0", "CC by": "cc ",
    }
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["marks"].lower() for r in scan_licenses(rows.withColumn("marks", _marks(F.col("text")))).collect()}
    # the word in front leaves a blank of its own
    assert {t: m.split() for t, m in got.items()} == {t: m.split() for t, m in texts.items()}
    n = {r["text"]: r["n_words"] for r in scan_licenses(rows).collect()}
    assert n == {t: brute(t)[0] for t in texts} == {t: m.count(" ") - 1 for t, m in got.items()}


def test_states_over_blocks(spark):
    sizes = (0, 1, 255, 256, 257, 512, 513, 1000)
    rows = spark.createDataFrame([([k * k % 7 for k in range(n)],) for n in sizes], "xs array<int>")
    got = rows.select("xs", _states(F.col("xs"), F.lit(0), lambda at, x: at + x).alias("sums")).collect()
    assert len(got) == len(sizes) and all(r["sums"] == list(accumulate(r["xs"])) for r in got)


def test_work_grows_with_the_detections_not_their_square(spark):
    n = 40_000
    docs = spark.range(1).select("id", F.repeat(F.lit("mit license, x "), F.col("id").cast("int") + n).alias("text"))
    began = time.monotonic()
    r = scan_licenses(docs).first()
    assert time.monotonic() - began < 40  # half as many took 49 s when each detection copied those before it
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["labels"]) == (3 * n, n, 0, 3 * n - 3, "mit")
    assert [(d["start"], d["end"]) for d in r["detections"]] == [(15 * k, 15 * k + 11) for k in range(n)]


def test_rules_run_by_neighbouring_keywords(spark):
    """What may stand together or apart is found both ways; every rule has phrases to look for first."""
    texts = [
        "noncommercial use only", "For non - commercial use only.", "Copyright ©2019", "copyright © 2019~2021", "Copyright (C) 1999", "CC-BY NC SA v4.0", "cc by nc sa v. 4.0",
        "Creative Commons Attribution-Non-Commercial-No Derivs", "creative commons attribution noncommercial noderivatives", "GPL v3", "gpl v-3.0+", "http://www.opensource.org/license/mit",
        "SPDX-License-Identifier: GPL-2.0-or-later+", "SPDX_LICENSE_IDENTIFIER PSF-2.0", "may not be reproduced in any form, without the prior express written consent", "©opyright c 2019",
        "You may not use this file except in compliance with the Licensed; see xApaches", "neither the name of A, B and C may be used to endorse or promote products",
        "public or software, license only later than either version; research for use only; commercial library business permission fee source licensed",
    ]
    got = {r["text"]: r for r in scan_licenses(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    for t in texts:
        kept = sorted((d["start"], d["end"], d["tier"], d["rule"], d["label"]) for d in got[t]["detections"])
        assert kept == brute(t)[-1], t
    assert [t for t in texts if not got[t]["detections"]] == [texts[15], texts[-1]]
    assert all(r["phrase"] for r in _rule_table()[0])


def test_scan_reads_texts_once(spark):
    """Words are counted and keywords found in one pass: substring tests are for phrases in the marks, texts make no word list."""
    plan = scan_licenses(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString().lower()
    assert plan.count("contains(") == 1 and "size(regexp_extract_all(text" not in plan and "from_json" not in plan
