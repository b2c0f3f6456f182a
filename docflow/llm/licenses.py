"""License scans: ordered signature rules behind a keyword prefilter, all in DataFrame functions.

One pass over a text reads its words: it counts them and keeps those that are keywords of
rules. Only rules whose keywords a text holds, in phrases that every match contains, run
their regular expression. A detection is an interval of the text. Overlaps are resolved by
priority and containment: of detections ordered by start, length and tier, one that lies
inside another of its own or a higher tier is suppressed.

No shuffle, no Python on the executors: one narrow projection over the scan; what is
kept per document grows with its own detections only, and so does the work on them.

Defined results: a null text counts as empty (no words, no detections, empty labels,
score 0); repeated rows give repeated results; columns of the input that have a result
column's name are replaced.
"""

from __future__ import annotations

import json
import string
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .carry import free_name
from .license_rules import BASE, BESIDE, WORD_CHAR, signatures, telling_phrases, to_regex, whole_words

_SPAN = "array<struct<start:int,end:int>>"
_DETECTION = "array<struct<start:int,end:int,tier:int,rule:int,label:string>>"
_RULES = "array<struct<rule:int,label:string,tier:int,hint:array<string>,phrase:array<string>,regex:string>>"
#: Detections whose running states are kept in one array.
_BLOCK = 256

#: The rules' word and gap characters one by one: Java looks them up in a table, ranges it tries one after the other.
_ALNUM = string.digits + string.ascii_letters
_WORD = rf"[{_ALNUM}\x{{80}}-\x{{10FFFF}}]"
_GAP = "[" + "".join(rf"\x{i:02X}" for i in range(128) if chr(i) not in _ALNUM) + "]"
#: The same word character, shorter to compile, where only one is looked at.
_AT_WORD = r"[\p{Alnum}\x{80}-\x{10FFFF}]"


def _either_case(letters: list[str]) -> str:
    return "[" + "".join(sorted({x for c in letters for x in (c, c.upper())})) + "]"


def _any_of(words: set[str]) -> str:
    """A regular expression, by common beginnings, of whole words in any case; ``*`` at a word's end: any ending."""
    if "*" in words:
        return ""
    ways = [_either_case([c]) + _any_of({w[1:] for w in words if w[:1] == c}) for c in sorted({w[0] for w in words if w})]
    ways += [f"(?!{_AT_WORD})"] if "" in words else []
    return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")"


def _keyword(words: set[str]) -> str:
    """:func:`_any_of` by thirds of the first characters, so that most words fail early."""
    firsts = sorted({w[0] for w in words})
    thirds = [firsts[k::3] for k in range(3) if firsts[k::3]]
    return "|".join(f"(?={_either_case(x)}){_any_of({w for w in words if w[0] in x})}" for x in thirds)


@cache
def _rule_table() -> tuple[list[dict], dict[str, list[int]], set[str]]:
    """The rules, best first, base phrases last; by each word of a rule's ``need`` the numbers of such rules; all keywords."""
    table = signatures()
    table += [(label, 0, "cc" if phrase.startswith("cc") else "licen", phrase.split(" ")[0], phrase, phrase) for phrase, label in BASE]
    rows, by_need, keywords = [], {}, {*BESIDE}
    for k, (label, tier, need, hint, pattern, _) in enumerate(table):
        regex = to_regex(pattern)
        needs, hints = whole_words(need, regex), whole_words(hint, regex)
        keywords |= {*needs, *hints}
        for word in needs:
            by_need.setdefault(word.rstrip("*"), []).append(k)
        rows.append({"rule": k, "label": label, "tier": tier, "hint": [w.rstrip("*") for w in hints], "regex": regex.replace(WORD_CHAR, _AT_WORD)})
    for row, (*_, core) in zip(rows, table, strict=True):
        row["phrase"] = [f" {x} " for x in telling_phrases(core, keywords)]
    return rows, by_need, keywords


def _literal(value: list | dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def _n_words(text: Column) -> Column:
    # a word in front takes the gap at the beginning, and isn't counted
    return (F.length(F.regexp_replace(F.concat(F.lit("x "), text), f"{_WORD}+{_GAP}*", " ")) - 1).cast("long")


def _marks(text: Column) -> Column:
    """The words of ``x`` and a text, each shortened: a keyword and a blank, or a blank only."""
    keyword = _keyword(_rule_table()[2])
    return F.regexp_replace(F.concat(F.lit("x "), text), f"(?:({keyword}){_WORD}*|{_WORD}+){_GAP}*", "$1 ")


def _bind(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, with the value computed once (a lambda's variable)."""
    return F.transform(F.array(value), of)[0]


def _states(items: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state after each item. Arrays grow by copying, so a block's states are
    kept in an array of their own, begun with the state at the end of the block before."""

    def of_items(xs: Column) -> Column:
        block = lambda b: F.slice(xs, b * _BLOCK + 1, F.lit(_BLOCK))
        more = F.greatest(F.ceil((F.size(xs) - _BLOCK) / F.lit(_BLOCK)), F.lit(0)).cast("int")
        blocks = F.slice(F.sequence(F.lit(0), more), F.lit(1), more)
        begins = F.aggregate(blocks, F.array(zero), lambda acc, b: F.concat(acc, F.array(F.aggregate(block(b), F.element_at(acc, -1), step))))
        grow = lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x)))
        return F.flatten(F.transform(begins, lambda begin, b: F.slice(F.aggregate(block(b), F.array(begin), grow), F.lit(2), F.lit(_BLOCK))))

    return _bind(items, of_items)


def _spans(text: Column, regex: Column, found: Column) -> Column:
    """Start and end (characters) of every match: the pieces between matches and the matches give the offsets."""
    pairs = F.zip_with(F.slice(F.split(text, regex, -1), F.lit(1), F.size(found)), found, lambda b, f: F.struct(F.length(b).alias("between"), F.length(f).alias("found")))

    def of_pairs(xs: Column) -> Column:
        ends = _states(xs, F.lit(0), lambda at, x: at + x["between"] + x["found"])
        return F.zip_with(xs, ends, lambda x, end: F.struct((end - x["found"]).alias("start"), end.alias("end")))

    return _bind(pairs, of_pairs)


def _detections(text: Column, marks: Column) -> Column:
    table, by_need, _ = _rule_table()
    table, by_need = _literal(table, _RULES), _literal(by_need, "map<string,array<int>>")

    def of_text(t: Column, low: Column, words: Column) -> Column:
        numbers = F.flatten(F.filter(F.transform(words, lambda w: F.try_element_at(by_need, w)), F.isnotnull))
        candidates = F.transform(F.array_sort(F.array_distinct(numbers)), lambda k: F.get(table, k))
        run = F.filter(candidates, lambda r: ((F.size(r["hint"]) == 0) | F.arrays_overlap(r["hint"], words)) & ((F.size(r["phrase"]) == 0) | F.exists(r["phrase"], lambda p: F.contains(low, p))))
        tried = F.transform(run, lambda r: F.struct(r.alias("r"), F.regexp_extract_all(t, r["regex"], F.lit(0)).alias("found")))
        spans = F.transform(
            F.filter(tried, lambda x: F.size(x["found"]) > 0),
            lambda x: F.transform(
                _spans(t, x["r"]["regex"], x["found"]),
                lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), x["r"]["tier"].alias("tier"), x["r"]["rule"].alias("rule"), x["r"]["label"].alias("label")),
            ),
        )
        return F.flatten(spans)

    words = F.array_distinct(F.split(F.lower(F.trim(marks)), " +"))
    found = _bind(F.struct(text.alias("t"), F.lower(marks).alias("low"), words.alias("words")), lambda x: of_text(x["t"], x["low"], x["words"]))
    return F.when(F.trim(marks) != "", found).otherwise(F.array().cast(_DETECTION))


def detect(text: Column) -> Column:
    """All detections of a text before suppression: array of (start, end, tier, rule, label); tier 0 marks base phrases."""
    return _bind(F.struct(text.alias("t"), _marks(text).alias("marks")), lambda x: _detections(x["t"], x["marks"]))


def resolve(detections: Column) -> Column:
    """Detections of tiers 1 to 4 that no other of their own or a higher tier contains.

    In order of start (the longer, the higher tier and the earlier rule first) a
    detection is contained in an earlier one exactly if one of its own or a
    higher tier ends no sooner, so one running maximum per tier decides."""
    ordered = F.array_sort(
        F.transform(
            F.filter(detections, lambda d: d["tier"] > 0),
            lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("e"), (-d["tier"]).alias("t"), d["rule"].alias("rule"), d["label"].alias("label")),
        )
    )
    tiers = (1, 2, 3, 4)

    def step(acc: Column, d: Column) -> Column:
        end, tier = -d["e"], -d["t"]
        inside = F.greatest(*[F.when(tier <= t, acc[f"m{t}"]).otherwise(F.lit(-1)) for t in tiers]) >= end
        grown = [F.when(tier == t, F.greatest(acc[f"m{t}"], end)).otherwise(acc[f"m{t}"]).alias(f"m{t}") for t in tiers]
        return F.struct(*grown, inside.alias("inside"))

    def outermost(ds: Column) -> Column:
        states = _states(ds, F.struct(*[F.lit(-1).alias(f"m{t}") for t in tiers], F.lit(False).alias("inside")), step)
        both = F.zip_with(ds, states, lambda d, s: F.struct(d.alias("d"), s["inside"].alias("inside")))
        kept = lambda d: F.struct(d["start"].alias("start"), (-d["e"]).alias("end"), (-d["t"]).alias("tier"), d["rule"].alias("rule"), d["label"].alias("label"))
        return F.transform(F.filter(both, lambda x: ~x["inside"]), lambda x: kept(x["d"]))

    return F.when(F.size(detections) > 0, _bind(ordered, outermost)).otherwise(F.array().cast(_DETECTION))


def scan_licenses(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``documents`` plus ``detections`` (resolved: start, end in characters, tier, rule,
    label), ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` (a quarter of the best tier kept; a base phrase counts as tier 1)."""
    new = ["detections", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    keep = [F.col(f"`{c}`") for c in documents.columns if c not in new]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text_of, marks_of, found_in, base_of = (free_name([*documents.columns, *new], n) for n in ("text_of", "marks_of", "found_in", "base_of"))
    marked = documents.select(*keep, text.alias(text_of), _marks(text).alias(marks_of))
    n_words = (F.length(marks_of) - F.length(F.replace(F.col(marks_of), F.lit(" "), F.lit(""))) - 1).cast("long")
    found = marked.select(*keep, text_of, n_words.alias("n_words"), _detections(F.col(text_of), F.col(marks_of)).alias(found_in))
    base = F.filter(found_in, lambda d: d["tier"] == 0)
    resolved = found.select(*keep, text_of, "n_words", base.alias(base_of), resolve(F.col(found_in)).alias("detections"))
    before = lambda place: F.when(F.size(base_of) > 0, _n_words(F.substr(F.col(text_of), F.lit(1), place(F.transform(base_of, lambda d: d["start"])))))
    names = lambda xs: F.array_join(F.array_sort(F.array_distinct(xs)), ",")
    base_labels = F.transform(base_of, lambda d: d["label"])
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["tier"])), F.lit(0))
    return resolved.select(
        *keep,
        "detections",
        "n_words",
        F.size(base_of).cast("long").alias("n_base"),
        before(F.array_min).alias("first_word"),
        before(F.array_max).alias("last_word"),
        names(base_labels).alias("base_labels"),
        names(F.concat(base_labels, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        (F.greatest(best, F.least(F.size(base_of), F.lit(1))) / 4.0).alias("score"),
    )
