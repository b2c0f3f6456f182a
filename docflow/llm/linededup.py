"""Line dedup: repeated runs of lines found by prefix doubling, later copies deleted.

All documents' non-blank lines, in order of documents, are one sequence of line ids. A
run of consecutive lines of one document that holds at least ``min_words`` words and
stands earlier in the sequence too is a later copy; every line inside such a run goes.
First copies and all other lines stay.

* Prefix doubling gives each place of the sequence its rank among all places by their
  next 1, 2, 4, ... lines (the suffix array to that depth): the ranks of a place and
  of the place that many lines on are a pair, and the sorted distinct pairs are
  numbered for the next depth. Only places whose run occurs more than once go on,
  and none is needed beyond the longest run below.
* A repeated run with enough words is the union of runs that would have too few
  without their first line or begin at the line asked about, at most ``min_words``
  lines long. Places that share such a run form an interval of the suffix array whose
  longest common prefix is at least the run; its key is the ranks of two overlapping
  powers of two. The least place of an interval is the first copy. One aggregation
  per depth finds it, so however many copies a line has, they meet as partial minima.
* Sorting uses range partitions, numbering the partition's own order: no single task
  sees a whole rank table. Every depth is written to the shared folder.

Lines compare by their words (white space between words doesn't count), with two hashes
of 64 bits, each over hashes of the words that are independent of the other's. Defined results: a null text counts as empty and stays null; blank lines stay;
rows of equal id and text are copies of one document and get the same result; rows
without id come last in the order of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.session import materialize

from .carry import free_name
from .wordhash import EXACT, doc_blocks, mix, text_buffer, word_places

MIN_WORDS = 50
_NEVER = np.iinfo(np.int64).max


def _sum_by(hashes: np.ndarray, first: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """One hash per run of words that begins at each of ``first``; ``place``: the word's place in its run."""
    weight = mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed)) | np.uint64(1)
    return mix(np.add.reduceat(hashes * weight, first))


def _read_lines(min_words: int):
    fields = [("h1", pa.int64()), ("h2", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("no", pa.int32())]

    def block(data, off):
        """Of a block of texts: lines per text, and of every non-blank line the columns of ``fields``."""
        (h, g), at = word_places(data, off, EXACT, kinds=2)
        breaks = np.flatnonzero(data[off[0] : off[-1]] == 10) + off[0]
        doc = np.searchsorted(off, at, side="right") - 1
        no = np.searchsorted(breaks, at) - np.searchsorted(breaks, off[:-1])[doc]
        if not len(h):
            return np.zeros(len(off) - 1, np.int64), [pa.array(np.zeros(0, np.int64)).cast(t) for _, t in fields]
        new = np.ones(len(h), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (no[1:] != no[:-1])
        first = np.flatnonzero(new)
        words = np.diff(np.append(first, len(h)))
        place = np.arange(len(h)) - np.repeat(first, words)
        doc, no = doc[first], no[first]
        end = np.searchsorted(doc, doc, side="right")  # one past the last line of the same text
        total = np.cumsum(words)
        line = np.arange(len(first))
        enough = np.searchsorted(total, total - words + min_words) + 1  # one past the shortest run with enough words
        enough = np.where(enough <= end, enough, _NEVER)
        after = np.append(enough[1:], _NEVER)
        longest = np.where(line + 1 == end, 0, np.where(after == _NEVER, end, after - 1) - line)
        lo = np.where(enough == _NEVER, 0, enough - line)
        hi = np.where(enough == _NEVER, 0, np.maximum(lo, longest))
        cols = [_sum_by(h, first, place, 1).view(np.int64), _sum_by(g, first, place, 0x5BD1E995).view(np.int64), lo, hi, no]
        return np.bincount(doc, minlength=len(off) - 1), [pa.array(c).cast(t) for c, (_, t) in zip(cols, fields, strict=True)]

    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column("text"))
            for a, z in doc_blocks(off):
                sizes, cols = block(data, off[a : z + 1])
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lines = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(cols, [n for n, _ in fields]))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[a:z], b.column("th")[a:z], lines], names=["doc_id", "th", "lines"])

    return run


def _sequence(docs: DataFrame, min_words: int) -> DataFrame:
    """``(at, room, doc_id, th, h1, h2, lo, hi, no)`` of every non-blank line: ``at`` its
    place in the sequence (consecutive within a document), ``room`` the lines of its
    document from it on, ``lo`` to ``hi`` the run lengths that are looked up from it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.mapInArrow(_read_lines(min_words), f"doc_id {kind}, th long, lines array<struct<h1:long,h2:long,lo:int,hi:int,no:int>>")
    stored = materialize(read.where(F.size("lines") > 0).dropDuplicates(["doc_id", "th"]), "lines")
    order = [F.col("doc_id").asc_nulls_last(), F.col("th")]
    rows = stored.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("doc_id", "th", F.size("lines").alias("n"), F.posexplode("lines").alias("k", "line"))
    return materialize(
        rows.select(F.monotonically_increasing_id().alias("at"), (F.col("n") - F.col("k")).alias("room"), "doc_id", "th", "line.*"), "sequence"
    )


def _ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` of the keys that occur more than once, with ``rank``: the key's place in sorted order."""
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*key)
    ranks = repeated.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("rank", F.monotonically_increasing_id())
    return rows.join(ranks, key).drop(*key)


def later_copies(sequence: DataFrame) -> DataFrame:
    """``(at, length, first)``: runs looked up that stand at an earlier place ``first`` too."""
    last = sequence.agg(F.max("hi").alias("hi")).first()["hi"] or 0
    places = materialize(_ranked(sequence.select("at", "room", "lo", "hi", "h1", "h2"), ["h1", "h2"]), "ranks")
    found, size = [], 1
    while True:
        lengths = F.sequence(F.greatest("lo", F.lit(size)), F.least("hi", F.lit(2 * size - 1)))
        asked = places.where((F.col("hi") >= size) & (F.col("lo") < 2 * size) & (F.col("lo") > 0))
        asked = asked.select("at", F.col("rank").alias("r1"), F.explode(lengths).alias("length"))
        ends = places.select((F.col("at") + size).alias("end"), F.col("rank").alias("r2"))
        runs = asked.join(ends, F.col("at") + F.col("length") == F.col("end")).select("at", "length", "r1", "r2")
        intervals = runs.groupBy("r1", "r2", "length").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
        intervals = materialize(intervals, "intervals")  # so that the join's two sides are shuffles whose hot parts can be split
        found.append(materialize(runs.join(intervals, ["r1", "r2", "length"]).where("at > first").select("at", "length", "first"), "copies"))
        if 2 * size > last:
            break
        on = places.select((F.col("at") - size).alias("at"), F.col("rank").alias("r2"))
        pairs = places.where(F.col("room") >= 2 * size).withColumnRenamed("rank", "r1").join(on, "at")
        places = materialize(_ranked(pairs, ["r1", "r2"]), "ranks")
        size *= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def deleted_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, th, deleted)``: of documents with later copies, the numbers (from 0) of
    the lines that go; ``th`` is the xxhash64 of the text."""
    sequence = _sequence(documents.select("doc_id", "text", F.xxhash64("text").alias("th")), min_words)
    copies = later_copies(sequence)
    # the runs of one place cover what the longest of them covers
    longest = copies.groupBy("at").agg(F.max("length").alias("length"))
    places = longest.select(F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("at")).distinct()
    return places.join(sequence.select("at", "doc_id", "th", "no"), "at").groupBy("doc_id", "th").agg(F.collect_list("no").alias("deleted"))


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``documents`` with ``text`` cut, plus ``n_lines`` (before) and
    ``n_deleted``. A document whose lines all go has no text left but blank lines."""
    of_id, of_text, numbers = (free_name(documents.columns, n) for n in ("of_id", "of_text", "numbers"))
    gone = deleted_lines(documents, min_words).select(F.col("doc_id").alias(of_id), F.col("th").alias(of_text), F.col("deleted").alias(numbers))
    keep = [F.col(f"`{c}`") for c in documents.columns if c not in ("text", "n_lines", "n_deleted")]
    joined = documents.join(gone, F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_text)), "left")
    lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
    cut = F.transform(F.array(lines), lambda ls: F.array_join(F.transform(stay, lambda i: ls[i]), "\n"))[0]
    count = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(1))
    return joined.select(
        *keep,
        F.when(F.col(numbers).isNull(), F.col("text")).otherwise(cut).alias("text"),
        count.cast("long").alias("n_lines"),
        F.coalesce(F.size(numbers), F.lit(0)).cast("long").alias("n_deleted"),
    )
