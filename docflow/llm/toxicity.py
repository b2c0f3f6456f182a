"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words (letters, digits, non-ASCII; A-Z lower-cased), pairs
of neighbours and pairs with one word between, hashed into ``2**bits`` coordinates
and counted once each. FTRL-proximal keeps one learning rate per coordinate; its L1
term leaves most weights at zero, so the model is a short list of (coordinate,
weight) that is broadcast to the tasks that score.

Fitting reads at most ``max_rows`` labelled documents (the smallest hashes of their
ids: the same ones however the table is partitioned), turns them into coordinates
where they lie (of a text with more than ``max_coordinates`` those of smallest hash with
its id, a sample of its features) and learns in one task, whose input the
two bounds limit. Scoring is
one narrow pass over whole texts of all documents.

Defined results: a null text counts as empty; an empty text has the score of the
bias alone; documents without id are scored but never learnt from; several labels
of a document count as toxic if one is; of several rows of a labelled id the text of
the smallest hash is learnt from; without labelled rows every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .carry import map_rows
from .wordhash import doc_blocks, mix, text_buffer, word_hashes


@dataclass(frozen=True)
class FtrlParams:
    """``alpha``, ``beta``: per-coordinate rates; ``l1``, ``l2``: penalties;
    ``bits``: log2 of the coordinates; ``epochs``: passes over the sample;
    ``max_rows``: bound of the labelled sample the model is fitted on;
    ``max_coordinates``: of a sampled document with more, those of smallest hash with
    its id are learnt from (scores use all), so the two bounds limit the learning task's memory
    (512 MB of coordinates)."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    bits: int = 20
    epochs: int = 6
    max_rows: int = 16_384
    max_coordinates: int = 1 << 13


#: Multipliers that tell a word, a pair and a skipping pair apart.
_UNI, _LEFT, _NEXT, _SKIP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def coordinates(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, document number) of every word, pair and skipping pair."""
    h, d = word_hashes(data, offsets)
    left = h * _LEFT
    pair, skip = d[1:] == d[:-1], d[2:] == d[:-2]
    feats = [mix(h * _UNI), mix(left[:-1] + h[1:] * _NEXT)[pair], mix(left[:-2] + h[2:] * _SKIP)[skip]]
    idx = np.concatenate(feats) >> np.uint64(64 - bits)
    return idx.astype(np.int64), np.concatenate([d, d[:-1][pair], d[:-2][skip]])


def _spread_subset(key: np.ndarray, bits: int, most: int, salt: np.ndarray) -> np.ndarray:
    """``key`` (document and coordinate, ascending) with, of every document that has more,
    the ``most`` coordinates of smallest hash with the document's ``salt``: each document
    leaves out others."""
    counts = np.bincount(key >> bits)
    if counts.max(initial=0) <= most:
        return key
    order = np.lexsort((mix((key & ((1 << bits) - 1)).astype(np.uint64) + salt[key >> bits]), key >> bits))
    place = np.arange(len(key)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(key[order][place < most])


def _to_coordinates(bits: int, most: int):
    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column("text"))
            salt = mix(b.column("ord").to_numpy().view(np.uint64))
            for first, last in doc_blocks(off):
                idx, doc = coordinates(data, off[first : last + 1], bits)
                key = _spread_subset(np.unique((doc << bits) | idx), bits, most, salt[first:last])
                counts = np.bincount(key >> bits, minlength=last - first)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = pa.array((key & ((1 << bits) - 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("ord")[first:last], b.column("label")[first:last], pa.ListArray.from_arrays(ends, values)],
                    names=["ord", "label", "idx"],
                )

    return run


def ftrl(rows: list[tuple[np.ndarray, int]], p: FtrlParams) -> tuple[np.ndarray, np.ndarray, float]:
    """Learns from (coordinates, label) pairs; (coordinate, weight) of the non-zero weights, and the bias."""
    size = (1 << p.bits) + 1  # the last coordinate is the bias, without L1
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.Generator(np.random.PCG64(7))

    def weights(zi, ni, bias_at):
        w = -(zi - np.sign(zi) * p.l1) / ((p.beta + np.sqrt(ni)) / p.alpha + p.l2)
        w[np.abs(zi) <= p.l1] = 0.0
        if bias_at is not None:
            w[bias_at] = -zi[bias_at] / ((p.beta + np.sqrt(ni[bias_at])) / p.alpha)
        return w

    for _ in range(p.epochs):
        for k in order.permutation(len(rows)):
            idx, y = rows[k]
            at = np.append(idx, size - 1)
            zi, ni = z[at], n[at]
            w = weights(zi, ni, len(at) - 1)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            root = np.sqrt(ni + g * g)
            z[at] = zi + g - (root - np.sqrt(ni)) / p.alpha * w
            n[at] = ni + g * g
    w = weights(z, n, size - 1)
    keep = np.flatnonzero(w[:-1])
    return keep, w[keep], float(w[-1])


def fit(documents: DataFrame, labels: DataFrame, params: FtrlParams = FtrlParams()) -> DataFrame:
    """The model as rows ``(idx, weight)``; ``idx`` -1 is the bias. ``documents``
    holds ``doc_id, text``, ``labels`` holds ``doc_id, toxic``."""
    spread = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .select(F.col("doc_id").alias("label_id"), "label", spread.alias("ord"))
    )
    # at most max_rows of them: a share by hash first, so that the exact cut handles few rows
    total = known.count()
    if total > params.max_rows:
        share = (1 << 64) * 11 * params.max_rows // (10 * total) - (1 << 63)
        known = known.where(F.col("ord") <= min(share, (1 << 63) - 1)).orderBy("ord", "label_id").limit(params.max_rows)
    # one row of an id, so that max_rows bounds documents too; copies meet as one of each task
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
        .groupBy("label_id", "ord", "label")
        .agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text")).alias("row"))
        .select("ord", "label", "row.text")
        .mapInArrow(_to_coordinates(params.bits, params.max_coordinates), "ord long, label int, idx array<int>")
    )

    def learn(batches):
        seen = []
        for b in batches:
            ends, flat = b.column("idx").offsets.to_numpy(), b.column("idx").values.to_numpy()
            for i, (o, y) in enumerate(zip(b.column("ord").to_pylist(), b.column("label").to_pylist(), strict=True)):
                seen.append((o, y, flat[ends[i] : ends[i + 1]].copy()))
        seen.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))  # the same order however rows arrive
        idx, w, bias = ftrl([(c, y) for _, y, c in seen], params)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(idx, -1), pa.int64()), pa.array(np.append(w, bias), pa.float64())], names=["idx", "weight"]
        )

    return rows.repartition(1).mapInArrow(learn, "idx long, weight double")


def score(documents: DataFrame, model: DataFrame, text_col: str = "text", bits: int = FtrlParams.bits) -> DataFrame:
    """``documents`` plus ``score`` (0 to 1). The model has at most ``2**bits + 1``
    rows (a few thousand after L1), whatever the corpus; it travels with the task."""
    learnt = model.toPandas()
    bias = float(learnt.loc[learnt.idx == -1, "weight"].sum())
    learnt = learnt[learnt.idx >= 0]
    share = documents.sparkSession.sparkContext.broadcast(
        (learnt.idx.to_numpy(np.int64), learnt.weight.to_numpy(np.float64))
    )

    def run(batches):
        at, w = share.value
        dense = np.zeros(1 << bits)
        dense[at] = w
        for b in batches:
            data, off = text_buffer(b.column("row").field(text_col))
            out = np.full(b.num_rows, bias)
            for first, last in doc_blocks(off):
                idx, doc = coordinates(data, off[first : last + 1], bits)
                hit = dense[idx] != 0
                key = np.unique((doc[hit] << bits) | idx[hit])
                out[first:last] += np.bincount(key >> bits, dense[key & ((1 << bits) - 1)], last - first)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(1 / (1 + np.exp(-np.clip(out, -500, 500))))], names=["row", "score"])

    return map_rows(documents, run, [("score", T.DoubleType())])


def remainder_of_three(doc_id) -> F.Column:
    """crc32 of the id's text, modulo 3 (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def toxicity(documents: DataFrame, labels: DataFrame, params: FtrlParams = FtrlParams(), threshold: float = 0.7) -> DataFrame:
    """All columns of ``documents`` plus ``held_out``, ``score``, ``predicted``.
    Learns only from documents whose id's remainder is not 1."""
    train = labels.select("doc_id", "toxic").where(remainder_of_three(F.col("doc_id")) != 1)
    model = fit(documents, train, params)
    scored = score(documents, model, bits=params.bits)
    return scored.select(
        *[F.col(f"`{c}`") for c in scored.columns if c not in ("held_out", "predicted", "score")],
        F.coalesce(remainder_of_three(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        F.col("score"),
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
