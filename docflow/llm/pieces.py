"""SentencePiece pieces: n-best segmentation of texts, and decoding.

A text (spaces as U+2581, one in front) is segmented over the lattice of the model's
pieces; a character that is no piece takes its UTF-8 bytes' pieces. A segmentation
scores the sum of its pieces.

* Forward Viterbi gives every place of the lattice the score of the best way there.
* The n best come from an A-star search backwards from the end, whose estimate for the
  rest of the way is that forward score, hence exact: complete segmentations leave the
  queue in order of score, and only as many partial ones are opened as they need.
* No piece of the model crosses certain neighbours (before a space mark that follows
  another character; around line ends), which is verified when the model is read. All
  ways pass through those places, so a text's lattice is a chain of small ones. A
  document's n best deviate from the best way in its n-1 links of least loss only
  (ties: the earlier); each link's own n best are searched when it is one of those.

Per document the work is linear in its length. The texts of a piece of the input are cut
into links together; each distinct link goes through its lattice once, links of one
length side by side in arrays, and a text's ids are gathered from its links'.

The scores are the model's own. In a model of merges (such as the 32k one) they are the
ranks of the merges, not log-probabilities: the best segmentation by their sum is not the
library's, which merges greedily (README gives the figure).

Defined results: a null or empty text has one segmentation, of no pieces; a text with
fewer than n segmentations has that many; ties are in the order in which the search
completes, which depends on the text alone (longer last piece first; within a document
fewer, then earlier deviations); repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .carry import map_rows
from .wordhash import doc_blocks, text_buffer

MARK = "▁"
#: Searches of links that a process keeps, and the longest link whose search it keeps.
KEPT_SEARCHES, KEPT_LENGTH = 15_000, 32
#: Links of up to this many characters go through their lattices together.
TOGETHER = 24
#: Text that is segmented at once (a longer text alone).
PIECE = 1 << 20
_SPREAD, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1


def read_model(path: str) -> dict:
    """The pieces of a model file as plain values: what the driver sends to the tasks."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    of_byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
    return {"pieces": pieces, "bytes": of_byte, "unknown": sp.unk_id()}


class Pieces:
    def __init__(self, model: dict):
        self.scores = model["pieces"]
        self.single = {p for p in model["pieces"] if len(p) == 1}
        least = min((s for p, (_, s) in model["pieces"].items() if p.strip(MARK)), default=0.0)  # runs of spaces score far lower
        self.byte_score = least - 10.0
        self.of_byte, self.unknown = model["bytes"], model["unknown"]
        inner = any(MARK in p.lstrip(MARK) for p in model["pieces"])
        lines = any("\n" in p and len(p) > 1 for p in model["pieces"])
        self.links_of = re.compile(r"(?s).+" if inner else f"{MARK}+[^{MARK}]*|[^{MARK}]+" if lines else f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n").findall
        self.searched: dict[tuple, list] = {}
        raw = {i: p.replace(MARK, " ").encode() for p, (i, _) in model["pieces"].items()} | {i: bytes([b]) for b, i in self.of_byte.items()}
        table = [raw.get(i, b"") for i in range(max(raw, default=0) + 2)]  # the last stands for ids out of range
        self.bytes_of = np.frombuffer(b"".join(table), np.uint8)
        self.sizes = np.array([len(x) for x in table], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes

    @cached_property
    def root(self) -> dict:
        """A trie: character to [next characters, id or None, score]. Processes that only decode never build it."""
        root: dict = {}
        for piece, (i, score) in self.scores.items():
            children = root
            for c in piece:
                node = children.setdefault(c, [{}, None, 0.0])
                children = node[0]
            node[1:] = i, score
        return root

    def lattice(self, s: str):
        """Forward scores, and per place the arcs that end there: (begin, ids, score), longer ones first."""
        n = len(s)
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        into: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            here, children = best[i], self.root
            for j in range(i, n):
                node = children.get(s[j])
                if node is None:
                    break
                children, piece, score = node
                if piece is not None:
                    into[j + 1].append((i, (piece,), score))
                    if here + score > best[j + 1]:
                        best[j + 1] = here + score
            if s[i] not in self.single:
                raw = s[i].encode()
                ids = tuple(self.of_byte.get(b, self.unknown) for b in raw)
                score = self.byte_score * len(raw)
                into[i + 1].append((i, ids, score))
                if here + score > best[i + 1]:
                    best[i + 1] = here + score
        return best, into

    @cached_property
    def table(self) -> tuple[np.ndarray, ...]:
        """The trie as arrays, for many links at once: a hash table from (node, character)
        to the next node (linear probing), and per node its piece's id (-1: none) and score."""
        edges, ids, scores, todo = [], [-1], [0.0], [(0, self.root)]
        while todo:
            number, children = todo.pop()
            for c, (below, piece, score) in children.items():
                edges.append((number << 21 | ord(c), len(ids)))
                todo.append((len(ids), below))
                ids.append(-1 if piece is None else piece)
                scores.append(score)
        bits = max(4, (4 * len(edges)).bit_length())
        keys, to = np.full((1 << bits) + 64, -1, np.int64), np.zeros((1 << bits) + 64, np.int32)
        farthest = 0
        for key, node in edges:
            first = at = (key * _SPREAD & _WORD) >> (64 - bits)
            while keys[at] != -1:
                at += 1
            keys[at], to[at], farthest = key, node, max(farthest, at - first)
        return keys, to, np.array(ids, np.int32), np.array(scores), np.int64(64 - bits), farthest + 1

    def _step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The nodes after ``node`` and characters ``code``, -1 where there is none."""
        keys, to, _, _, shift, probes = self.table
        key = node << 21 | code
        at = ((key.view(np.uint64) * np.uint64(_SPREAD)) >> shift.view(np.uint64)).view(np.int64)
        held = keys[at]
        out = np.where(held == key, to[at], -1)
        open_ = np.flatnonzero((held != key) & (held != -1))
        for _ in range(probes - 1):
            if not len(open_):
                break
            at[open_] += 1
            held = keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = to[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    def _best_of_length(self, links: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`_best` of many links of one length: all ids in order of the links, and
        per link their number, its score and its loss."""
        n = len(links)
        codes = np.frombuffer("".join(links).encode("utf-32-le"), np.int32).reshape(n, size).astype(np.int64)
        _, _, ids, scores, _, _ = self.table
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0.0
        second = np.full((size + 1, n), -np.inf)  # the best arc into a place that isn't the way's
        begin, piece_at = np.zeros((size + 1, n), np.int32), np.zeros((size + 1, n), np.int32)

        def arc(j: int, i: int, rows: np.ndarray, score: np.ndarray, piece: np.ndarray | int) -> None:
            known = best[j, rows]
            better = score > known
            second[j, rows] = np.where(better, known, np.maximum(second[j, rows], score))
            won = rows[better]
            best[j, won], begin[j, won] = score[better], i
            piece_at[j, won] = piece[better] if isinstance(piece, np.ndarray) else piece

        for i in range(size):
            rows, node, single = np.arange(n), np.zeros(n, np.int64), np.zeros(n, bool)
            for j in range(i + 1, size + 1):
                node = self._step(node, codes[rows, j - 1]).astype(np.int64)
                rows, node = rows[node >= 0], node[node >= 0]
                if not len(rows):
                    break
                ends = ids[node] >= 0
                if j == i + 1:
                    single[rows[ends]] = True
                if ends.any():
                    arc(j, i, rows[ends], best[i, rows[ends]] + scores[node[ends]], ids[node[ends]])
            rest = np.flatnonzero(~single)
            if len(rest):
                raw = np.array([len(links[r][i].encode()) for r in rest.tolist()])
                arc(i + 1, i, rest, best[i, rest] + self.byte_score * raw, -1)
        with np.errstate(invalid="ignore"):
            loss = best - second
        at, least, parts, rows = np.full(n, size), np.full(n, np.inf), [], np.arange(n)
        while len(rows):
            here = at[rows]
            least[rows] = np.minimum(least[rows], loss[here, rows])
            parts.append((rows, piece_at[here, rows], begin[here, rows]))
            at[rows] = begin[here, rows]
            rows = rows[at[rows] > 0]
        rows, pieces, starts = (np.concatenate(x[::-1]) for x in zip(*parts, strict=True))
        order = np.argsort(rows, kind="stable")  # a link's pieces one after another
        rows, pieces, starts = rows[order], pieces[order], starts[order]
        raw = np.flatnonzero(pieces < 0)
        if len(raw):  # a character's bytes in place of its piece
            held = [[self.of_byte.get(b, self.unknown) for b in links[rows[k]][starts[k]].encode()] for k in raw.tolist()]
            wide = np.ones(len(pieces), np.int64)
            wide[raw] = [len(x) for x in held]
            rows, pieces, to = np.repeat(rows, wide), np.repeat(pieces, wide), np.cumsum(wide)
            for k, x in zip(raw.tolist(), held, strict=True):
                pieces[to[k] - len(x) : to[k]] = x
        return pieces, np.bincount(rows, minlength=n), best[size], least

    def best_of(self, links: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct links: ids, in which each link's ``size`` ones of the best way begin at
        its ``place``, the scores, and what the second best ways lose. Links of one length go
        through their lattices together."""
        n = len(links)
        flat, done = [], 0
        place, size, scores, losses = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        lengths = np.fromiter(map(len, links), np.int64, n)
        by_length = np.argsort(lengths, kind="stable")
        for mine in np.split(by_length, np.flatnonzero(np.diff(lengths[by_length])) + 1) if n else ():
            length = int(lengths[mine[0]])
            if length > TOGETHER or len(mine) < 8:
                found = [self._best(links[k]) for k in mine.tolist()]
                ids = np.concatenate([np.frombuffer(raw, np.int32) for raw, _, _ in found])
                size[mine] = [len(raw) // 4 for raw, _, _ in found]
                scores[mine], losses[mine] = [x for _, x, _ in found], [x for _, _, x in found]
            else:
                ids, size[mine], scores[mine], losses[mine] = self._best_of_length([links[k] for k in mine.tolist()], length)
            place[mine] = done + np.cumsum(size[mine]) - size[mine]
            flat.append(ids)
            done += len(ids)
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), place, size, scores, losses

    def _best(self, s: str) -> tuple[bytes, float, float]:
        """One link's best ids, their score, and what the second best way loses."""
        n, root, single = len(s), self.root, self.single
        best = [0.0] + [-math.inf] * n
        loss = [math.inf] * (n + 1)  # per place: what the best arc into it that isn't the way's loses
        begin, piece_at = [0] * (n + 1), [None] * (n + 1)
        for i in range(n):
            here, children, j = best[i], root, i
            for c in s[i:]:
                node = children.get(c)
                if node is None:
                    break
                children, piece, score = node
                j += 1
                if piece is not None:
                    score += here
                    known = best[j]
                    if score > known:  # the way so far loses that much now, and what lost to it more
                        loss[j], best[j], begin[j], piece_at[j] = score - known, score, i, piece
                    elif known - score < loss[j]:
                        loss[j] = known - score
            if s[i] not in single:
                raw = s[i].encode()
                score, known = here + self.byte_score * len(raw), best[i + 1]
                if score > known:
                    loss[i + 1], best[i + 1], begin[i + 1] = score - known, score, i
                    piece_at[i + 1] = tuple(self.of_byte.get(b, self.unknown) for b in raw)
                elif known - score < loss[i + 1]:
                    loss[i + 1] = known - score
        at, ids, least = n, [], math.inf
        while at:
            if loss[at] < least:
                least = loss[at]
            piece = piece_at[at]
            if type(piece) is int:
                ids.append(piece)
            else:
                ids.extend(reversed(piece))
            at = begin[at]
        ids.reverse()
        return array("i", ids).tobytes(), best[n], least

    def n_best(self, s: str, n: int) -> list[tuple[float, tuple]]:
        """The ``n`` best (score, ids) of one lattice."""
        known = self.searched.get((s, n))
        if known is None:
            known = self._search(s, n)
            if len(s) <= KEPT_LENGTH:
                if len(self.searched) >= KEPT_SEARCHES:
                    self.searched.clear()
                self.searched[s, n] = known
        return known

    def _search(self, s: str, n: int) -> list[tuple[float, tuple]]:
        best, into = self.lattice(s)
        queue = [(-best[len(s)], 0, len(s), 0.0, None)]
        out, opened = [], 0
        while queue and len(out) < n:
            estimate, _, at, score, path = heapq.heappop(queue)
            if at == 0:
                ids = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                out.append((-estimate, tuple(ids)))
                continue
            for i, arc, add in reversed(into[at]):
                opened -= 1  # of equal estimates the newest first
                heapq.heappush(queue, (-(best[i] + add + score), opened, i, add + score, (arc, path)))
        return out

    def segment(self, text: str, n: int) -> list[tuple[float, np.ndarray]]:
        """The ``n`` best (score, ids) of a text."""
        return next(self.segment_all([text], n))

    def segment_all(self, texts: list[str], n: int):
        """Of every text the ``n`` best (score, ids). A link that stands more than once in the
        texts goes through its lattice once; ids are gathered from the distinct links'."""
        links, ends = [], []
        for text in texts:
            if text:
                links += self.links_of(MARK + text.replace(" ", MARK))
            ends.append(len(links))
        number = {link: k for k, link in enumerate(dict.fromkeys(links))}
        known = list(number)
        flat, places, sizes, best, lose = self.best_of(known)
        at = np.fromiter(map(number.__getitem__, links), np.int64, len(links))
        first = 0
        for end in ends:
            mine = at[first:end]
            first = end
            count = sizes[mine]
            to = np.cumsum(count)
            ids = flat[np.repeat(places[mine] - to + count, count) + np.arange(to[-1] if len(to) else 0)]
            yield self._deviations(ids, to, count, best[mine], lose[mine], mine, known, n)

    def _deviations(self, ids, to, count, scores, losses, mine, known: list[str], n: int) -> list[tuple[float, np.ndarray]]:
        """The ``n`` best of a text whose links' best ways are ``ids``: they deviate from
        those in the n-1 links of least loss only."""
        total = float(scores.sum())
        width = min(n - 1, int(np.isfinite(losses).sum()))
        ways: list[tuple] = [(0.0, 0, ())]
        if width:
            limit = np.partition(losses, width - 1)[width - 1]
            near = np.flatnonzero(losses <= limit)
            for k in near[np.argsort(losses[near], kind="stable")][:width].tolist():
                others = self.n_best(known[mine[k]], n)[1:]
                more = [(loss + float(scores[k]) - score, times + 1, (*where, (k, arc))) for loss, times, where in ways for score, arc in others]
                ways = heapq.nsmallest(n, ways + more, key=lambda w: (w[0], w[1], sorted(w[2])))
        out = []
        for loss, _, where in ways:
            parts, done = [], 0
            for k, arc in sorted(where):
                parts += [ids[done : to[k] - count[k]], np.array(arc, np.int32)]
                done = to[k]
            out.append((total - loss, np.concatenate([*parts, ids[done:]]) if parts else ids))
        return out

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of several lists of ids, one after another in ``ids``, list i up to ``ends[i]``."""
        known = np.where((ids >= 0) & (ids < len(self.sizes)), ids, len(self.sizes) - 1)
        sizes = self.sizes[known]
        to = np.cumsum(sizes)
        raw = self.bytes_of[np.repeat(self.places[known] - to + sizes, sizes) + np.arange(to[-1] if len(to) else 0)].tobytes()
        out, at = [], 0
        for end in ends.tolist():
            stop = int(to[end - 1]) if end else 0
            text = raw[at:stop].decode("utf-8", errors="replace")
            out.append(text[1:] if text.startswith(" ") else text)
            at = stop
        return out

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return self.decode_all(ids, np.array([len(ids)]))[0]


_READY: list = []


def _pieces(shared) -> Pieces:
    """One per process and broadcast model."""
    if not _READY or _READY[0] != shared.id:
        _READY[:] = [shared.id, Pieces(shared.value)]
    return _READY[1]


class _Shared:
    """A broadcast model with a name that the processes can compare."""

    def __init__(self, spark, model: dict, path: str):
        self.broadcast, self.id = spark.sparkContext.broadcast(model), path

    @property
    def value(self) -> dict:
        return self.broadcast.value


def encode(documents: DataFrame, model: str, n: int = 3, text_col: str = "text") -> DataFrame:
    """Columns of ``documents`` without the text, plus ``rank`` (from 1), ``score`` and ``ids``: the ``n`` best segmentations of every text."""
    shared = _Shared(documents.sparkSession, read_model(model), model)

    def run(batches):
        pieces = _pieces(shared)
        for b in batches:
            for start, stop in doc_blocks(text_buffer(b.column("text"))[1], PIECE):
                part = b.slice(start, stop - start)
                take, rank, score, ids = [], [], [], []
                texts = [text or "" for text in part.column("text").to_pylist()]
                for k, ways in enumerate(pieces.segment_all(texts, n)):
                    for r, (points, found) in enumerate(ways, 1):
                        take.append(k)
                        rank.append(r)
                        score.append(points)
                        ids.append(found)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                cols = [part.column("row").take(pa.array(take, pa.int64())), pa.array(rank, pa.int32()), pa.array(score, pa.float64()), lists]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "rank", "score", "ids"])

    new = [("rank", T.IntegerType()), ("score", T.DoubleType()), ("ids", T.ArrayType(T.IntegerType()))]
    return map_rows(documents, run, new, drop=(text_col,), text=F.col(f"`{text_col}`").cast("string"))


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``text`` in place of the ids, and their number and SHA-256 (as little-endian 32-bit integers)."""
    shared = _Shared(encoded.sparkSession, read_model(model), model)

    def run(batches):
        pieces = _pieces(shared)
        for b in batches:
            for start in range(0, b.num_rows, 200):  # a few hundred lists at a time
                part = b.slice(start, 200)
                lists = part.column("ids")
                sizes = lists.value_lengths().fill_null(0).to_numpy()
                ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype("<i4")
                ends = np.cumsum(sizes)
                texts = pieces.decode_all(ids, ends)
                raw = ids.tobytes()
                digests = [hashlib.sha256(raw[4 * (z - n) : 4 * z]).hexdigest() for z, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                cols = [part.column("row"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "text", "n_pieces", "ids_sha256"])

    new = [("text", T.StringType()), ("n_pieces", T.LongType()), ("ids_sha256", T.StringType())]
    return map_rows(encoded, run, new, drop=(ids_col,), ids=F.col(f"`{ids_col}`"))
