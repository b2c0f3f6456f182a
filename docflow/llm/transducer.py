"""A byte-level BPE tokenizer compiled to deterministic transducers that count tokens.

Two machines in a row, both deterministic:

* The splitter reads characters by class (letter, number, space, other white space,
  anything else) in a window of two before and two after, and marks where a piece
  begins: contractions, runs of letters, of numbers or of other characters, each
  with one leading space, and runs of white space that leave their last character
  to a following word.
* The merger reads a piece's bytes. A sequence of tokens is what byte-pair merging
  gives exactly if every two neighbours are, so a piece's prefixes each have one
  last token. A state is the set of token prefixes under way (place in the trie of
  tokens, token before it, tokens counted so far, less the least of them); a
  transition drops prefixes that no token continues, adds the one token that ends
  here, and emits the growth of the least count. States are made when first
  reached and kept.

A chunk of a text is summed up by its state map (:class:`ChunkMap`): what precedes
its first sure place, the tokens between, what follows its last sure place. A sure place
is where a piece begins or, within a long piece, where a token ends whatever precedes the
chunk (:meth:`Tokenizer.certain_cut`); with the token that ends there it is all that what
follows depends on. So a map's open ends are short also where a piece goes on over many
chunks. Maps compose associatively: chunks are counted apart and folded in any bracketing.
Only where the merging of a long piece never settles (such as one letter over and over,
whose tokens shift with its start) does a chunk's map stay its text.
"""

from __future__ import annotations

import json
import unicodedata
from typing import NamedTuple

import numpy as np

LETTER, NUMBER, SPACE, BLANK, OTHER = 1, 2, 3, 4, 5
#: Piece starts this far from a chunk's edges don't depend on what lies beyond:
#: the splitter's window and the longest special string are shorter.
MARGIN = 32
_WHITE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What a process keeps at most: made states, pieces with their counts, neighbours already judged.
MAX_STATES, MAX_PIECES, MAX_FITS = 160_000, 250_000, 300_000
_NO_END = -1
#: Open ends of a map longer than this are cut within their piece; how far a cut is looked for.
LONG_END, LOOK = 2_048, 4_096


def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for cp in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(cp))[0])
        if kind:
            table[cp] = kind
    table[_WHITE] = BLANK
    table[0x20] = SPACE
    return table


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ChunkMap(NamedTuple):
    """``head``, ``count``, ``tail``; with ``tail`` None the chunk has no sure place and is
    all head. ``left``: the token that ends where the tail begins, -1 if a piece begins there."""

    head: str
    count: int
    tail: str | None
    left: int = -1


class Tokenizer:
    """Compiled from the text of a ``tokenizer.json`` of kind byte-level BPE."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model, pre = d["model"], d["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or d["normalizer"]:
            raise ValueError("only plain byte-level BPE files can be compiled")
        self.specials = sorted((t["content"] for t in d["added_tokens"]), key=len, reverse=True)
        if any(len(s) >= MARGIN for s in self.specials) or max(map(len, model["vocab"])) > 255:
            raise ValueError("special strings must be shorter than the margin, tokens at most 255 bytes")
        letters = _byte_letters()
        specials = set(self.specials)
        token = {t: i for t, i in model["vocab"].items() if t not in specials}
        self.text = {i: bytes(letters[c] for c in t) for t, i in token.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(token[a], token[b]): (r, token[a + b]) for r, (a, b) in enumerate(pairs)}
        self.of_byte = {b[0]: i for i, b in self.text.items() if len(b) == 1}
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        for i, b in self.text.items():
            node = 0
            for x in b:
                key = node << 8 | x
                nxt = self.child.get(key)
                if nxt is None:
                    nxt = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = i
        self.longest = max(map(len, self.text.values()))
        self.fits: dict[int, bool] = {}
        self.pieces = _Pieces(self)
        self.classes = _classes()
        self._reset()

    # -- merger ---------------------------------------------------------------

    def merged(self, text: bytes) -> list[int]:
        """Byte-pair merging as defined: the pair of least rank, leftmost first, until none is left."""
        ids = [self.of_byte[b] for b in text]
        while len(ids) > 1:
            rank, at = min(((self.rank.get(p, (1 << 60, 0))[0], k) for k, p in enumerate(zip(ids, ids[1:]))), default=(1 << 60, 0))
            if rank == 1 << 60:
                break
            ids[at : at + 2] = [self.rank[ids[at], ids[at + 1]][1]]
        return ids

    def _follows(self, left: int, right: int) -> bool:
        """Whether ``left, right`` is how their bytes are merged (``left`` -1: a piece begins)."""
        key = (left + 1) << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > MAX_FITS:
                self.fits.clear()
            joined = (self.text[left] if left >= 0 else b"") + self.text[right]
            known = self.fits[key] = self.merged(joined) == ([left, right] if left >= 0 else [right])
        return known

    # A token prefix under way is one number: place in the trie, token before it (plus 1), tokens counted.

    def _reset(self) -> None:
        start = (0,)
        self.states: dict[tuple, int] = {start: 0}
        self.threads = [start]
        self.final = [0]
        self.moves: dict[int, int] = {}

    def _move(self, state: int, byte: int) -> int:
        """The transition's target, shifted by 8, plus the count that it emits."""
        going, ended = [], None
        for thread in self.threads[state]:
            nxt = self.child.get(thread >> 40 << 8 | byte)
            if nxt is None:
                continue
            going.append(nxt << 40 | thread & 0xFFFFFFFFFF)
            t = self.token_at[nxt]
            if ended is None and t >= 0 and self._follows((thread >> 8 & 0xFFFFFFFF) - 1, t):
                ended = t + 1 << 8 | (thread & 0xFF) + 1
        if ended is not None:
            going.append(ended)
        least = min(x & 0xFF for x in going)
        # just after a cut no token may end here; the mark continues with no byte
        key = (*(x - least for x in going), *((_NO_END,) if ended is None else ()))
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.threads)
            self.threads.append(key)
            self.final.append(key[-1] & 0xFF if ended is not None else 0)
        self.moves[state << 8 | byte] = move = to << 8 | least
        return move

    def _again(self, state: int) -> int:
        """Starts the states afresh with ``state``, a piece's present one; its new number."""
        threads, final = self.threads[state], self.final[state]
        self._reset()
        if threads not in self.states:
            self.states[threads] = len(self.threads)
            self.threads.append(threads)
            self.final.append(final)
        return self.states[threads]

    def _state_after(self, token: int) -> int:
        """The state where ``token`` has ended and nothing else is under way (-1: a piece begins)."""
        key = (token + 1 << 8,)
        if key not in self.states:
            self.states[key] = len(self.threads)
            self.threads.append(key)
            self.final.append(0)
        return self.states[key]

    def count_piece(self, piece: bytes, left: int = -1) -> int:
        """Tokens of a piece, or of a part of one that begins where the token ``left`` ends."""
        state, emitted = self._state_after(left), 0
        moves = self.moves
        for byte in piece:
            key = state << 8 | byte
            if key in moves:
                move = moves[key]
            else:
                if len(self.threads) > MAX_STATES:  # also within a piece, however long
                    state = self._again(state)
                    moves = self.moves
                move = self._move(state, byte)
            state = move >> 8
            emitted += move & 0xFF
        return emitted + self.final[state]

    def certain_cut(self, raw: bytes, a: int, b: int) -> tuple[int, int, int] | None:
        """A place of ``raw[a:b]``, which lies within one piece, that is between two tokens
        whatever precedes ``a``, the token that ends there, and the place from which on that
        is certain; None if there is none.

        Every place keeps the tokens that may end there: those that follow one that may end
        where they begin. Before any token begun ahead of ``a`` must have ended, all may.
        A place that all ways to the tokens under way lead through is certain."""
        unknown = a + self.longest
        may_end: dict[int, set[int]] = {}
        through: dict[int, int | None] = {a: None}  # the last place that all ways to a place lead through
        going = [(a, 0)]
        for at in range(a + 1, b + 1):
            byte, on, ends, begins = raw[at - 1], [], set(), set()
            for start, node in going:
                node = self.child.get(node << 8 | byte)
                if node is None:
                    continue
                on.append((start, node))
                token = self.token_at[node]
                if token >= 0 and (start < unknown or any(self._follows(left, token) for left in may_end[start])):
                    ends.add(token)
                    begins.add(start)
            if at < unknown:
                through[at] = None
            elif ends:
                may_end[at] = ends
                through[at] = self._meet(begins, through)
            if at < unknown or ends:
                on.append((at, 0))
            going = on
            if at > unknown:
                cut = self._meet({start for start, _ in going}, through)
                while cut is not None and cut >= unknown:
                    if len(may_end[cut]) == 1 and raw[cut] & 0xC0 != 0x80:
                        return cut, next(iter(may_end[cut])), at
                    cut = through[cut]
        return None

    @staticmethod
    def _meet(places: set[int], through: dict[int, int | None]) -> int | None:
        """The last place that all ways to all ``places`` lead through."""
        places = set(places)
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            before = through[last]
            if before is None:
                return None
            places.add(before)
        return places.pop() if places else None

    # -- splitter -------------------------------------------------------------

    def piece_starts(self, chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where pieces begin; ``begins`` marks the first character of each text."""
        n = len(chars)
        kind = self.classes[chars]
        before = np.zeros(n, np.uint8)
        before[1:] = kind[:-1]
        before[begins] = 0
        ends = np.append(begins[1:], True)
        after = np.zeros(n, np.uint8)
        after[:-1] = kind[1:]
        after[ends] = 0
        white, white_before = (kind == SPACE) | (kind == BLANK), (before == SPACE) | (before == BLANK)
        last_of_run = white_before & (after != 0) & (after != SPACE) & (after != BLANK)
        starts = np.where(white, ~white_before | last_of_run, (before != kind) & (before != SPACE))
        starts |= begins
        quote = np.flatnonzero((chars == 39) & starts)
        if len(quote):
            padded = np.append(chars, [0, 0, 0])
            edge = np.append(begins, [True, True, True])
            one = ~edge[quote + 1]
            two = one & ~edge[quote + 2]
            c1, c2 = padded[quote + 1], padded[quote + 2]
            short = one & np.isin(c1, [ord(c) for c in "stmd"])
            pair = (c1 << 8) | c2
            long = two & np.isin(pair, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
            for where, size in ((quote[short], 2), (quote[long], 3)):
                starts[where + 1] = False
                nxt = where + size
                starts[nxt[nxt < n]] = True
        return starts

    def count_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text (UTF-8 bytes, text i from offsets[i] to offsets[i + 1])."""
        base = int(offsets[0])
        raw = data[base : int(offsets[-1])].tobytes()
        totals = np.zeros(len(offsets) - 1, np.int64)
        if not raw:
            return totals
        off = offsets - base
        starts, doc_at = self._starts(raw, off)
        ends = np.append(starts[1:], len(raw))
        pieces = self.pieces
        counts = np.fromiter((pieces[raw[a:b]] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))
        return np.bincount(doc_at, counts, len(totals)).astype(np.int64)

    def _starts(self, raw: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions of piece starts and the number of the text that each lies in."""
        data = np.frombuffer(raw, np.uint8)
        at_byte = np.flatnonzero((data & 0xC0) != 0x80)  # of each character
        chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
        begins = np.zeros(len(raw), bool)
        begins[off[:-1][off[:-1] < len(raw)]] = True
        inside = None
        for special in self.specials:
            b = special.encode()
            k = raw.find(b)
            while k >= 0:
                if np.searchsorted(off, k, side="right") == np.searchsorted(off, k + len(b) - 1, side="right"):
                    inside = np.zeros(len(raw), bool) if inside is None else inside
                    if not inside[k]:
                        inside[k : k + len(b)] = True
                        begins[k] = True
                        begins[k + len(b) : k + len(b) + 1] = True
                k = raw.find(b, k + len(b))
        flags = begins[at_byte]
        starts = self.piece_starts(chars, flags)
        if inside is not None:
            starts &= ~inside[at_byte] | flags
        where = at_byte[starts]
        return where, np.searchsorted(off, where, side="right") - 1

    # -- chunks ---------------------------------------------------------------

    def count_text(self, text: str, left: int = -1) -> int:
        """Tokens of a text, or of a part of one that begins within a piece, where the token
        ``left`` ends."""
        raw = text.encode()
        if not raw:
            return 0
        data = np.frombuffer(raw, np.uint8)
        if left < 0:
            return int(self.count_texts(data, np.array([0, len(raw)]))[0])
        starts, _ = self._starts(raw, np.array([0, len(raw)]))
        end = int(starts[1]) if len(starts) > 1 else len(raw)
        return self.count_piece(raw[:end], left) + (self.count_text(raw[end:].decode()) if end < len(raw) else 0)

    def _after_blank(self, raw: bytes, k: int) -> bool:
        """Whether white space ends at ``k``: its last piece would show in what precedes ``k`` only with what follows."""
        around = raw[max(0, k - 4) : k].decode(errors="ignore")[-1:], raw[k : k + 4].decode(errors="ignore")[:1]
        left, right = (int(self.classes[ord(c)]) in (SPACE, BLANK) if c else False for c in around)
        return left and not right

    def chunk_map(self, text: str) -> ChunkMap:
        raw = text.encode()
        if not raw:
            return ChunkMap("", 0, None)
        starts, _ = self._starts(raw, np.array([0, len(raw)]))
        low, high = 4 * MARGIN, len(raw) - 4 * MARGIN  # between them pieces don't depend on other chunks
        sure = starts[(starts >= low) & (starts <= high)].tolist()
        first = next((k for k in sure if not self._after_blank(raw, k)), None)
        last = next((k for k in reversed(sure) if not self._after_blank(raw, k)), None)
        count, left = 0, -1
        if first is not None and last > first:
            between = np.frombuffer(raw[first:last], np.uint8)
            count = int(self.count_texts(between, np.array([0, len(between)]))[0])
        # long open ends are parts of one piece: cut them there
        begin, end = first, last
        head = self._cut(raw, starts, low, high if first is None else first, front=True)
        tail = self._cut(raw, starts, low if last is None else last, high, front=False)
        if first is None:
            if not head or not tail or head[2] > tail[0]:
                return ChunkMap(text, 0, None)
            (begin, token, _), (end, left, _) = head, tail
            count = self.count_piece(raw[begin:end], token)
        else:
            if head and first > LONG_END:
                begin = head[0]
                count += self.count_piece(raw[begin:first], head[1])
            if tail and len(raw) - last > LONG_END:
                end, left, _ = tail
                count += self.count_piece(raw[last:end])
        return ChunkMap(raw[:begin].decode(), count, raw[end:].decode(), left)

    def _cut(self, raw: bytes, starts: np.ndarray, a: int, b: int, front: bool) -> tuple[int, int, int] | None:
        """A certain cut near the front or the end of ``raw[a:b]``, if that is long and part of one piece."""
        if b - a <= LONG_END or ((starts > a) & (starts < b)).any():
            return None
        return self.certain_cut(raw, a, min(b, a + LOOK)) if front else self.certain_cut(raw, max(a, b - LOOK), b)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.count, b.tail, b.left)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head, a.left)
        return ChunkMap(a.head, a.count + self.count_text(a.tail + b.head, a.left) + b.count, b.tail, b.left)

    def total(self, maps: list[ChunkMap]) -> int:
        """Tokens of the text whose chunks, in order, have these maps: a balanced fold, then its open ends."""
        while len(maps) > 1:
            maps = [self.compose(*maps[k : k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        m = maps[0]
        return self.count_text(m.head) + m.count + (self.count_text(m.tail, m.left) if m.tail is not None else 0)


class _Pieces(dict):
    """Counts of pieces already read; long ones aren't kept, and at the bound it starts afresh."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__({s.encode(): 1 for s in tokenizer.specials})
        self.tokenizer = tokenizer

    def __missing__(self, piece: bytes) -> int:
        n = self.tokenizer.count_piece(piece)
        if len(piece) <= 48:
            if len(self) > MAX_PIECES:
                self.clear()
                self.update({s.encode(): 1 for s in self.tokenizer.specials})
            self[piece] = n
        return n
