"""Word hashes of whole texts, read straight from Arrow's buffers with numpy.

A batch of texts is one byte array plus offsets. Words are maximal runs of bytes
that a 256-entry table maps to non-zero; each word becomes one 64-bit hash of its
mapped bytes. Work is done in pieces of a few MB cut between words, so a very
long text costs 8 bytes a word and no more than a piece of scratch memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_COEFS = [np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, 1024, dtype=np.uint64) | np.uint64(1) for seed in (20240229, 20250301)]


def _lower_table(is_word) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if is_word(b):
            table[b] = b + 32 if 65 <= b <= 90 else b
    return table


#: Letters, digits and every non-ASCII byte; A-Z as a-z; all else separates words.
ALNUM = _lower_table(lambda b: b >= 128 or chr(b).isalnum())
#: Everything but ASCII white space (9-13, 32); A-Z as a-z. NUL counts as 255, which no UTF-8 text holds.
NON_SPACE = _lower_table(lambda b: b != 32 and not 9 <= b <= 13)
NON_SPACE[0] = 255
#: The same with A-Z as they are.
EXACT = np.array([b if NON_SPACE[b] else 0 for b in range(256)], np.uint8)
EXACT[0] = 255


def text_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data, off


def doc_blocks(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``limit`` bytes each (a longer text is a range of its own)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _coefficients(kind: int, place: np.ndarray) -> np.ndarray:
    """What the byte at each place of a word is multiplied by: from a table, and beyond
    it from the place itself, so no two places of a word share one."""
    out = _COEFS[kind][place & 1023]
    far = np.flatnonzero(place >= 1024)
    if len(far):
        out[far] = mix(place[far].astype(np.uint64) * np.uint64(2) + _COEFS[kind][0]) | np.uint64(1)
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = ALNUM) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document number) of every word of the texts, in order."""
    (hashes,), places = word_places(data, offsets, table)
    return hashes, np.searchsorted(offsets, places, side="right") - 1


def word_places(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, kinds: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """(``kinds`` independent hashes, place of the first byte in ``data``) of every word of
    the texts, in order."""
    hashes, places = [[] for _ in range(kinds)], []
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        size = PIECE
        while True:  # cut after the last separator; a piece that is one word grows
            stop = min(at + size, end)
            mapped = table[data[at:stop]]
            if stop == end:
                break
            gaps = np.flatnonzero(mapped == 0)
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
                mapped = mapped[: stop - at]
                break
            size *= 2
        word = mapped != 0
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        lo, hi = np.searchsorted(offsets, (at, stop), side="left")
        cuts = offsets[lo:hi] - at  # a text's first byte begins a word even where no separator precedes it
        begins[cuts] = word[cuts]
        if begins.any():
            where = np.flatnonzero(word)
            first = np.flatnonzero(begins[where])
            sizes = np.diff(np.append(first, len(where)))
            place = np.arange(len(where)) - np.repeat(first, sizes)
            values = mapped[where].astype(np.uint64) + np.uint64(1)
            for kind in range(kinds):
                hashes[kind].append(mix(np.add.reduceat(values * _coefficients(kind, place), first) + sizes.astype(np.uint64)))
            places.append(at + where[first])
        at = stop
    if not places:
        return [np.zeros(0, np.uint64)] * kinds, np.zeros(0, np.int64)
    return [np.concatenate(h) for h in hashes], np.concatenate(places)
