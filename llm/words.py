"""Words of whole texts as arrays: byte positions, owners and 64-bit hashes, without a Python object per word.

Texts come as Arrow string arrays. All work is done on pieces of a batch that hold a bounded number of bytes (one text at
least), so memory follows the piece or the longest single text, never the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def white_table() -> np.ndarray:
    """Byte classes for words [^\\x20\\x09-\\x0D]+, letters unchanged."""
    table = np.arange(256, dtype=np.uint8)
    table[[0x20, 9, 10, 11, 12, 13]] = 0x20
    return table


def lower_white_table() -> np.ndarray:
    """As white_table, with A-Z lowered."""
    table = white_table()
    table[0x41:0x5B] += 32
    return table


def lower_word_table() -> np.ndarray:
    """Byte classes for words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lowered."""
    table = np.full(256, 0x20, dtype=np.uint8)
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table[keep] = keep
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


@dataclass
class Piece:
    """Some consecutive texts. data: their mapped bytes; start, end: byte positions of each word; owner: its text;
    first: where each text's words begin, one entry more than texts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    texts: int

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def span(self, i: int, j: int) -> bytes:
        """Words i to j (exclusive) joined by one space."""
        return b" ".join(self.data[self.start[k] : self.end[k]].tobytes() for k in range(i, j))


def pieces(array: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Offset and slice of consecutive rows, each slice of at most limit bytes of text, or one row."""
    array = array.cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    at = 0
    while at < len(array):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, array.slice(at, min(end, len(array)) - at)
        at = end


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a large_string slice and the offsets of its rows in them; a null is empty."""
    if array.null_count:
        array = array.fill_null("")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    body = array.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split(array: pa.Array, table: np.ndarray) -> Piece:
    """The words of a large_string slice; a null text has none. No word spans two texts."""
    data, offsets = raw(array)
    data = table[data]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = data != 0x20
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # words that touch across a border of texts
    if len(cuts):
        start, end = np.sort(np.concatenate([start, cuts])), np.sort(np.concatenate([end, cuts]))
    owner = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets)
    return Piece(data, start, end, owner, first, len(array))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * _STEP
        h = h ^ (h >> np.uint64(29))
        h = h * _BASE
        return h ^ (h >> np.uint64(32))


def word_hashes(piece: Piece, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, equal for equal words in any piece."""
    with np.errstate(over="ignore"):
        n = piece.end - piece.start
        h = n.astype(np.uint64) * _BASE + np.uint64(seed)
        padded = np.concatenate([piece.data, np.zeros(8, np.uint8)])
        eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
        todo = np.arange(len(n))
        for at in range(0, int(n.max(initial=0)), 8):
            todo = todo[n[todo] > at]
            block = np.ascontiguousarray(eights[piece.start[todo] + at]).view(np.uint64).ravel()
            left = np.minimum(n[todo] - at, 8).astype(np.uint64)
            block = block & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
            h[todo] = mix(h[todo] ^ mix(block + np.uint64(at + 1) * _STEP))
        return h


def gram_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and whether each run that starts at a word lies within one text.

    The arrays have one entry per word; entries of runs that leave their text are not valid."""
    total = np.zeros(len(h), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(k, len(h))):
            total[: len(h) - j] = total[: len(h) - j] * _STEP + h[j:]
    counts = np.diff(first)
    last = np.repeat(first[1:], counts)
    return mix(total), np.arange(len(h)) + k <= last


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)
    for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)  # fixed values of the public XXH64 function


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each byte range of data, all ranges at once."""
    with np.errstate(over="ignore"):
        eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)

        def lane(at: np.ndarray) -> np.ndarray:
            return eights[at].view(np.uint64).ravel()

        def step(acc: np.ndarray, value: np.ndarray) -> np.ndarray:
            return _turn(acc + value * _P2, 31) * _P1

        n = end - start
        at = start.copy()
        seed64 = np.uint64(seed)
        h = np.full(len(n), seed64 + _P5, dtype=np.uint64)
        long = np.flatnonzero(n >= 32)
        if len(long):
            acc = [np.full(len(long), v, np.uint64) for v in (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
            todo = np.arange(len(long))
            while len(todo):
                place = at[long[todo]]
                for j in range(4):
                    acc[j][todo] = step(acc[j][todo], lane(place + 8 * j))
                at[long[todo]] = place + 32
                todo = todo[end[long[todo]] - place - 32 >= 32]
            total = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
            for v in acc:
                total = (total ^ step(np.zeros_like(v), v)) * _P1 + _P4
            h[long] = total
        h += n.astype(np.uint64)
        todo = np.flatnonzero(end - at >= 8)
        while len(todo):
            h[todo] = _turn(h[todo] ^ step(np.zeros(len(todo), np.uint64), lane(at[todo])), 27) * _P1 + _P4
            at[todo] += 8
            todo = todo[end[todo] - at[todo] >= 8]
        todo = np.flatnonzero(end - at >= 4)
        h[todo] = _turn(h[todo] ^ ((lane(at[todo]) & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at[todo] += 4
        todo = np.flatnonzero(end > at)
        while len(todo):
            h[todo] = _turn(h[todo] ^ (data[at[todo]].astype(np.uint64) * _P5), 11) * _P1
            at[todo] += 1
            todo = todo[end[todo] > at[todo]]
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        return h ^ (h >> np.uint64(32))


def joined(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes in which consecutive words of a text stand with one space between them, and each word's start and end there."""
    kept = piece.data != 0x20
    kept[1:] |= kept[:-1].copy()  # the first space after a word
    place = np.cumsum(kept) - 1
    start = place[piece.start] if len(piece.start) else piece.start
    body = piece.data[kept]
    return body, start, start + (piece.end - piece.start)
