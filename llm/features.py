"""Hashed counts of words, word shapes and repeats, the input of the classifiers of this package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from llm.words import Piece, lower_white_table, split, word_hashes


def _shape_table() -> np.ndarray:
    """Byte classes: lower and upper letters, digits, other alphabets, and each ASCII mark as itself."""
    table = np.arange(256, dtype=np.uint8)
    table[0x61:0x7B] = ord("a")
    table[0x41:0x5B] = ord("A")
    table[0x30:0x3A] = ord("0")
    table[0x80:] = ord("a")
    table[[0x20, 9, 10, 11, 12, 13]] = 0x20
    return table


def _shapes(piece: Piece) -> np.ndarray:
    """A small code per word from its first, second, last but one and last byte class."""
    n = piece.end - piece.start
    a = piece.data[piece.start].astype(np.uint64)
    b = piece.data[np.minimum(piece.start + 1, piece.end - 1)].astype(np.uint64)
    c = piece.data[np.maximum(piece.end - 2, piece.start)].astype(np.uint64)
    d = piece.data[piece.end - 1].astype(np.uint64)
    size = np.minimum(n // 4, 3).astype(np.uint64)
    return ((((a * 131 + b) * 131 + c) * 131 + d) * 131 + size) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)


REPEATS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6])  # edges of the classes of repeated words
REPEAT_WEIGHT = 0.7


def width(words: int, shapes: int) -> int:
    return words + shapes + len(REPEATS) + 1


def counts(texts: pa.Array, words: int, shapes: int) -> np.ndarray:
    """One row per text (null: empty): log of 1 + counts of hashed words (lower case) and of hashed shapes, divided by
    the row's length; then one mark for the share of words that equal the one before."""
    plain = split(texts, lower_white_table())
    shaped = split(texts, _shape_table())
    wide = words + shapes
    h = word_hashes(plain)
    with np.errstate(over="ignore"):
        code = _shapes(shaped)
    out = np.bincount(plain.owner * wide + (h % np.uint64(words)).astype(np.int64), minlength=wide * plain.texts)
    out += np.bincount(shaped.owner * wide + words + (code % np.uint64(shapes)).astype(np.int64), minlength=len(out))
    out = np.log1p(out.reshape(plain.texts, wide), dtype=np.float32)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    again = plain.owner[1:][(h[1:] == h[:-1]) & (plain.owner[1:] == plain.owner[:-1])]
    n = np.diff(plain.first)
    share = np.bincount(again, minlength=plain.texts) / np.maximum(n - 1, 1)
    marks = np.zeros((plain.texts, len(REPEATS) + 1), np.float32)
    marks[np.arange(plain.texts), np.searchsorted(REPEATS, share, side="right")] = REPEAT_WEIGHT
    marks[n == 0] = 0
    return np.hstack([out / np.where(norm > 0, norm, 1), marks])
