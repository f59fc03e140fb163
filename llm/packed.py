"""Sets of 64-bit hashes per document that travel as long lists and as packed bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def packed(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Each document once, and its values as bytes."""
    if not len(doc):
        return doc, []
    order = np.argsort(doc, kind="stable")
    doc, value = doc[order], value[order]
    cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    return doc[cut], [v.tobytes() for v in np.split(value, cut[1:])]


def column(rows, name: str):
    return rows.column(rows.schema.get_field_index(name))


def known(rows, keys: str, packs: str | None) -> Iterator[np.ndarray]:
    """Per row the sorted hashes of its list and its packs; null lists are empty."""
    for k, p in zip(column(rows, keys), column(rows, packs) if packs else [None] * len(rows)):
        own = k.values.to_numpy().view(np.uint64) if k.is_valid and len(k.values) else np.zeros(0, np.uint64)
        more = [np.frombuffer(x, np.uint64) for x in (p.as_py() or [])] if p is not None and p.is_valid else []
        yield np.sort(np.concatenate([own, *more])) if more else np.sort(own)


def member(values: np.ndarray, sorted_known: np.ndarray) -> np.ndarray:
    if not len(sorted_known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_known, values), len(sorted_known) - 1)
    return sorted_known[at] == values
