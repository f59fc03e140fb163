"""Benchmark decontamination: test windows of ten words are broadcast as a hash set; all document windows are looked up.

Benchmark items are cut into blocks of bounded size; each block is one broadcast, and blocks are chained over one scan of
the documents, so no shuffle is needed at any size of the corpus. A hash that is found is verified word by word.

A null or empty text has no words and is never hit; an item without words has no windows; repeated items and repeated
documents are each judged alone; a window at two places hits both. An empty benchmark hits nothing. Item ids are compared
as strings; a null item id is left out of the list of items, but its words count. Very long texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import fresh, map_texts
from llm.words import Piece, gram_hashes, lower_word_table, raw, split, word_hashes

BLOCK_BYTES = 8 << 20  # of benchmark text in a broadcast; its arrays take about six times as much memory


@dataclass
class Block:
    """Windows of some items as arrays, without an object per window: by length the sorted hashes of the windows and the word
    of `piece` that each begins at; ids: of the items, one per text of the piece."""

    ids: list[str | None]
    piece: Piece
    lookup: list[tuple[int, np.ndarray, np.ndarray]]


def block_of(items: list[tuple[str | None, str]], size: int) -> Block:
    piece = split(pa.array([t for _, t in items], pa.large_string()), lower_word_table())
    h, counts = word_hashes(piece), np.minimum(np.diff(piece.first), size)
    lookup = []
    for length in np.unique(counts[counts > 0]).tolist():
        g, ok = gram_hashes(h, piece.first, length)
        at = np.flatnonzero(ok & (counts[piece.owner] == length))
        order = np.argsort(g[at], kind="stable")
        lookup.append((length, g[at][order], at[order]))
    return Block([i for i, _ in items], piece, lookup)


def _scan(texts: pa.Array, block: Block) -> tuple[np.ndarray, list[np.ndarray], list[set]]:
    """Words per text, hit word positions per text, items per text."""
    piece = split(texts, lower_word_table())
    h = word_hashes(piece)
    hit = np.zeros(len(h) + 1, dtype=np.int32)
    items: list[set] = [set() for _ in range(piece.texts)]
    for length, keys, at in block.lookup:
        g, ok = gram_hashes(h, piece.first, length)
        low = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        for i in np.flatnonzero(ok & (keys[low] == g)):
            words = piece.span(i, i + length)
            same = at[low[i] : np.searchsorted(keys, g[i], side="right")]
            same = [w for w in same.tolist() if block.piece.span(w, w + length) == words]
            if same:
                hit[i] += 1
                hit[i + length] -= 1
                items[piece.owner[i]].update(block.ids[block.piece.owner[w]] for w in same)
    inside = np.cumsum(hit)[:-1] > 0
    places = [np.flatnonzero(inside[a:b]).astype(np.int32) for a, b in zip(piece.first[:-1], piece.first[1:])]
    return np.diff(piece.first), places, items


def mark(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int = 10, block_bytes: int = BLOCK_BYTES, prefix: str = ""
) -> DataFrame:
    """Columns `keep`, then n_words, places (hit words, from 0) and items (sorted ids) of each text.

    block_bytes bounds the benchmark text that one broadcast holds.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    n, places, items = f"{prefix}n_words", f"{prefix}places", f"{prefix}items"
    fields = [
        T.StructField(n, T.LongType()),
        T.StructField(places, T.ArrayType(T.IntegerType())),
        T.StructField(items, T.ArrayType(T.StringType())),
    ]
    out = docs
    for b in range(blocks):
        part = tests.where(block == b) if blocks > 1 else tests
        sent = spark.sparkContext.broadcast(block_of([tuple(r) for r in part.collect()], size))

        def fn(batch, texts, sent=sent, more=b > 0):
            words, place, item = _scan(texts, sent.value)
            if more:
                old_p = batch.column(batch.schema.get_field_index(places)).to_pylist()
                old_i = batch.column(batch.schema.get_field_index(items)).to_pylist()
                place = [np.union1d(x, np.array(y, np.int32)).astype(np.int32) for x, y in zip(place, old_p)]
                item = [x | set(y) for x, y in zip(item, old_i)]
            return [words, place, [sorted(x for x in y if x is not None) for y in item]]

        if b == 0:
            out = map_texts(out, fn, fields, list(dict.fromkeys([*keep, *(["text"] if blocks > 1 else [])])))
        else:
            state = out.columns
            made = [T.StructField(f"{f.name}_new", f.dataType) for f in fields]
            out = map_texts(out, fn, made, [c for c in state if c != n])
            out = out.drop(places, items).withColumnsRenamed({f"{f.name}_new": f.name for f in fields})
    return out.select(*[f"`{c}`" for c in keep], n, places, items)


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs."""
    return mark(docs, benchmark, ["doc_id"], size, block_bytes).select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("places") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 10, mode: str = "documents") -> DataFrame:
    """docs without what the benchmark holds, columns unchanged.

    mode "documents" drops rows with any hit word; "spans" cuts each run of hit words out of the text (from its first
    byte to its last), sets n_chars where that column exists, and drops rows that had words and have none left.
    """
    prefix = fresh(docs, "hit_")
    marked = mark(docs, benchmark, docs.columns, size, prefix=prefix)
    if mode == "documents":
        return marked.where(F.size(f"{prefix}places") == 0).select(*[f"`{c}`" for c in docs.columns])
    if mode != "spans":
        raise ValueError(f"unknown mode {mode!r}")
    table, cut, left = lower_word_table(), f"{prefix}cut", f"{prefix}left"

    def fn(batch, texts):
        piece = split(texts, table)
        data, offsets = raw(texts)
        texts_out, words_left = [], []
        for i, places in enumerate(batch.column(batch.schema.get_field_index(f"{prefix}places")).to_pylist()):
            body = data[offsets[i] : offsets[i + 1]].tobytes()
            at, parts, base = 0, [], piece.first[i]
            runs = np.split(np.array(places, int), np.flatnonzero(np.diff(places) != 1) + 1) if places else []
            for run in runs:
                parts.append(body[at : piece.start[base + run[0]] - offsets[i]])
                at = int(piece.end[base + run[-1]] - offsets[i])
            texts_out.append(b"".join([*parts, body[at:]]).decode() if places else None)
            words_left.append(int(piece.first[i + 1] - base) - len(places))
        return [texts_out, words_left]

    fields = [T.StructField(cut, T.StringType()), T.StructField(left, T.LongType())]
    out = map_texts(marked, fn, fields, [*docs.columns, f"{prefix}places"])
    hit = F.size(f"{prefix}places") > 0
    out = out.where(~hit | (F.col(left) > 0))
    new = {"text": F.when(hit, F.col(cut)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(hit, F.length(cut)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])

