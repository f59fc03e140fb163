"""Substring dedup by seed and extend: winnowed anchors find shared places, maximal repeats around them are cut.

Seeds are hashes of runs of five words; of every nine neighbouring ones the smallest is an anchor, so each run of 13 words
holds one, the same in every document. Anchors that several documents hold are joined, and each is extended both ways to
every run of 13 words that it stands for; a run that also starts in a document with a smaller id is a repeat, and
neighbouring repeats merge to the maximal ones, whose words are removed.

Before each shuffle a task keeps only the smallest document per hash of a batch: the others are settled at once and travel
packed under their own document, so a hash that a third of all documents hold sends one row per batch. Texts are shuffled
once, by document, and that exchange serves both joins. Anchors are 64-bit hashes (a chance match costs only work), runs
96-bit ones.

Very long texts are read whole. A null or empty text has no words. A null id counts as larger than any other. Rows with one id are one document for the
comparison of ids, so equal rows never remove each other's words. Texts under 13 words lose nothing. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import map_batches, map_texts
from llm.packed import column, known, member, packed
from llm.words import gram_hashes, joined, mix, pieces, split, white_table, word_hashes

SIZE, SEED, NEAR = 13, 5, 9
BATCH = 1 << 21  # hashes that a task holds before it sends them on
LAST = (1 << 63) - 1

ROWS = "key long, chk int, doc long, many boolean, pack binary"


def _anchors(h: np.ndarray, first: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seed hashes, and for each start of a whole run the place of its anchor."""
    seeds, _ = gram_hashes(h, first, SEED)
    starts = np.flatnonzero(whole)
    best, place = seeds[starts], starts.copy()
    for j in range(1, NEAR):
        other = seeds[starts + j]
        less = other < best
        best = np.where(less, other, best)
        place = np.where(less, starts + j, place)
    return best, place


def _settle(keys: list, checks: list, docs: list):
    """Rows of one batch: per hash the smallest document; the other documents packed, each under its own key."""
    k, c, d = np.concatenate(keys), np.concatenate(checks), np.concatenate(docs)
    order = np.lexsort((d, c, k))
    k, c, d = k[order], c[order], d[order]
    same_run = np.zeros(len(k), bool)
    same_run[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    fresh = np.ones(len(k), bool)
    fresh[1:] = ~(same_run[1:] & (d[1:] == d[:-1]))
    k, c, d, same_run = k[fresh], c[fresh], d[fresh], same_run[fresh]
    many = np.zeros(len(k), bool)
    many[:-1] = same_run[1:]
    lone = np.flatnonzero(~same_run)
    lone = lone[np.argsort(d[lone], kind="stable")]  # neighbours of one document compress well
    own, packs = packed(d[same_run], k[same_run])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([k[lone], mix(own.view(np.uint64))]).view(np.int64)),
            pa.array(np.concatenate([c[lone], np.zeros(len(own), np.int32)])),
            pa.array(np.concatenate([d[lone], own])),
            pa.array(np.concatenate([many[lone], np.ones(len(own), bool)])),
            pa.array([None] * len(lone) + packs, pa.binary()),
        ],
        names=["key", "chk", "doc", "many", "pack"],
    )


def _gather(batches, emit):
    """Hashes of all pieces, settled whenever BATCH of them are held."""
    keys, checks, docs, held = [], [], [], 0
    for batch in batches:
        for at, texts in pieces(column(batch, "text")):
            k, c, d = emit(batch.slice(at, len(texts)), texts)
            keys.append(k), checks.append(c), docs.append(d)
            held += len(k)
            if held >= BATCH:
                yield _settle(keys, checks, docs)
                keys, checks, docs, held = [], [], [], 0
    if held:
        yield _settle(keys, checks, docs)


def _ids(rows) -> np.ndarray:
    return column(rows, "doc").to_numpy()


def _seeds(batches):
    def emit(rows, texts):
        piece = split(texts, white_table())
        h = word_hashes(piece)
        _, whole = gram_hashes(h, piece.first, SIZE)
        best, place = _anchors(h, piece.first, whole)
        new = np.ones(len(place), bool)
        new[1:] = place[1:] != place[:-1]
        return best[new], np.zeros(int(new.sum()), np.int32), _ids(rows)[piece.owner[place[new]]]

    return _gather(batches, emit)


def _runs(batches):
    """The runs of 13 words around shared anchors."""

    def emit(rows, texts):
        piece = split(texts, white_table())
        h = word_hashes(piece)
        run, whole = gram_hashes(h, piece.first, SIZE)
        other, _ = gram_hashes(mix(h ^ np.uint64(0xA5A5A5A5)), piece.first, SIZE)
        best, _ = _anchors(h, piece.first, whole)
        starts = np.flatnonzero(whole)
        bounds = np.searchsorted(starts, piece.first)
        hit = np.zeros(len(starts), bool)
        for i, own in enumerate(known(rows, "keys", "packs")):
            a, b = bounds[i], bounds[i + 1]
            hit[a:b] = member(best[a:b], own)
        chosen = starts[hit]
        return run[chosen], other[chosen].astype(np.uint32).view(np.int32), _ids(rows)[piece.owner[chosen]]

    return _gather(batches, emit)


def _by_document(rows: DataFrame) -> DataFrame:
    """One row per document: its hashes and packs. Both are bounded by the document's own words."""
    return rows.groupBy("doc").agg(
        F.collect_list(F.when(F.col("pack").isNull(), F.col("key"))).alias("keys"), F.collect_list("pack").alias("packs")
    )


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts as (doc, doc_id, text), and per doc the hashes of its runs that also start in a smaller document."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), "doc_id", "text")
    same = Window.partitionBy("key")
    seeds = map_batches(texts.select("doc", "text"), _seeds, ROWS)
    shared = seeds.withColumn("least", F.min("doc").over(same)).withColumn("most", F.max("doc").over(same))
    shared = shared.where("many or least < most").select("key", "doc", "pack")
    near = texts.join(_by_document(shared), "doc")  # all of texts' columns, so that its exchange is the later join's too
    runs = map_batches(near, _runs, ROWS).withColumn("least", F.min("doc").over(Window.partitionBy("key", "chk")))
    return texts, _by_document(runs.where("pack is not null or least < doc").select("key", "doc", "pack"))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) for each row of docs."""
    texts, cut = repeats(docs)
    both = texts.join(cut, "doc", "left").select("doc_id", "text", "keys", "packs")

    def fn(rows, part):
        piece = split(part, white_table())
        body, start, end = joined(piece)
        run, whole = gram_hashes(word_hashes(piece), piece.first, SIZE)
        edge = np.zeros(len(run) + SIZE + 1, np.int32)
        for i, own in enumerate(known(rows, "keys", "packs")):
            if len(own):
                a, b = piece.first[i], piece.first[i + 1]
                at = a + np.flatnonzero(member(run[a:b], own) & whole[a:b])
                np.add.at(edge, at, 1)
                np.add.at(edge, at + SIZE, -1)
        gone = np.cumsum(edge)[: len(run)] > 0
        kept = []
        for a, b in zip(piece.first[:-1], piece.first[1:]):
            stay = ~gone[a:b]
            step = np.flatnonzero(np.diff(np.concatenate([[0], stay.view(np.int8), [0]]))) + a
            kept.append(b" ".join(body[start[x] : end[y - 1]].tobytes() for x, y in zip(step[::2], step[1::2])).decode())
        words = np.diff(piece.first)
        total = np.concatenate([[0], np.cumsum(gone)])
        return [words, total[piece.first[1:]] - total[piece.first[:-1]], kept]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    return map_texts(both, fn, fields, ["doc_id"], ("keys", "packs"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    out = dedup(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()
