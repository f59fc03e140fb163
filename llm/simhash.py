"""SimHash near-duplicates, joined by pigeonring filtering.

A 64-bit fingerprint is a ring of four 16-bit segments. If two fingerprints differ by at most 3 bits in all, some chain of
consecutive segments keeps every prefix within its proportional share of the budget: the first segment differs by 0 bits,
the first two by at most 1, the first three by at most 2. Equal fingerprints are collapsed first. Every fingerprint is
listed under (segment, its value, the next value) and looked up under the same with no or one flipped bit in the next
value, which is an equality join on 32 bits; longer prefixes and then the full distance are checked on what the join meets.

Very long texts are hashed whole, in parts. Texts without words (null and empty ones too) have fingerprint zero and are linked like any other. Repeated rows and ties
share a fingerprint, so they share a component. Rows with a null id take part; a component's id is its smallest id that is
not null. Extra columns are ignored or pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import apart, fresh, map_texts, saved
from llm.graph import components
from llm.words import joined, lower_white_table, split, xxh64

SEGMENTS, WIDTH = 4, 16
PART = 1 << 16  # shingles hashed at once, whatever the text's length


def _fingerprints(texts: pa.Array, size: int) -> np.ndarray:
    piece = split(texts, lower_white_table())
    body, start, end = joined(piece)
    counts = np.diff(piece.first)
    shingles = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    nth = np.arange(bounds[-1]) - np.repeat(bounds[:-1], shingles)
    head = np.repeat(piece.first[:-1], shingles) + nth
    tail = np.minimum(head + size, np.repeat(piece.first[1:], shingles)) - 1
    out = np.zeros(len(texts), dtype=np.uint64)
    h = np.concatenate([xxh64(body, start[head[a : a + PART]], end[tail[a : a + PART]]) for a in range(0, len(head), PART)] or [out[:0]])
    for i in np.flatnonzero(counts):
        own = h[bounds[i] : bounds[i + 1]]
        votes = np.zeros(64, dtype=np.int64)
        for a in range(0, len(own), PART):
            bits = np.unpackbits(own[a : a + PART].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(0, dtype=np.int64)
        out[i] = np.packbits(votes * 2 > len(own), bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, keep: list[str], size: int = 3, name: str = "fp") -> DataFrame:
    """Columns `keep` and the fingerprint of each text as a signed 64-bit number."""

    def fn(batch, texts):
        return [_fingerprints(texts, size).view(np.int64)]

    return map_texts(docs, fn, [T.StructField(name, T.LongType())], keep)


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs (a, b) of different fingerprints, a < b, that differ by at most `distance` bits (3 or fewer).

    fps: one column fp without repeats. Rows that meet under several chains give one pair each; repeats are removed.
    Spark sizes exploded rows as what they are made of (4 and 68 for one), so the join is told not to broadcast them.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError("the chains are built for at most 3 differing bits")
    fp = F.col("fp")
    flips = [0, *(1 << b for b in range(WIDTH))]

    def key(i: int, flip: int = 0) -> Column:
        value = F.shiftleft(_segment(fp, i), WIDTH).bitwiseOR(_segment(fp, i + 1).bitwiseXOR(F.lit(flip)))
        return value.bitwiseOR(F.lit(i << (2 * WIDTH)))

    listed = fps.select(fp.alias("b"), F.explode(F.array(*[key(i) for i in range(SEGMENTS)])).alias("k"))
    asked = fps.select(fp.alias("a"), F.explode(F.array(*[key(i, x) for i in range(SEGMENTS) for x in flips])).alias("k2"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    first = F.shiftrightunsigned("k", 2 * WIDTH)  # the chain's first segment
    turned = F.shiftrightunsigned(diff, 0)
    third = F.lit(False)
    for i in range(SEGMENTS):  # the prefix of three segments from i: all but the segment before i
        rest = F.bit_count(turned) - F.bit_count(_segment(diff, i + SEGMENTS - 1))
        third = third | ((first == i) & (rest <= 2))
    near = (F.col("a") < F.col("b")) & third & (F.bit_count(diff) <= distance)
    return listed.hint("merge").join(asked, (F.col("k") == F.col("k2")) & near).select("a", "b").distinct()


def classes(docs: DataFrame, keep: list[str], size: int = 3, distance: int = 3) -> DataFrame:
    """Columns `keep` (doc_id among them), fp, root (a fingerprint of the component) and component_id, one row per row of docs."""
    fp = fresh(docs, "fp")
    marked = saved(fingerprints(docs, keep, size, fp))
    nodes = marked.groupBy(F.col(fp).alias("fp")).agg(F.min("doc_id").alias("least"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = nodes.select("fp").repartition(tasks, "fp")  # small now, 68 rows for one in the join
    linked = components(links(spread, distance))
    rooted = nodes.join(linked, nodes.fp == linked.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("fp__"), "root", "component_id")
    out = marked.join(named, marked[fp] == F.col("fp__"))
    return out.select(*[f"`{c}`" for c in keep], F.col(fp).alias("fp"), "root", "component_id")


def report(docs: DataFrame, size: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    out = classes(docs, ["doc_id"], size, distance)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 3, distance: int = 3) -> DataFrame:
    """One row of docs per component: the one with the smallest id, columns unchanged.

    Of several rows with that id the one with the smallest hash of its columns stays, equal rows counting as one. Ids,
    fingerprints and hashes are grouped; texts are shuffled once, to meet the hashes that stay.
    """
    inner, names = apart(docs)
    cells = [F.col(c) for c in inner.columns if not isinstance(inner.schema[c].dataType, T.MapType)]
    keyed = inner.withColumns({"k1": F.xxhash64(*cells), "k2": F.xxhash64(F.lit("second"), *cells)})
    ids = classes(keyed.select("doc_id", "text", "k1", "k2"), ["doc_id", "k1", "k2"], size, distance)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2"))
    stay = ids.groupBy("root").agg(first.alias("s")).select("s.k1", "s.k2")
    kept = keyed.join(stay, ["k1", "k2"], "left_semi")
    again = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    once = kept.withColumn("again", again).where("again = 1")
    return once.select(*[F.col(names[c]).alias(c) for c in docs.columns])
