"""A bounded sample of labelled texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import map_texts


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 0 when divided by 5; a null id is held out, as nothing can be learnt from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def within(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of labels whose id is one of docs'; a null id is none."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return labels.withColumn("doc_id", F.col("doc_id").cast("long")).join(ids, "doc_id", "left_semi")


def sample(docs: DataFrame, labels: DataFrame, label: Column, rows: int, encode: Callable, learn: Column) -> list[tuple[bytes, int]]:
    """What encode makes of at most `rows` labelled documents per label value, and the values.

    label: the class, a small integer expression over the columns of labels (null: the row is left out); an id that is
    labelled more than once takes the smallest, and rows that share an id give one, that with the smallest encoding. encode: texts to one bytes value each, run on the executors. learn: which
    ids may be learnt from. The rows taken are those whose ids have the smallest hashes, the same on each run.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
        .where(learn)
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    ys = [r["y"] for r in known.select("y").distinct().limit(64).collect()]
    order = [F.xxhash64(F.col("doc_id"), F.lit(7)), F.col("doc_id")]
    taken = None
    for y in sorted(ys):
        part = known.where(F.col("y") == y).orderBy(*order).limit(rows)
        taken = part if taken is None else taken.unionByName(part)
    if taken is None:
        return []
    # at most 64 x rows ids, so the broadcast is bounded
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(taken), "doc_id")
    out = map_texts(found, lambda batch, texts: [encode(texts)], [T.StructField("f", T.BinaryType())], ["doc_id", "y"])
    one = out.groupBy("doc_id", "y").agg(F.min("f").alias("f"))  # so that no id brings more than a row to the driver
    got = sorted((r["doc_id"], r["y"], bytes(r["f"])) for r in one.collect())
    return [(f, y) for _, y, f in got]
