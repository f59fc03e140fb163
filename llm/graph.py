"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import saved

MAX_ROUNDS = 60


def _large(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and the node itself are linked to the smallest of them. Edges have a > b."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    rest = e.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(rest).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has an edge; root is the smallest node of its component.

    edges: two columns of one orderable type, any direction, repeats and loops allowed. Joins are on the node, with the
    smallest neighbour pre-aggregated, so the star of a hot node splits over tasks. Each round is kept in the shared
    checkpoint folder; the rounds grow with the logarithm of the largest component.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    e = saved(e)
    mark = None
    for _ in range(MAX_ROUNDS):
        e = saved(_small(_large(e)))
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
