"""A cleaning pipeline over documents: quality, repeated lines, near copies, benchmark passages, mixing.

Each stage gets what the one before kept, as a table that was written and read again, and returns the rows it keeps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from llm import decontaminate, lines, mixing, quality, simhash
from llm.frames import discard, load, shared_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat, but for one word at most, an earlier line; emptied ones go."""
    return lines.clean(docs)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their rate and copies; those that are read no time go."""
    return mixing.mix(docs, load(spark, sf_dir, "labels"))


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_per_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: The first stage learns from labels, which SQL cannot express; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents; what each keeps is written to the shared folder and read again.

    A stage's folder goes as soon as the next one is written; the last one's input stays, since its result reads it.
    """
    docs = load(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        out.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{i}")
        if i:
            discard(spark, f"{folder}/{i - 1}")
    return docs
