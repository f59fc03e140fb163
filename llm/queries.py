"""The dealt operators as queries over whole tables, and their SQL where DuckDB can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import (
    align,
    decontaminate,
    licenses,
    lines,
    mixing,
    personal,
    quality,
    secrets,
    simhash,
    sketches,
    sqltext,
    substrings,
    treeweight,
    tries,
)
from llm.frames import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return wrap


@query("op1_secret_scan", sqltext.secrets())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(load(spark, sf_dir, "documents"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(load(spark, sf_dir, "documents"))


@query("op3_line_dedup", sqltext.LINES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(load(spark, sf_dir, "documents"))


@query("op4_personal_data")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(load(spark, sf_dir, "documents"))


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(load(spark, sf_dir, "documents"))


@query("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.report(load(spark, sf_dir, "documents"))


@query("op7_substring_dedup", sqltext.SUBSTRINGS)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(load(spark, sf_dir, "documents"))


@query("op8_benchmark_decontamination", sqltext.DECONTAMINATE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op10_mixing_weights")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op11_language_model")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treeweight.report(load(spark, sf_dir, "documents"))


@query("op12_conversation_trie", sqltext.TRIES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.report(load(spark, sf_dir, "conversations"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.report(load(spark, sf_dir, "documents"))
