"""Function names in declared SQL snippets and their Spark names.

Declarations are written in a warehouse dialect.  Most of it is standard SQL;
the names below are the ones that differ only in spelling.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.times import best_effort_sql

# Fixed values.
RENAMED = {
    "toString": "string",
    "toDate": "to_date",
    "toDateTime": "to_timestamp",
    "toInt32": "int",
    "toInt64": "bigint",
    "toFloat64": "double",
    "toUInt8": "smallint",
    "toYear": "year",
    "toMonth": "month",
    "countIf": "count_if",
    "trimBoth": "trim",
    "replaceAll": "replace",
    "replaceRegexpAll": "regexp_replace",
    "lengthUTF8": "length",
    "today": "current_date",
    "assumeNotNull": "",
    "match": "rlike",
    "toMonday": "monday_of",
    "toDateTime64": "time_with_scale",
    "parseDateTime64BestEffortOrNull": "best_effort_time",
}

# SQL functions for what Spark has no single function for; differences count
# unit boundaries.  Catalyst inlines their bodies.
FUNCTIONS = {
    "day_boundaries": ("a TIMESTAMP, b TIMESTAMP", "BIGINT", "datediff(b, a)"),
    "minute_boundaries": (
        "a TIMESTAMP, b TIMESTAMP",
        "BIGINT",
        "(unix_timestamp(date_trunc('MINUTE', b)) - unix_timestamp(date_trunc('MINUTE', a))) DIV 60",
    ),
    "second_boundaries": ("a TIMESTAMP, b TIMESTAMP", "BIGINT", "unix_timestamp(b) - unix_timestamp(a)"),
    "monday_of": ("d DATE", "DATE", "to_date(date_trunc('WEEK', d))"),
    "time_with_scale": ("t TIMESTAMP, s INT", "TIMESTAMP", "t"),
    "best_effort_time": (
        "t STRING",
        "TIMESTAMP",
        best_effort_sql("t"),
    ),
}

_NAME = re.compile(r"\b(" + "|".join(RENAMED) + r")\s*\(")
_DIFF = re.compile(r"\bdateDiff\(\s*'(day|minute|second)'\s*,", re.I)
_COUNT = re.compile(r"\bcount\(\s*\)", re.I)
_DISTINCT = re.compile(r"\b(?:countDistinct|uniqExact)\(")


def spark_text(sql: str) -> str:
    sql = _NAME.sub(lambda m: RENAMED[m.group(1)] + "(", sql)
    sql = _DIFF.sub(lambda m: f"{m.group(1).lower()}_boundaries(", sql)
    return _DISTINCT.sub("count(DISTINCT ", _COUNT.sub("count(*)", sql))


def add_functions(spark: SparkSession, sql: str) -> None:
    """Define the SQL functions a text uses in the session."""
    for name, (args, kind, body) in FUNCTIONS.items():
        if f"{name}(" in sql:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")


def spark_expr(sql: str) -> Column:
    text = spark_text(sql)
    add_functions(SparkSession.active(), text)
    return F.expr(text)
