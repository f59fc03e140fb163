"""Registration and small helpers shared by the queries."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, integers: tuple[str, ...] = ()):
    """Register a query; its columns are converted by ``portable``.

    ``integers`` names SQL result columns that come out narrower than bigint.
    """
    if integers:
        wide = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in integers)
        sql = f"SELECT * REPLACE ({wide}) FROM ({sql})"

    def wrap(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return wrap


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Times and dates as text, arrays as JSON, integers as bigint, decimals as double."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def settled(c, digits: int) -> Column:
    """Half-up rounding with exact ties lifted, see ``rounded``."""
    return F.round(F.col(c) * (1 + 1e-12), digits)


# SQL text helpers


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def rounded(x: str, digits: int) -> str:
    """Half-up rounding; the tiny factor lifts exact ties that binary doubles store just below."""
    return f"round(({x}) * (1 + 1e-12), {digits})"


def money(x: str) -> str:
    """Sum of the values as they are, rounded once."""
    return f"round(fsum({x}), 6)"
