"""Keeping one row per key.

All forms go through ``row_number() == 1``.  Spark prunes such a window before
the shuffle (WindowGroupLimit), so every map task ships at most one row per
key: a key holding a third of all rows costs its reducer one row per map task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions import as_col
from lakepipe.functions.dialect import spark_expr

_ORDER = re.compile(r"^(?P<e>.*?)(?:\s+(?P<d>ASC|DESC))?(?:\s+NULLS\s+(?P<n>FIRST|LAST))?$", re.I | re.S)


def sort_key(order: Column | str) -> Column:
    """'processing_timestamp DESC' as a sort column; NULLs come last unless said otherwise."""
    if isinstance(order, Column):
        return order
    m = _ORDER.match(order.strip())
    c, first = spark_expr(m["e"]), (m["n"] or "").upper() == "FIRST"
    if (m["d"] or "ASC").upper() == "DESC":
        return c.desc_nulls_first() if first else c.desc_nulls_last()
    return c.asc_nulls_first() if first else c.asc_nulls_last()


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, the last tie-breaker of every ordering."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(F.to_json(c) if isinstance(f.dataType, (T.MapType, T.VariantType)) else c)
    return F.xxhash64(*cols)


def keep_latest(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by the row hash.

    Keys and orderings may be column names, SQL expressions or Columns.
    """
    keys = [k if isinstance(k, Column) else spark_expr(k) for k in keys]
    w = Window.partitionBy(*keys).orderBy(*[sort_key(o) for o in order], row_hash(df))
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def replacing_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Union of old and new rows; the highest version per key wins, then the newer row."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_latest(both, keys, [F.col(version).desc_nulls_last(), F.col("_new").desc()]).drop("_new")


def keep_first(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """First row per key by an explicit order column (Spark rows have no file order)."""
    return keep_latest(df, keys, [as_col(order).asc_nulls_last()])


def keep_last(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    return keep_latest(df, keys, [as_col(order).desc_nulls_last()])
