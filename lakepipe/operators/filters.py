"""Row filters."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions import as_col
from lakepipe.functions.dialect import spark_expr
from lakepipe.functions.numeric import default_null
from lakepipe.functions.text import blank_to_null


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conditions, F.lit(True))


def present(df: DataFrame, name: str) -> Column:
    """NOT NULL, and not '' for text or not 0 for numbers."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(kind, T.NumericType):
        return c.isNotNull() & (c != 0)
    return c.isNotNull()


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(all_of([present(df, c) for c in cols]))


def exclude_sentinel(df: DataFrame, c: str, sentinel: str = "NONE") -> DataFrame:
    return df.filter(F.col(c) != sentinel)


def exclude_both(df: DataFrame, a: str, b: str) -> DataFrame:
    """Drop rows where both flags are set; NULL flags count as false.

    The flags are coalesced before the test, since ``NOT (NULL AND TRUE)`` is
    NULL and would drop the row.
    """
    both = default_null(a, False) & default_null(b, False)
    return df.filter(~both)


def on_date(df: DataFrame, partition: str, ds: str) -> DataFrame:
    """Rows of one run date; kept on the raw partition column so it prunes."""
    return df.filter(F.col(partition) == F.lit(ds).cast(df.schema[partition].dataType))


def lookback(df: DataFrame, partition: str, ds: str, days: int | None = 90) -> DataFrame:
    """Rows of the last ``days`` days up to ``ds``; all rows with ``days=None``."""
    if days is None:
        return df
    kind = df.schema[partition].dataType
    low = F.date_sub(F.lit(ds).cast("date"), days).cast(kind)
    high = F.date_add(F.lit(ds).cast("date"), 1).cast(kind)
    return df.filter((F.col(partition) >= low) & (F.col(partition) < high))


def non_empty_json(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNotNull() & ~F.col(c).isin("", "[]"))


# Status words of processed rows.
DONE = ("completed", "done")


def skip_done(df: DataFrame, status: str, done: Sequence[str] = DONE) -> DataFrame:
    """Drop processed rows; NULL status is kept."""
    word = F.lower(F.trim(F.col(status)))
    return df.filter(word.isNull() | ~word.isin(list(done)))


def status_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "status" in c.lower()]


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows missing a required value; blank, null and none count as missing."""
    cols = [c for c in cols if c in df.columns]
    conditions = [
        (blank_to_null(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)).isNotNull() for c in cols
    ]
    return df.filter(all_of(conditions)) if cols else df


def apply_rules(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Keep rows for which every SQL predicate holds."""
    for rule in rules:
        df = df.filter(spark_expr(rule))
    return df


def for_tenant(df: DataFrame, column: str, tenant: str | Sequence[str]) -> DataFrame:
    c = as_col(column)
    return df.filter(c == tenant if isinstance(tenant, str) else c.isin(list(tenant)))


def tenants(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank tenant ids."""
    return require_keys(df.select(column), [column]).distinct()


def exclude_names(df: DataFrame, c, patterns: Sequence[str]) -> DataFrame:
    c = as_col(c)
    return df.filter(all_of([~c.rlike(p) for p in patterns]))
