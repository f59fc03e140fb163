"""Re-running a date range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.sources.writers import write_partitions


def days(start: str, end: str) -> list[str]:
    """Every date from start to end, inclusive."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if last < first:
        raise ValueError(f"backfill range {start}..{end} is empty")
    return [(first + dt.timedelta(i)).isoformat() for i in range((last - first).days + 1)]


def in_range(df: DataFrame, partition: str, start: str, end: str) -> DataFrame:
    """Rows whose partition date lies in the range, inclusive (prunes partitions)."""
    kind = df.schema[partition].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return df.filter(F.col(partition).between(low, high))


def each_day(build: Callable[[str], DataFrame], start: str, end: str, path: str, by: str = "run_date") -> DataFrame:
    """The range's days, for builds that cannot take a range: each day is a job of its own that replaces its folder.

    No plan grows with the range, a day that fails leaves the finished ones, and a day without rows loses its old ones.
    """
    for ds in days(start, end):
        out = build(ds)
        out.write.mode("overwrite").parquet(f"{path}/{by}={ds}")
    stored = out.sparkSession.read.schema(T.StructType([*out.schema, T.StructField(by, T.DateType())])).parquet(path)
    return in_range(stored, by, start, end)


def backfill(
    source: DataFrame,
    partition: str,
    start: str,
    end: str,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    clear: bool = False,
) -> None:
    """One job for the whole range: build from the range's rows, replace its partitions.

    ``clear`` first drops everything at ``path``; otherwise only partitions that
    receive rows are replaced.
    """
    days(start, end)
    built = build(in_range(source, partition, start, end))
    write_partitions(built, path, [partition], mode="overwrite" if clear else "overwrite_partitions")
