"""Writing partitioned folders and catalog tables."""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.operators.dedupe import keep_latest, replacing_merge
from lakepipe.operators.profile import observed


def add_date_parts(df: DataFrame, ts: str, parts: Sequence[str] = ("year", "month", "day"), prefix: str = "") -> DataFrame:
    """Year / month / day columns of a timestamp; nothing when the column is absent."""
    if ts not in df.columns:
        return df
    made = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({prefix + p: made[p](F.col(ts).cast("timestamp")) for p in parts})


def _laid_out(df: DataFrame, by: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    # rebalance gives each partition folder few files, and splits a partition that
    # holds a large share of the rows over several tasks
    if by:
        df = df.hint("rebalance", *by)
    return df.sortWithinPartitions(*by, *sort) if sort else df


OPEN_FILES = 8  # partition files that a task keeps open before it sorts the rest of its rows


@contextlib.contextmanager
def _unsorted(spark: SparkSession, sort: Sequence[str] = ()) -> Iterator[None]:
    """Within it, writers of partition folders keep a few files open instead of sorting all rows of a task first.

    A task that ``_laid_out`` gives one large partition then holds no rows at all.  A wanted ``sort`` stays as it is.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(name, None)
    spark.conf.set(name, str(0 if sort else OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and something was written to it."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(root) and any(not s.getPath().getName().startswith("_") for s in fs.listStatus(root))


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    fmt: str = "parquet",
    mode: str = "overwrite_partitions",
    sort: Sequence[str] = (),
) -> None:
    """Write partition folders.

    "overwrite_partitions" replaces only partitions that receive rows,
    "overwrite" everything, "append" adds.  NULL partition values go to the
    default partition.  ``sort`` clusters rows inside files for min/max skipping.
    """
    if mode not in ("overwrite_partitions", "overwrite", "append"):
        raise ValueError(f"unknown write mode {mode!r}")
    writer = _laid_out(df, by, sort).write.format(fmt).option("compression", "snappy")
    if mode == "overwrite_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.option("partitionOverwriteMode", "static").mode(mode)
    with _unsorted(df.sparkSession, sort):
        (writer.partitionBy(*by) if by else writer).save(path)


def merge_partitions(
    new: DataFrame, path: str, keys: Sequence[str], version: str, by: Sequence[str], sort: Sequence[str] = ()
) -> None:
    """Merge ``new`` into stored partitions: the highest version per key wins.

    Only partitions that receive rows are read and rewritten; NULL is a partition
    like any other.  A key must not move between partitions.
    """
    stored = new.sparkSession.read.parquet(path)
    touched = new.select(*[F.col(c).alias(f"_in_{c}") for c in by]).distinct()
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in by])
    old = stored.join(touched, same, "left_semi")
    write_partitions(replacing_merge(old, new, keys, version), path, by, sort=sort)


def extract_table(
    source: DataFrame, out: str, partition_col: str | None = None, fmt: str = "orc", chunk_rows: int | None = None
) -> None:
    """Full copy of a source table, in folders by the date of a column when given.

    ``chunk_rows`` bounds the rows of a file; every row is written.
    """
    if partition_col is None:
        writer = source.write.format(fmt).mode("overwrite")
        (writer.option("maxRecordsPerFile", chunk_rows) if chunk_rows else writer).save(out)
        return
    dated = _laid_out(source.withColumn("partition", F.to_date(partition_col)), ["partition"])
    writer = dated.write.format(fmt).option("compression", "snappy").mode("overwrite").partitionBy("partition")
    with _unsorted(source.sparkSession):
        (writer.option("maxRecordsPerFile", chunk_rows) if chunk_rows else writer).save(out)


def publish(
    df: DataFrame, name: str, partitions: Sequence[str] = (), mode: str = "overwrite", path: str | None = None
) -> None:
    """Load a catalog table, creating it (at ``path``, if given) when missing."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown publish mode {mode!r}")
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        writer = _laid_out(df, partitions).write.format("parquet")
        writer = writer.option("path", path) if path else writer
        with _unsorted(spark):
            (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)
        return
    # insertInto goes by position
    rows = _laid_out(df, partitions).select(*spark.table(name).columns)
    with _unsorted(spark):
        rows.write.option("partitionOverwriteMode", "static").insertInto(name, overwrite=mode == "overwrite")


def new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence = ()) -> DataFrame:
    """Rows whose key the target does not hold yet, one per key (first by ``order``)."""
    held = target.select(*keys).distinct()
    return keep_latest(df, keys, order).join(held, list(keys), "left_anti")


def insert_new(df: DataFrame, path: str, keys: Sequence[str], order: Sequence = (), fmt: str = "parquet") -> None:
    """Append the rows of ``df`` whose key is not at ``path`` yet."""
    target = df.sparkSession.read.format(fmt).load(path)
    new_rows(df, target, keys, order).write.format(fmt).mode("append").save(path)


def append_counted(df: DataFrame, path: str, fmt: str = "parquet", **options) -> int:
    """Append to a sink and return the number of rows written (counted during the write)."""
    counted, watch = observed(df, "append")
    writer = counted.write.format(fmt).options(**options).mode("append")
    writer.save() if fmt == "jdbc" else writer.save(path)
    return watch.get["rows"]


def retained(df: DataFrame, date_col: str, days: int, as_of: str) -> DataFrame:
    """Rows not older than ``days`` at ``as_of``."""
    return df.filter(F.col(date_col) >= F.date_sub(F.lit(as_of).cast("date"), days))


def drop_expired(spark: SparkSession, table: str, date_col: str, days: int, as_of: str) -> int:
    """Drop whole partitions older than ``days`` without reading any rows; returns how many."""
    limit = dt.date.fromisoformat(as_of) - dt.timedelta(days)
    value = F.regexp_extract("partition", rf"(?:^|/){re.escape(date_col)}=([^/]*)", 1)
    expired = value.try_cast("date") < F.lit(limit)  # the default partition has no date
    names = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").where(expired).collect()]
    old = []
    for name in names:
        parts = dict(p.split("=", 1) for p in name.split("/"))
        old.append("PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in parts.items()) + ")")
    if old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(old)}")
    return len(old)


def with_load_columns(df: DataFrame, table: str, system: str, run_id: str, as_of: str) -> DataFrame:
    at = F.lit(as_of).cast("timestamp")
    return df.withColumns(
        {
            "__ingestion_time": at,
            "__extraction_time": at,
            "__source_system": F.lit(system),
            "__run_id": F.lit(run_id),
            "__table_fqn": F.lit(table),
        }
    )


def land_with_audit(
    df: DataFrame, path: str, table: str, system: str, run_id: str, started: str, by: Sequence[str] = ()
) -> DataFrame:
    """Write a table with load columns; returns its one-row audit record."""
    counted, watch = observed(with_load_columns(df, table, system, run_id, started), "land")
    write_partitions(counted, path, by, mode="overwrite")
    rows = watch.get["rows"]
    return df.sparkSession.range(1).select(
        F.lit(table).alias("table_fqn"),
        F.lit(run_id).alias("run_id"),
        F.lit(system).alias("source_system"),
        F.lit(path).alias("path"),
        F.lit(rows).cast("bigint").alias("rows_written"),
        F.lit(started).cast("timestamp").alias("start_utc"),
        F.current_timestamp().alias("end_utc"),
    )
