"""Table inventories and load reports."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakepipe.operators.filters import exclude_names

MERGERS = 64


def _described(df: DataFrame, table: str, nulls, distinct) -> Column:
    """One struct per column: position, type, nullability and what the two functions say of column i."""
    return F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(i + 1).alias("ordinal"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
                nulls(i).alias("nulls"),
                distinct(i).alias("distinct_values"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )


def profile(df: DataFrame, table: str, exact: bool = False) -> DataFrame:
    """One row per column: position, type, nullability, NULLs and distinct values.

    Distinct counts are sketches from one aggregation.  ``exact=True`` counts them, when called: see ``distinct_counts``.
    """
    if not exact:
        aggs = []
        for i, c in enumerate(_columns(df)):
            aggs += [F.count_if(c.isNull()).alias(f"n{i}"), F.approx_count_distinct(c).alias(f"d{i}")]
        return df.agg(*aggs).select(F.inline(_described(df, table, lambda i: F.col(f"n{i}"), lambda i: F.col(f"d{i}"))))
    return _counted(df, table, distinct_counts({table: df})[table])


def _counted(df: DataFrame, table: str, found: list[tuple[int, int]]) -> DataFrame:
    count = lambda at: lambda i: F.lit(found[i][at]).cast("bigint")
    return df.sparkSession.range(1).select(F.inline(_described(df, table, count(0), count(1))))


def distinct_counts(tables: dict[str, DataFrame], sketch: int = 12) -> dict[str, list[tuple[int, int]]]:
    """NULLs and exact distinct values of each table's columns, in order.

    One aggregation per table, without copies of rows, gives every column a sketch that holds up to 2^sketch values exactly;
    the sketches of many tasks meet in up to ``MERGERS`` tasks before they meet in one.
    Columns with more are counted by one aggregation each, which reads that column alone: its values' hashes (96 bits) are
    collapsed within a task before anything is shuffled.  All tables share these two jobs; a row per column reaches the
    driver.
    """
    first = []
    for name, df in tables.items():
        parts, cells = [], []
        for i, c in enumerate(_columns(df)):
            value = F.when(c.isNotNull(), F.xxhash64(c))  # sketches skip empty texts and know no nested types
            parts += [F.count_if(c.isNull()).alias(f"n{i}"), F.theta_sketch_agg(value, F.lit(sketch)).alias(f"d{i}")]
            united = F.theta_sketch_estimate(F.theta_union_agg(f"d{i}", F.lit(sketch)))
            cells.append(F.struct(F.coalesce(F.sum(f"n{i}"), F.lit(0)), united))
        merged = df.groupBy((F.spark_partition_id() % MERGERS).alias("part")).agg(*parts)
        first.append(merged.agg(F.lit(name).alias("t"), F.array(*cells).alias("cells")))
    found = {r.t: [tuple(c) for c in r.cells] for r in _together(first).collect()}
    large = []
    for name, df in tables.items():
        for i, c in enumerate(_columns(df)):
            if found[name][i][1] >= 1 << sketch:  # below that the sketch is no estimate
                hashes = df.where(c.isNotNull()).select(F.xxhash64(c).alias("h"), F.hash(c).alias("g")).distinct()
                large.append(hashes.agg(F.lit(name).alias("t"), F.lit(i).alias("i"), F.count(F.lit(1)).alias("n")))
    counts = {(r.t, r.i): r.n for r in _together(large).collect()} if large else {}
    return {t: [(nulls, counts.get((t, i), n)) for i, (nulls, n) in enumerate(cells)] for t, cells in found.items()}


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{f.name}`") for f in df.schema.fields]


def _together(frames: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def listed(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, ordinal) of all columns, from the schemas; no data is read."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, f.name, i + 1) for t, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal int")


def profile_tables(tables: dict[str, DataFrame], exact: bool = False) -> DataFrame:
    if not exact:
        return _together([profile(df, name) for name, df in tables.items()])
    found = distinct_counts(tables)
    return _together([_counted(df, name, found[name]) for name, df in tables.items()])


def widest(columns: DataFrame, n: int = 3, exclude: Sequence[str] = ()) -> DataFrame:
    """The n tables with the most columns (ties by name)."""
    columns = exclude_names(columns, "table_name", exclude) if exclude else columns
    counts = columns.groupBy("table_name").agg(F.count(F.lit(1)).alias("col_count"))
    return counts.orderBy(F.desc("col_count"), F.asc("table_name")).limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, always counted: columnar files answer from their footers."""
    out = None
    for name, df in tables.items():
        part = df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit("exact").alias("row_count_method"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def inventory_summary(columns: DataFrame, counts: DataFrame, ds: str) -> DataFrame:
    """One row: number of tables, columns and rows, with its date for a dated folder."""
    totals = counts.agg(F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("rows"))
    width = columns.agg(F.count(F.lit(1)).alias("columns"))
    return totals.select(
        F.lit(ds).cast("date").alias("date"),
        "tables",
        width.select("columns").scalar().alias("columns"),
        "rows",
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they flow through an action, without a second pass."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def dropping(df: DataFrame, step: Callable[[DataFrame], DataFrame], name: str) -> tuple[DataFrame, Callable[[], int]]:
    """A step that drops rows, and how many it dropped, known once an action has run; nothing is read twice."""
    counted, before = observed(df, f"{name}_in")
    out, after = observed(step(counted), f"{name}_out")
    return out, lambda: before.get["rows"] - after.get["rows"]


def load_summary(
    spark,
    table: str,
    source: Observation,
    final: Observation,
    location: str,
    results: DataFrame | None = None,
    dropped: dict[str, Callable[[], int]] | None = None,
) -> DataFrame:
    """One-row report of a finished load: rows read, kept and dropped (also per step), failed checks, location."""
    before, after = source.get["rows"], final.get["rows"]
    row = spark.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(before).alias("source_rows"),
        F.lit(after).alias("final_rows"),
        F.lit(before - after).alias("dropped_rows"),
        F.lit(location).alias("location"),
        *[F.lit(count()).alias(f"dropped_{name}") for name, count in (dropped or {}).items()],
    )
    if results is None:
        return row.withColumn("failed_checks", F.lit(0).cast("bigint"))
    failed = results.agg(F.count_if(~F.col("ok")).alias("n"))
    return row.withColumn("failed_checks", failed.scalar())
