"""Reading raw folders, CSV files and relational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions.text import na_to_null
from lakepipe.types import spark_schema, spark_type

# CSV texts read as missing.
NA_TOKENS = ("", "NA", "NaN", "null", "NULL", "None", "NONE")


def read_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | list[dict] | None = None,
    partitions: dict[str, str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """A partitioned raw folder, without copying it.

    A given schema is fixed: columns some files lack come back NULL.  Without
    one it is inferred and merged over all files.  ``partitions`` names folder
    columns and their types; they are never guessed from the folder names, so
    '007' stays text unless declared a number.
    """
    reader = spark.read.format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if isinstance(schema, list):
        schema = spark_schema(schema)
    if schema is None:
        schema = reader.option("mergeSchema", True).load(path).schema
    kinds = {name: spark_type(kind) for name, kind in (partitions or {}).items()}
    fields = [f for f in schema.fields if f.name not in kinds]
    full = T.StructType(fields + [T.StructField(n, k) for n, k in kinds.items()])
    return reader.schema(full).load(path)


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_csv(spark: SparkSession, path: str, na: Sequence[str] = NA_TOKENS, multiline: bool = False) -> DataFrame:
    """CSV as text: trimmed lower-case headers, listed tokens as NULL.

    ``multiline`` allows line breaks inside quoted fields; a file is one task then,
    while files without them split over many tasks.
    """
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .csv(path)
    )
    df = clean_names(df)
    return df.select(*[na_to_null(F.trim(F.col(f"`{c}`")), na).alias(c) for c in df.columns])


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 64,
    fetch_rows: int = 50_000,
    **properties,
) -> DataFrame:
    """A relational table, read in parallel ranges of ``split_on`` when given.

    Without ``bounds`` the smallest and largest value are asked for first, in the database.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **properties}
    if split_on and bounds is None:
        ends = f"(SELECT min({split_on}) AS low, max({split_on}) AS high FROM {table}) ends"
        bounds = tuple(spark.read.format("jdbc").options(**{**options, "dbtable": ends}).load().first())
    if split_on and None not in bounds:  # an empty table has no bounds
        low, high = bounds
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return spark.read.format("jdbc").options(**options).load()
