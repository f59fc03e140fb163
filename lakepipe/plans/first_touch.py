"""Attribution day by day from a stored table of first touches: a day's run reads that day and the state, not the history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators.metrics import if_null
from lakepipe.sources.deltas import DeltaTable

SCHEMA = T.StructType([T.StructField("lead_id", T.LongType()), T.StructField("first_ts", T.TimestampType()), T.StructField("source", T.StringType())])


def first_touch_table(spark: SparkSession, path: str, schema: T.StructType = SCHEMA) -> DeltaTable:
    """The earliest touch of each lead and its source; a change is a day, numbered from 1970."""
    return DeltaTable(spark, path, ["lead_id"], ["first_ts ASC", "source ASC"], schema)


def day_number(day: str) -> int:
    return (dt.date.fromisoformat(day) - dt.date(1970, 1, 1)).days


def _touches(hits: DataFrame) -> DataFrame:
    """One row per lead and source: hits and the earliest of them."""
    source = if_null("source", "direct", True).alias("source")
    return hits.where(F.col("lead_id").isNotNull()).groupBy("lead_id", source).agg(
        F.count(F.lit(1)).alias("hits"), F.min("date_hit").alias("first_ts")
    )


def load_history(hits: DataFrame, table: DeltaTable, before: str) -> None:
    """First touches of all days before ``before``, as one change: the start of the table."""
    table.merge(_touches(hits.where(F.col("date_hit") < F.lit(before).cast("date"))), day_number(before) - 1)


def attribution_day(hits: DataFrame, table: DeltaTable, day: str) -> DataFrame:
    """Visits, leads and first-touch leads per source of one day; the day's new leads are added to the table.

    Days are run in order.  A day that is run again sees the table as it was before it and adds nothing twice.  Hits that
    come in later for an earlier day lower a lead's first touch from then on; results of earlier days stay as they were.
    """
    date = F.lit(day).cast("date")
    todays = hits.where((F.col("date_hit") >= date) & (F.col("date_hit") < F.date_add(date, 1)))
    touches = _touches(todays)
    known = table.read(before=day_number(day)).select("lead_id", F.col("first_ts").alias("_known"))
    least = F.least(F.min("first_ts").over(Window.partitionBy("lead_id")), F.col("_known"))  # skips NULL
    touched = touches.join(known, "lead_id", "left").withColumn("_touch", F.col("first_ts") == least)
    table.merge(touched.where("_known IS NULL OR first_ts < _known"), day_number(day))
    rows, visits = F.count(F.lit(1)), F.sum("hits")
    return touched.groupBy(date.alias("metric_date"), F.col("source").alias("traffic_source")).agg(
        rows.alias("unique_leads"),
        visits.alias("total_visits"),
        F.count_if("_touch").alias("first_touch_leads"),
        F.round(visits / F.nullif(rows, F.lit(0)), 2).alias("visits_per_lead"),
    )
