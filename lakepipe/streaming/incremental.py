"""Incremental appends and incrementally maintained metrics.

All jobs use ``availableNow``: a run takes everything that arrived since the
last one and stops, so the first run is the backfill and no row is counted
twice.  Progress lives in the checkpoint folder.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakepipe.operators.states import State, finalize_states, merge_states, partial_states
from lakepipe.plans.timeline import TimelineSpec, build_timeline
from lakepipe.session import materialize
from lakepipe.sources import writers


def stream_folder(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files: int = 1000,
    max_bytes: str | None = None,
) -> DataFrame:
    """Files of a folder as they arrive.

    A batch takes at most ``max_files`` files, or ``max_bytes`` (such as "500g") when given, so the first run over a
    long history is many bounded batches; all of them run before the query ends.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    reader = reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def stream_topic(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """JSON messages of a topic (needs the Kafka connector on the classpath)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return parse_messages(raw, schema)


def parse_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of JSON messages held in ``value``."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def append_stream(
    df: DataFrame, path: str, checkpoint: str, by: Sequence[str] = (), fmt: str = "parquet"
) -> StreamingQuery:
    """Pass rows through to (partitioned) files, exactly once."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(*by) if by else writer).start(path)


def append_timeline(
    source: DataFrame, spec: TimelineSpec, path: str, checkpoint: str, tenant=None, as_of=None
) -> StreamingQuery:
    """Events of newly arrived rows, in the folders of the stored timeline: by tenant and month."""
    events = build_timeline(source, spec, tenant, as_of)
    month = F.coalesce(F.date_format("processing_date", "yyyyMM"), F.lit("none"))
    return append_stream(events.withColumn("month", month), path, checkpoint, ["org_id", "month"])


def maintain_metric(
    source: DataFrame,
    keys: Sequence,
    states: Sequence[State],
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Aggregate each arriving batch into partial states under ``path/batch=<id>``.

    A replayed batch overwrites its own folder, so at-least-once delivery still
    counts every row once.  ``read_metric`` merges the partials.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        partial_states(prepare(batch), keys, states).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_metric(spark: SparkSession, path: str, keys: Sequence[str], states: Sequence[State]) -> DataFrame:
    """Current values of a maintained metric."""
    return finalize_states(merge_states(spark.read.parquet(path).drop("batch"), keys), states)


def upsert_batch(batch: DataFrame, batch_id: int, keys: Sequence[str], by: Sequence[str], states: Sequence[State], path: str) -> None:
    """Add a batch's states to the stored rows of the partitions it touches; other partitions are not read or written.

    Storage holds one row per key.  Each stored row carries the number of the last batch that was added to its partition,
    so a batch that comes again, also after it had reached only some of its partitions, is added to the others alone.
    """
    new = partial_states(batch, [*keys, *by], states).withColumn("_batch", F.lit(batch_id).cast("long"))
    new = materialize(new, "batch")
    if writers.holds_data(batch.sparkSession, path):
        stored = batch.sparkSession.read.schema(new.schema).parquet(path)
        touched = new.select(*by).distinct()
        old = _semi(stored, touched, by, "left_semi")
        done = old.groupBy(*by).agg(F.max("_batch").alias("_done")).where(F.col("_done") >= batch_id).select(*by)
        new = materialize(_semi(new, done, by, "left_anti"), "batch")
        both = _semi(stored, new.select(*by).distinct(), by, "left_semi").unionByName(new)
        merged = merge_states(both, [*keys, *by]).withColumn("_batch", F.lit(batch_id).cast("long"))
        new = merged.select(*[F.col(f.name).cast(f.dataType) for f in new.schema.fields])  # a sum of sums is wider
    writers.write_partitions(new, path, by)


def _semi(df: DataFrame, some: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Rows of df whose partition is (or is not) among some; NULL is a partition like any other."""
    some = some.toDF(*[f"_in_{c}" for c in by])
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in by])
    return df.join(some, same, how)


def upsert_metric(
    source: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    states: Sequence[State],
    path: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Keep a stored table of states per ``keys``, in folders by ``by``, up to date with what arrives."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(prepare(batch), batch_id, keys, by, states, path)

    return (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, path: str, states: Sequence[State]) -> DataFrame:
    """Current values; nothing is left to merge."""
    return finalize_states(spark.read.parquet(path).drop("_batch"), states)


def compact_metric(spark: SparkSession, path: str, out: str, keys: Sequence[str]) -> None:
    """Merge all partials into one folder, as the partials of a new path.

    To go on from there, start the stream on the old progress folder and the new path: its next batch has a higher
    number than the compacted one, so it adds a folder beside it, and ``read_metric`` of the new path merges both.
    """
    merge_states(spark.read.parquet(path).drop("batch"), keys).write.mode("overwrite").parquet(f"{out}/batch=0")
