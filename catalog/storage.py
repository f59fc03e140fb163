"""Sources, sinks and incremental jobs: each writes to the shared folder and reads back."""

from pyspark.sql import functions as F

from catalog.common import SQL, day, load, money, query, rounded, settled
from catalog.timelines import AS_OF, ORDERS, _EVENTS, order_rows
from lakepipe.operators import metrics, states
from lakepipe.plans.backfill import backfill
from lakepipe.session import shared_dir
from lakepipe.sources import readers, writers
from lakepipe.sources.deltas import DeltaTable
from lakepipe.streaming import incremental as inc


def _dated_events(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("processing_date")
    )


@query(
    "partitioned_read",
    f"""SELECT {day('ts')} AS processing_date, '0' || (user_id % 3) AS tenant, count(*) AS n, 'none' AS absent
    FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL""",
)
def partitioned_read(spark, sf):
    path = shared_dir(spark, "raw")
    df = _dated_events(spark, sf).withColumn("tenant", F.concat(F.lit("0"), F.col("user_id") % 3))
    writers.write_partitions(df, path, ["tenant", "processing_date"], "orc", "overwrite")
    raw = readers.read_raw(
        spark,
        path,
        "orc",
        [{"name": "event_id", "type": "Int64"}, {"name": "added_later", "type": "Nullable(String)"}],
        {"tenant": "String", "processing_date": "Date"},
    )
    rows = raw.filter(F.col("processing_date") >= F.lit("2024-01-10").cast("date"))
    absent = F.coalesce(F.max("added_later"), F.lit("none")).alias("absent")
    return rows.groupBy("processing_date", "tenant").agg(F.count(F.lit(1)).alias("n"), absent)


@query(
    "merged_schema_read",
    """SELECT l_returnflag AS part, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_linenumber END) AS BIGINT) AS extra
    FROM lineitem GROUP BY 1""",
)
def merged_schema_read(spark, sf):
    path = shared_dir(spark, "raw")
    lines = load(spark, sf, "lineitem").withColumn("part", F.col("l_returnflag"))
    narrow, wide = lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag != 'A'")
    writers.write_partitions(narrow.select("l_orderkey", "part"), path, ["part"], mode="append")
    writers.write_partitions(wide.select("l_orderkey", "l_linenumber", "part"), path, ["part"], mode="append")
    raw = readers.read_raw(spark, path, partitions={"part": "String"}, pattern="*.parquet")
    total = F.coalesce(F.sum("l_linenumber"), F.lit(0)).alias("extra")
    return raw.groupBy("part").agg(F.count(F.lit(1)).alias("n"), total)


@query(
    "csv_read",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'missing' ELSE c_name END AS name,
      CASE WHEN c_custkey % 4 = 0 THEN 'missing' ELSE c_mktsegment END AS segment FROM customer""",
)
def csv_read(spark, sf):
    path = shared_dir(spark, "csv")
    k = F.col("c_custkey")
    out = load(spark, sf, "customer").select(
        k.alias(" ID "),
        F.when(k % 5 == 0, "null").otherwise(F.col("c_name")).alias("Name"),
        F.when(k % 4 == 0, "NA").otherwise(F.concat(F.lit(" "), "c_mktsegment")).alias("Segment"),
    )
    out.write.option("header", True).csv(path)
    df = readers.read_csv(spark, path, multiline=False)
    missing = [F.coalesce(c, F.lit("missing")).alias(c) for c in ("name", "segment")]
    return df.select(F.col("id").cast("bigint").alias("id"), *missing)


@query(
    "csv_typed_publish",
    f"""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n, {money('o_totalprice')} AS total
    FROM orders GROUP BY 1, 2""",
)
def csv_typed_publish(spark, sf):
    path, out = shared_dir(spark, "csv"), shared_dir(spark, "published")
    load(spark, sf, "orders").write.option("header", True).csv(path)
    df = writers.add_date_parts(readers.read_csv_typed(spark, path), "o_orderdate", ("year", "month"))
    writers.write_partitions(df, out, ["year", "month"], mode="overwrite", sort=["o_custkey"])
    back = spark.read.parquet(out)
    total = F.round(metrics.exact_sum("o_totalprice").cast("double"), 6).alias("total")
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), total)


@query(
    "extract_by_date",
    f"""SELECT {day('ts')} AS "partition", count(*) AS n, min(event_id) AS low FROM events GROUP BY 1""",
)
def extract_by_date(spark, sf):
    path = shared_dir(spark, "extract")
    writers.extract_table(load(spark, sf, "events"), path, "ts")
    raw = readers.read_raw(spark, path, "orc", partitions={"partition": "Date"})
    return raw.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("low"))


@query(
    "publish_table",
    """SELECT year(o_orderdate) AS year, CAST(count(*) * 2 AS BIGINT) AS n, CAST(sum(o_custkey) * 2 AS BIGINT) AS customers
    FROM orders GROUP BY 1""",
)
def publish_table(spark, sf):
    path = shared_dir(spark, "catalog")
    name = "published_" + path.rsplit("-", 1)[-1]
    df = writers.add_date_parts(load(spark, sf, "orders").select("o_orderdate", "o_custkey"), "o_orderdate", ("year",))
    for mode in ("overwrite", "overwrite", "append"):
        writers.publish(df, name, ["year"], mode, path)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    totals = (F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"))
    return spark.read.parquet(path).groupBy("year").agg(*totals)


@query("chunked_extract", "SELECT l_returnflag, count(*) AS n, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS files_needed FROM lineitem GROUP BY 1")
def chunked_extract(spark, sf):
    path = shared_dir(spark, "chunks")
    lines = load(spark, sf, "lineitem").hint("rebalance", "l_returnflag").sortWithinPartitions("l_returnflag")
    writers.extract_table(lines, path, chunk_rows=5000)
    per_file = spark.read.orc(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    small = F.assert_true(F.col("n") <= 5000, "a file holds more rows than its chunk")
    held = per_file.select(F.coalesce(small, F.lit(0)).alias("over")).agg(F.sum("over").alias("over"))
    rows = spark.read.orc(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    needed = F.ceil(F.col("n") / 5000.0) + held.select("over").scalar()
    return rows.withColumn("files_needed", needed.cast("bigint"))


@query(
    "partition_overwrite",
    f"""SELECT {day('ts')} AS processing_date, count(*) AS n,
      CAST(sum(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' THEN 1 ELSE 0 END) AS BIGINT) AS replaced FROM events GROUP BY 1""",
)
def partition_overwrite(spark, sf):
    path = shared_dir(spark, "table")
    df = _dated_events(spark, sf).withColumn("replaced", F.lit(0))
    writers.write_partitions(df, path, ["processing_date"], mode="overwrite")
    again = df.filter(F.col("processing_date") == F.lit("2024-01-05").cast("date")).withColumn("replaced", F.lit(1))
    writers.write_partitions(again, path, ["processing_date"])
    back = spark.read.parquet(path)
    return back.groupBy("processing_date").agg(F.count(F.lit(1)).alias("n"), F.sum("replaced").alias("replaced"))


@query(
    "merge_null_partitions",
    """SELECT coalesce(p, 'none') AS p, CAST(CASE WHEN event_id % 8 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version, count(*) AS n
    FROM (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN event_type END AS p FROM events) AS e GROUP BY ALL""",
)
def merge_null_partitions(spark, sf):
    path = shared_dir(spark, "merged")
    part = F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("p")
    old = load(spark, sf, "events").select("event_id", part, F.lit(1).alias("version"))
    writers.write_partitions(old, path, ["p"], mode="overwrite")
    new = old.filter("event_id % 8 = 0").withColumn("version", F.lit(2))
    writers.merge_partitions(new, path, ["event_id"], "version", ["p"])
    back = spark.read.parquet(path)
    return back.groupBy(F.coalesce("p", F.lit("none")).alias("p"), "version").agg(F.count(F.lit(1)).alias("n"))


@query(
    "insert_new_rows",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS origin FROM customer""",
)
def insert_new_rows(spark, sf):
    path = shared_dir(spark, "target")
    c = load(spark, sf, "customer").select("c_custkey")
    old = c.filter("c_custkey % 3 != 0").withColumn("origin", F.lit("old"))
    writers.append_counted(old, path)
    offered = c.withColumn("origin", F.lit("new"))
    writers.insert_new(offered.unionByName(offered), path, ["c_custkey"])
    return spark.read.parquet(path)


@query(
    "append_counted",
    "SELECT count(*) AS reported, count(*) AS stored FROM orders WHERE o_orderstatus = 'O'",
)
def append_counted(spark, sf):
    path = shared_dir(spark, "sink")
    n = writers.append_counted(load(spark, sf, "orders").filter("o_orderstatus = 'O'"), path)
    return spark.read.parquet(path).agg(F.lit(n).alias("reported"), F.count(F.lit(1)).alias("stored"))


@query(
    "backfill_range",
    f"""SELECT {day('ts')} AS processing_date, event_type, count(*) AS hits FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09' GROUP BY ALL""",
)
def backfill_range(spark, sf):
    path = shared_dir(spark, "hits")
    build = lambda df: df.groupBy("processing_date", "event_type").agg(F.count(F.lit(1)).alias("hits"))
    backfill(_dated_events(spark, sf), "processing_date", "2024-01-03", "2024-01-09", build, path)
    return spark.read.parquet(path)


@query(
    "retention",
    "SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-02-01' - 20",
)
def retention(spark, sf):
    return writers.retained(load(spark, sf, "events"), "ts", 20, "2024-02-01").select("event_id")


def _stream_of(spark, sf, table):
    """The table as a stream; the pattern matches a single file as well as a folder of files."""
    schema = load(spark, sf, table).schema
    return inc.stream_folder(spark, f"{sf}/{table}.parque[t]", schema)


@query(
    "stream_timeline",
    f"""WITH {_EVENTS} SELECT event_type, strftime(rec_add, '%Y%m') AS month, count(*) AS cnt, min(entity_id) AS first_entity
    FROM timeline GROUP BY 1, 2""",
)
def stream_timeline(spark, sf):
    base = shared_dir(spark, "stream")
    rows = order_rows(_stream_of(spark, sf, "orders"))
    for _ in range(2):  # the second run finds nothing new
        inc.append_timeline(rows, ORDERS, f"{base}/timeline", f"{base}/progress", as_of=AS_OF).awaitTermination()
    back = spark.read.option("basePath", f"{base}/timeline").parquet(f"{base}/timeline")
    return back.groupBy("event_type", F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("entity_id").alias("first_entity")
    )


_STREAM_STATES = [
    states.State("hits", "count"),
    states.State("avg_value", "avg", "value"),
    states.State("top_value", "max", "value"),
]


@query(
    "stream_metric",
    f"""SELECT event_type, {day('ts')} AS day, count(*) AS hits, {rounded('avg(value)', 4)} AS avg_value, max(value) AS top_value
    FROM events GROUP BY ALL""",
)
def stream_metric(spark, sf):
    base = shared_dir(spark, "metric")
    prepare = lambda df: df.withColumns({"day": F.to_date("ts"), "value": F.col("value").cast("decimal(18,2)")})
    args = (["event_type", "day"], _STREAM_STATES, f"{base}/partials", f"{base}/progress", prepare)
    for _ in range(2):
        inc.maintain_metric(_stream_of(spark, sf, "events"), *args).awaitTermination()
    inc.compact_metric(spark, f"{base}/partials", f"{base}/compact", ["event_type", "day"])
    out = inc.read_metric(spark, f"{base}/compact", ["event_type", "day"], _STREAM_STATES)
    return out.withColumn("avg_value", settled("avg_value", 4))


@query(
    "stream_messages",
    f"""SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS bucket, count(*) AS n FROM events GROUP BY 1, 2""",
)
def stream_messages(spark, sf):
    base = shared_dir(spark, "messages")
    raw = _stream_of(spark, sf, "events").select(
        F.to_json(F.struct("user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))).alias("value")
    )
    shape = "user_id BIGINT, k BIGINT"
    from pyspark.sql.types import StructType

    parsed = inc.parse_messages(raw, StructType.fromDDL(shape)).withColumn("bucket", F.col("k") % 4)
    inc.append_stream(parsed, f"{base}/out", f"{base}/progress", ["bucket"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("user_id", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("stream_metric_upsert", SQL["stream_metric"])
def stream_metric_upsert(spark, sf):
    base = shared_dir(spark, "metric")
    prepare = lambda df: df.withColumns({"day": F.to_date("ts"), "value": F.col("value").cast("decimal(18,2)")})
    events, progress = load(spark, sf, "events"), f"{base}/progress"
    for n, part in enumerate(("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2")):  # each touches all days
        events.where(part).write.mode("append").parquet(f"{base}/source")
        arrived = inc.stream_folder(spark, f"{base}/source", events.schema)
        inc.upsert_metric(arrived, ["event_type"], ["day"], _STREAM_STATES, f"{base}/table", progress, prepare).awaitTermination()
    inc.upsert_batch(prepare(events.where("event_id % 3 = 2")), 2, ["event_type"], ["day"], _STREAM_STATES, f"{base}/table")  # again
    return inc.read_upserted(spark, f"{base}/table", _STREAM_STATES).withColumn("avg_value", settled("avg_value", 4))


@query(
    "merge_on_read",
    """SELECT event_id, CAST(CASE WHEN event_id % 6 = 0 THEN 3 WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version,
      CASE WHEN event_id % 6 = 0 THEN 'third' WHEN event_id % 2 = 0 THEN 'second' ELSE event_type END AS event_type FROM events""",
)
def merge_on_read(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.lit(1).alias("version"), "event_type")
    table = DeltaTable(spark, shared_dir(spark, "merged"), ["event_id"], ["version DESC"], rows.schema)
    newer = lambda part, n, name: rows.where(part).withColumns({"version": F.lit(n), "event_type": F.lit(name)})
    table.merge(rows, 0)
    table.merge(newer("event_id % 2 = 0", 2, "second"), 1)
    table.merge(newer("event_id % 6 = 0", 3, "third"), 2)
    table.merge(newer("event_id % 12 = 0", 1, "late and old"), 3)
    table.merge(rows.withColumn("version", F.lit(9)), 3)  # that change is there already
    table.compact(most=2)
    return table.read()
