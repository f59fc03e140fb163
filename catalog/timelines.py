"""The event timeline and reports on it."""

from pyspark.sql import functions as F

from catalog.common import day, load, query, ts
from lakepipe.operators import checks, metrics
from lakepipe.plans import timeline as tl
from lakepipe.session import shared_dir

AS_OF = "2024-06-01"

ORDERS = tl.TimelineSpec.from_dict(
    {
        "source": {"database": "shop_silver", "table": "orders", "primary_key": "o_orderkey", "org_filter_column": "org"},
        "timeline": {
            "entity_type": "order",
            "events": [
                {
                    "type": "order_created",
                    "timestamp_field": "rec_add",
                    "timestamp_source": "rec_add",
                    "condition": "rec_add IS NOT NULL",
                    "description_template": "Order created: {o_orderpriority}",
                    "metadata": {"status": "COALESCE(o_orderstatus, '')", "customer": "toString(COALESCE(o_custkey, 0))", "backfill": "'true'"},
                },
                {
                    "type": "order_shipped",
                    "timestamp_field": "shipped",
                    "timestamp_source": "shipped",
                    "condition": "shipped IS NOT NULL AND (rec_add IS NULL OR shipped != rec_add)",
                    "description_template": "Order {o_orderkey} shipped to {upper(o_orderstatus)}",
                },
                {
                    "type": "order_updated",
                    "timestamp_field": "rec_edit",
                    "timestamp_source": "rec_edit",
                    "condition": "rec_edit IS NOT NULL AND rec_add IS NOT NULL AND rec_edit != rec_add",
                    "description_template": "Order updated (current state)",
                    "metadata": {"represents": "'final_state'"},
                },
            ],
        },
    }
)

POSITIONS = tl.TimelineSpec(
    source="book_silver.holdings",
    entity_type="holding",
    key="id",
    events=tl.position_events("units", "market_value", "cash", "as_of_date", {"units": "toString(abs(COALESCE(units, 0)))"}),
    system="book",
    tenant="org",
)


def order_rows(orders):
    """Orders as a clean table with created, shipped and edited times."""
    at, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey")
    plus = lambda days: at + F.make_dt_interval(days=days.cast("int"))
    return orders.select(
        "*",
        F.concat(F.lit("t"), F.col("o_custkey") % 3).alias("org"),
        at.alias("rec_add"),
        F.when(k % 4 != 0, plus(k % 5)).alias("shipped"),
        F.when(k % 2 == 0, plus(k % 8)).alias("rec_edit"),
        F.to_date(at).alias("processing_date"),
    )


_ROWS = """r AS (SELECT *, 't' || (o_custkey % 3) AS org, o_orderdate AS rec_add,
   CASE WHEN o_orderkey % 4 != 0 THEN o_orderdate + to_days(CAST(o_orderkey % 5 AS INT)) END AS shipped,
   CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + to_days(CAST(o_orderkey % 8 AS INT)) END AS rec_edit FROM orders)"""

_EVENTS = f"""{_ROWS}, e AS (
  SELECT org, o_orderkey, 'order_created' AS event_type, rec_add AS t, 'rec_add' AS src, 'Order created: ' || o_orderpriority AS description,
    '{{"status":"' || o_orderstatus || '","customer":"' || o_custkey || '","backfill":"true"}}' AS metadata, rec_add, rec_edit FROM r
  UNION ALL SELECT org, o_orderkey, 'order_shipped', shipped, 'shipped', 'Order ' || o_orderkey || ' shipped to ' || o_orderstatus, NULL, rec_add, rec_edit
    FROM r WHERE shipped IS NOT NULL AND shipped != rec_add
  UNION ALL SELECT org, o_orderkey, 'order_updated', rec_edit, 'rec_edit', 'Order updated (current state)', '{{"represents":"final_state"}}', rec_add, rec_edit
    FROM r WHERE rec_edit IS NOT NULL AND rec_edit != rec_add),
  timeline AS (SELECT *, 'order_' || o_orderkey AS entity_id FROM e)"""


def order_timeline(spark, sf):
    return tl.build_timeline(order_rows(load(spark, sf, "orders")), ORDERS, as_of=AS_OF)


@query(
    "timeline_orders",
    f"""WITH {_EVENTS}
    SELECT md5(org || '|' || entity_id || '|' || event_type || '|' || CAST(epoch_us(t) AS VARCHAR)) AS event_id, org AS org_id, event_type,
      {ts('t')} AS timestamp, src AS event_timestamp_source, 'order' AS entity_type, entity_id, description, 'shop' AS source_system,
      'shop_silver.orders' AS source_table, CAST(o_orderkey AS VARCHAR) AS source_id, {ts('rec_add')} AS rec_add,
      coalesce(metadata, '') AS metadata, {day('rec_add')} AS processing_date, '2024-06-01 00:00:00' AS _loaded_at, 1 AS _version
    FROM timeline""",
    integers=("_version",),
)
def timeline_orders(spark, sf):
    out = order_timeline(spark, sf).drop("minio_path", "rec_edit")
    return out.withColumn("metadata", F.coalesce("metadata", F.lit("")))


@query("timeline_one_tenant", f"WITH {_EVENTS} SELECT event_type, count(*) AS cnt FROM timeline WHERE org = 't1' GROUP BY 1")
def timeline_one_tenant(spark, sf):
    out = tl.build_timeline(order_rows(load(spark, sf, "orders")), ORDERS, tenant="t1", as_of=AS_OF)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


def position_rows(spark, sf):
    """Line items as position snapshots with signed units; every tenth one is cash."""
    k = F.col("l_orderkey")
    units = F.when(k % 3 == 0, -F.col("l_quantity")).when(k % 7 == 0, 0.0).otherwise(F.col("l_quantity"))
    return load(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.lit("t0").alias("org"),
        F.when(k % 11 != 0, units).alias("units"),
        (units * 100).alias("market_value"),
        (k % 10 == 0).alias("cash"),
        F.col("l_shipdate").alias("as_of_date"),
    )


@query(
    "timeline_positions",
    f"""WITH p AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, l_orderkey % 10 = 0 AS cash, l_shipdate,
        CASE WHEN l_orderkey % 3 = 0 THEN -l_quantity WHEN l_orderkey % 7 = 0 THEN 0 ELSE l_quantity END AS v,
        CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE (CASE WHEN l_orderkey % 3 = 0 THEN -l_quantity WHEN l_orderkey % 7 = 0 THEN 0 ELSE l_quantity END) END AS units
      FROM lineitem),
    e AS (SELECT *, 'holding_established' AS event_type, 'derived_from_transactions' AS src, 'Position established in account' AS d FROM p WHERE units != 0
      UNION ALL SELECT *, 'transaction_buy', 'derived', 'Purchase units in account' FROM p WHERE units > 0 AND NOT cash
      UNION ALL SELECT *, 'transaction_sell', 'derived', 'Sold units from account' FROM p WHERE units < 0
      UNION ALL SELECT *, 'transaction_deposit', 'as_of_date', 'Cash deposit - $' || CAST(v * 100 AS VARCHAR) FROM p WHERE cash AND v > 0
      UNION ALL SELECT *, 'transaction_withdrawal', 'as_of_date', 'Cash withdrawal - $' || CAST(abs(v * 100) AS VARCHAR) FROM p WHERE cash AND v < 0
      UNION ALL SELECT *, 'holding_closed', 'as_of_date', 'Position closed in account' FROM p WHERE units = 0)
    SELECT 'holding_' || id AS entity_id, event_type, src AS event_timestamp_source, {ts('l_shipdate')} AS timestamp, d AS description,
      '{{"units":"' || CAST(coalesce(abs(units), 0) AS VARCHAR) || '"}}' AS metadata
    FROM e""",
)
def timeline_positions(spark, sf):
    out = tl.build_timeline(position_rows(spark, sf), POSITIONS, as_of=AS_OF)
    return out.select("entity_id", "event_type", "event_timestamp_source", "timestamp", "description", "metadata")


ENTRIES = [
    tl.SourceEntry(ORDERS),
    tl.SourceEntry(POSITIONS, expected_min_events=10),
    tl.SourceEntry(tl.TimelineSpec("shop_silver.refunds", "refund", "id", []), enabled=False),
]


def assembled(spark, sf):
    tables = {ORDERS.source: order_rows(load(spark, sf, "orders")), POSITIONS.source: position_rows(spark, sf)}
    return tl.assemble(tables, ENTRIES, as_of=AS_OF)


_ALL_COUNTS = f"""WITH {_EVENTS}, v AS (SELECT l_orderkey % 10 = 0 AS cash,
    CASE WHEN l_orderkey % 3 = 0 THEN -l_quantity WHEN l_orderkey % 7 = 0 THEN 0 ELSE l_quantity END AS v, l_orderkey % 11 = 0 AS lost FROM lineitem)"""


@query(
    "timeline_assembled",
    _ALL_COUNTS
    + """ SELECT 'shop' AS source_system, event_type, count(*) AS cnt FROM timeline GROUP BY 2
    UNION ALL SELECT 'book', 'holding_established', count(*) FROM v WHERE NOT lost AND v != 0
    UNION ALL SELECT 'book', 'transaction_buy', count(*) FROM v WHERE NOT lost AND v > 0 AND NOT cash
    UNION ALL SELECT 'book', 'transaction_sell', count(*) FROM v WHERE NOT lost AND v < 0
    UNION ALL SELECT 'book', 'transaction_deposit', count(*) FROM v WHERE cash AND v > 0
    UNION ALL SELECT 'book', 'transaction_withdrawal', count(*) FROM v WHERE cash AND v < 0
    UNION ALL SELECT 'book', 'holding_closed', count(*) FROM v WHERE NOT lost AND v = 0""",
)
def timeline_assembled(spark, sf):
    return assembled(spark, sf).groupBy("source_system", "event_type").agg(F.count(F.lit(1)).alias("cnt"))


def _validation_sql(run: str, events: str, days: int, seconds: int) -> str:
    gap = lambda unit, t: f"date_diff('{unit}', {t}, TIMESTAMP '{AS_OF}')"
    rows = [("row_count", "warning", "n >= 1", "count(*)")]
    rows += [(f"not_null:{c}", "error", "n = 0", f"count(*) - count({c})") for c in ("event_id", "org_id", "event_type", "timestamp")]
    rows += [("min_events:shop_silver.orders", "warning", "n >= 1", "count(*) FILTER (src = 'shop')")]
    rows += [("min_events:book_silver.holdings", "warning", "n >= 10", "count(*) FILTER (src = 'book')")]
    rows += [("fresh:timestamp", "warning", f"n <= {days}", gap("day", "CAST(max(timestamp) AS DATE)"))]
    rows += [("lag:timestamp", "warning", f"n <= {seconds}", gap("second", "max(timestamp)"))]
    return "\nUNION ALL ".join(
        f"""SELECT '{run}' AS run, '{c}' AS "check", '{severity}' AS severity, {ok} AS ok, CAST(n AS DOUBLE) AS observed
        FROM (SELECT {n} AS n FROM {events})"""
        for c, severity, ok, n in rows
    )


@query(
    "timeline_validation",
    f"""WITH {_EVENTS}, v AS (SELECT l_orderkey % 10 = 0 AS cash, l_shipdate AS t, l_orderkey % 11 = 0 AS lost,
      CASE WHEN l_orderkey % 3 = 0 THEN -l_quantity WHEN l_orderkey % 7 = 0 THEN 0 ELSE l_quantity END AS v FROM lineitem),
    book AS (SELECT * FROM (SELECT unnest([CASE WHEN NOT lost AND v != 0 THEN 'holding_established' END, CASE WHEN NOT lost AND v > 0 AND NOT cash
      THEN 'transaction_buy' END, CASE WHEN NOT lost AND v < 0 THEN 'transaction_sell' END, CASE WHEN cash AND v > 0 THEN 'transaction_deposit' END,
      CASE WHEN cash AND v < 0 THEN 'transaction_withdrawal' END, CASE WHEN NOT lost AND v = 0 THEN 'holding_closed' END])
      AS event_type, t FROM v) WHERE event_type IS NOT NULL),
    whole AS (SELECT 'shop' AS src, md5(org || entity_id || event_type || t) AS event_id, org AS org_id, event_type, t AS timestamp FROM timeline
      UNION ALL SELECT 'book', md5(event_type || t), 't0', event_type, t FROM book),
    damaged AS (SELECT src, CASE WHEN org_id != 't1' THEN event_id END AS event_id, CASE WHEN org_id != 't2' THEN org_id END AS org_id,
      CASE WHEN event_type != 'order_shipped' THEN event_type END AS event_type, CASE WHEN event_type != 'order_updated' THEN timestamp END AS timestamp
      FROM whole WHERE src = 'shop')
    {_validation_sql("whole", "whole", 1, 300)} UNION ALL {_validation_sql("damaged", "damaged", 20000, 10**10)}""",
)
def timeline_validation(spark, sf):
    entries, whole = [e for e in ENTRIES if e.enabled], assembled(spark, sf)
    lost = lambda c, when: F.when(~when, F.col(c)).alias(c)
    damaged = whole.filter("source_system = 'shop'").select(
        "source_table",
        lost("event_id", F.col("org_id") == "t1"),
        lost("org_id", F.col("org_id") == "t2"),
        lost("event_type", F.col("event_type") == "order_shipped"),
        lost("timestamp", F.col("event_type") == "order_updated"),
    )
    out = None
    for run, df, lag in (("whole", whole, ()), ("damaged", damaged, (20000, 10**10))):
        found = checks.run_checks({"timeline": df}, tl.timeline_checks("timeline", entries, AS_OF, *lag))
        part = found.select(F.lit(run).alias("run"), "check", "severity", "ok", "observed")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "timeline_by_type",
    f"""WITH {_EVENTS} SELECT event_type, src AS event_timestamp_source, count(*) AS cnt, {ts('min(t)')} AS earliest, {ts('max(t)')} AS latest
    FROM timeline GROUP BY 1, 2""",
)
def timeline_by_type(spark, sf):
    return metrics.events_by_type(order_timeline(spark, sf))


@query(
    "timeline_by_source",
    f"""WITH {_EVENTS} SELECT 'shop_silver.orders' AS source_table, count(*) AS total_events, count(DISTINCT entity_id) AS unique_entities,
      count(rec_add) AS has_rec_add, count(rec_edit) AS has_rec_edit FROM timeline""",
)
def timeline_by_source(spark, sf):
    return metrics.events_by_source(order_timeline(spark, sf))


@query(
    "entity_lifecycle",
    f"""WITH {_EVENTS} SELECT entity_id, {day("date_trunc('year', t)")} AS period_start, 0 AS piece,
      CAST(to_json(list(event_type ORDER BY t, event_type)) AS VARCHAR) AS events,
      CAST(to_json(list(src ORDER BY t, event_type)) AS VARCHAR) AS sources, {ts('min(t)')} AS first_at
    FROM timeline GROUP BY 1, 2""",
    integers=("piece",),
)
def entity_lifecycle(spark, sf):
    out = metrics.entity_lifecycle(order_timeline(spark, sf), "year")
    return out.select("entity_id", "period_start", "piece", "events", "sources", F.col("timestamps")[0].alias("first_at"))


@query(
    "updated_entities",
    f"""WITH {_EVENTS} SELECT entity_id, count(*) FILTER (event_type = 'order_created') AS created_events,
      count(*) FILTER (event_type = 'order_updated') AS updated_events FROM timeline GROUP BY 1 HAVING updated_events > 0""",
)
def updated_entities(spark, sf):
    return metrics.updated_entities(order_timeline(spark, sf))


@query(
    "merged_timeline",
    f"""WITH {_EVENTS} SELECT event_type, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS _version, count(*) AS cnt
    FROM timeline GROUP BY 1, 2""",
)
def merged_timeline(spark, sf):
    old = order_timeline(spark, sf)
    new = old.filter(F.col("source_id").cast("bigint") % 3 == 0).withColumn("_version", F.lit(2))
    return tl.merge_timeline(old, new).groupBy("event_type", "_version").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "stored_timeline",
    f"""WITH {_EVENTS} SELECT org AS org_id, event_type, CAST(CASE WHEN rec_add >= TIMESTAMP '1998-01-01' AND rec_add < TIMESTAMP '1998-04-01'
        THEN 2 ELSE 1 END AS BIGINT) AS _version, count(*) AS cnt FROM timeline GROUP BY ALL""",
)
def stored_timeline(spark, sf):
    path = shared_dir(spark, "timeline")
    tl.store_timeline(order_timeline(spark, sf), path)
    quarter = "processing_date >= date'1998-01-01' AND processing_date < date'1998-04-01'"
    corrected = order_timeline(spark, sf).filter(quarter).withColumn("_version", F.lit(2))
    tl.store_timeline(corrected, path, merge=True)
    return spark.read.parquet(path).groupBy("org_id", "event_type", "_version").agg(F.count(F.lit(1)).alias("cnt"))
