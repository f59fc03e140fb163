"""Business metrics, windows, top-k, states and user metrics."""

import functools

from pyspark.sql import functions as F

from catalog.common import day, load, money, query, rounded, settled, ts
from lakepipe.functions.times import monday
from lakepipe.operators import metrics, quantiles, states
from lakepipe.operators.dedupe import keep_latest
from lakepipe.plans import first_touch
from lakepipe.plans.metric import Metric
from lakepipe.session import materialize, shared_dir

DS = "2024-01-15"


def page_hits(spark, sf):
    """Events as page hits: user = lead, event type = source, one 'click' in four without a source."""
    e = load(spark, sf, "events")
    source = F.when((F.col("event_type") == "click") & (F.col("event_id") % 4 == 0), "").when(
        F.col("event_type") != "signup", F.col("event_type")
    )
    return e.select(
        F.col("user_id").alias("lead_id"),
        F.col("ts").alias("date_hit"),
        (F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 600).cast("decimal(18,6)"))).alias("end"),
        "event_id",
        source.alias("source"),
        F.get_json_object("props", "$.k").alias("k"),
    ).select(
        "*",
        F.when(F.col("event_id") % 3 != 0, F.col("end")).alias("date_left"),
        F.concat(F.lit("/p/"), "k").alias("url"),
        F.when(F.col("event_id") % 7 == 0, "").otherwise(F.concat(F.lit("C"), F.col("event_id") % 5)).alias("country"),
        F.when(F.col("event_id") % 2 == 0, F.lit("https://r.org")).alias("referer"),
    )


_HITS = """hits AS (SELECT user_id AS lead_id, ts AS date_hit, event_id,
  CASE WHEN event_type = 'signup' OR (event_type = 'click' AND event_id % 4 = 0) THEN 'direct' ELSE event_type END AS source,
  json_extract_string(props, '$.k') AS k FROM events)"""

_ATTRIBUTION = f"""SELECT {day('date_hit')} AS metric_date, source AS traffic_source,
  count(DISTINCT h.lead_id) AS unique_leads, count(*) AS total_visits,
  count(DISTINCT CASE WHEN date_hit = first THEN h.lead_id END) AS first_touch_leads,
  {rounded('CAST(count(*) AS DOUBLE) / count(DISTINCT h.lead_id)', 2)} AS visits_per_lead
FROM hits h JOIN (SELECT lead_id, min(date_hit) AS first FROM hits GROUP BY lead_id) f ON h.lead_id = f.lead_id
WHERE {{where}} GROUP BY ALL"""


@query(
    "flagship_attribution",
    f"WITH {_HITS} " + _ATTRIBUTION.format(where="CAST(date_hit AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-15'"),
)
def flagship_attribution(spark, sf):
    return metrics.attribution_by_source(page_hits(spark, sf), "2024-01-02", DS)


@query(
    "attribution_one_day",
    f"WITH {_HITS} " + _ATTRIBUTION.format(where="CAST(date_hit AS DATE) = DATE '2024-01-01'"),
)
def attribution_one_day(spark, sf):
    return metrics.attribution_by_source(page_hits(spark, sf), "2024-01-01")


@query(
    "page_hits_daily",
    f"""SELECT {day('ts')} AS metric_date, CASE WHEN event_id % 7 = 0 THEN 'Unknown' ELSE 'C' || (event_id % 5) END AS country,
      count(*) AS total_hits, count(DISTINCT user_id) AS unique_leads, count(DISTINCT props) AS unique_urls,
      {rounded("avg(CASE WHEN event_id % 3 != 0 THEN event_id % 600 END)", 4)} AS avg_time_on_page_seconds,
      count(*) FILTER (event_id % 2 = 0) AS hits_with_referer,
      {rounded("count(*) FILTER (event_id % 2 = 0) * 100.0 / count(*)", 2)} AS referer_rate
    FROM events GROUP BY ALL""",
)
def page_hits_daily(spark, sf):
    out = metrics.page_hits_daily(page_hits(spark, sf))
    return out.withColumn("avg_time_on_page_seconds", settled("avg_time_on_page_seconds", 4))


@query(
    "lead_daily_stats",
    f"""WITH l AS (SELECT o_orderkey, o_orderdate, o_custkey, CASE WHEN o_orderkey % 5 != 0 THEN o_custkey % 100 END AS points,
        o_orderkey % 3 = 0 AS identified FROM orders)
    SELECT {day('o_orderdate')} AS metric_date, count(*) AS new_leads, count(*) FILTER (identified) AS identified_leads,
      CAST(sum(coalesce(points, 0)) AS BIGINT) AS total_points, {rounded('avg(coalesce(points, 0))', 4)} AS avg_points,
      max(coalesce(points, 0)) AS max_points, count(*) FILTER (o_orderkey % 2 = 0) AS leads_with_email,
      count(*) FILTER (o_orderkey % 4 >= 2) AS leads_with_company, count(*) AS leads_with_phone,
      {rounded('count(*) FILTER (identified) * 100.0 / count(*)', 2)} AS identification_rate
    FROM l GROUP BY ALL""",
)
def lead_daily_stats(spark, sf):
    k, when = F.col("o_orderkey"), F.col("o_orderdate")
    leads = load(spark, sf, "orders").select(
        when.alias("date_added"),
        F.when(k % 3 == 0, when).alias("date_identified"),
        F.when(k % 5 != 0, F.col("o_custkey") % 100).alias("points"),
        F.when(k % 2 == 0, "a@b.c").otherwise("").alias("email"),
        F.when(k % 4 >= 2, "Acme").alias("company"),
        F.lit("1").alias("phone"),
    )
    return metrics.lead_daily_stats(leads).withColumn("avg_points", settled("avg_points", 4))


def users(spark, sf):
    """Customers as users: two snapshot days, tenant = segment, age from the first order."""
    first = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.min("o_orderdate")).alias("created_date")
    )
    c = load(spark, sf, "customer").join(first, "c_custkey")
    days = F.explode(F.array(F.lit("1996-06-30").cast("date"), F.lit("1996-12-31").cast("date")))
    df = c.withColumn("processing_date", days).filter(F.col("created_date") <= F.col("processing_date"))
    active = F.when(F.col("c_custkey") % 10 < 7, 1).when(F.col("c_custkey") % 10 < 9, 0)
    return df.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("organization_id"),
        "processing_date",
        "created_date",
        active.alias("is_active"),
        F.when(active == 1, "active").when(active == 0, "inactive").otherwise("unknown").alias("status"),
        F.concat(F.lit("d"), F.col("c_nationkey") % 8, F.lit(".org")).alias("email_domain"),
        F.datediff("processing_date", "created_date").alias("user_age_days"),
    )


_USERS = """u AS (SELECT c_custkey AS user_id, c_mktsegment AS org, d AS md, created, c_custkey % 10 AS t,
    'd' || (c_nationkey % 8) || '.org' AS dom, date_diff('day', created, d) AS age
  FROM customer JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS created FROM orders GROUP BY 1) o ON o_custkey = c_custkey,
    (VALUES (DATE '1996-06-30'), (DATE '1996-12-31')) v(d) WHERE created <= d)"""


@query(
    "user_daily_metrics",
    f"""WITH {_USERS}, ranked AS (SELECT md, org, dom, row_number() OVER (PARTITION BY md, org ORDER BY count(*) DESC, dom) AS r
       FROM u GROUP BY md, org, dom),
     tops AS (SELECT md, org, to_json(list(dom ORDER BY r)) AS top_email_domains FROM ranked WHERE r <= 5 GROUP BY 1, 2)
    SELECT {day('md')} AS metric_date, org AS organization_id, count(DISTINCT user_id) AS total_users,
      count(DISTINCT CASE WHEN t < 7 THEN user_id END) AS active_users,
      count(DISTINCT CASE WHEN t IN (7, 8) THEN user_id END) AS inactive_users,
      count(DISTINCT CASE WHEN created = md THEN user_id END) AS new_users,
      count(DISTINCT CASE WHEN t < 7 THEN user_id END) AS status_active,
      count(DISTINCT CASE WHEN t IN (7, 8) THEN user_id END) AS status_inactive,
      count(DISTINCT CASE WHEN age <= 30 THEN user_id END) AS users_0_30_days,
      count(DISTINCT CASE WHEN age > 30 AND age <= 90 THEN user_id END) AS users_31_90_days,
      count(DISTINCT CASE WHEN age > 90 AND age <= 365 THEN user_id END) AS users_91_365_days,
      count(DISTINCT CASE WHEN age > 365 THEN user_id END) AS users_over_1_year,
      {rounded('avg(age)', 4)} AS avg_user_age_days, min(age) AS min_user_age_days, max(age) AS max_user_age_days,
      quantile_cont(age, 0.5) AS median_user_age_days, CAST(any_value(top_email_domains) AS VARCHAR) AS top_email_domains
    FROM u JOIN tops USING (md, org) GROUP BY md, org""",
)
def user_daily_metrics(spark, sf):
    out = metrics.user_daily(users(spark, sf))
    return out.withColumn("avg_user_age_days", settled("avg_user_age_days", 4))


@query(
    "user_daily_counts",
    f"""WITH {_USERS}
    SELECT {day('md')} AS metric_date, org AS organization_id, count(DISTINCT user_id) AS total_users,
      count(*) FILTER (t < 7) AS active_users, count(*) FILTER (t IN (7, 8)) AS inactive_users,
      {rounded('avg(age)', 4)} AS avg_user_age_days, min(age) AS min_user_age_days, max(age) AS max_user_age_days,
      quantile_cont(age, 0.5) AS median_user_age_days, {rounded('quantile_cont(age, 0.95)', 4)} AS p95_user_age_days
    FROM u WHERE md = DATE '1996-12-31' GROUP BY md, org""",
)
def user_daily_counts(spark, sf):
    out = metrics.user_daily_counts(users(spark, sf), "1996-12-31")
    return out.withColumns({c: settled(c, 4) for c in ("avg_user_age_days", "p95_user_age_days")})


def _value_states():
    return [
        states.State("records", "count"),
        states.State("avg_value", "avg", "value"),
        states.State("max_value", "max", "value"),
        states.State("min_value", "min", "value"),
        states.State("total_value", "sum", "value"),
        states.State("users", "uniq", "user_id"),
    ]


@query(
    "weekly_states_merge",
    f"""SELECT {day("date_trunc('week', ts)")} AS week_start, count(*) AS records, {rounded('avg(value)', 4)} AS avg_value,
      max(value) AS max_value, min(value) AS min_value, {rounded('sum(value)', 2)} AS total_value, true AS users_close
    FROM events GROUP BY 1""",
)
def weekly_states_merge(spark, sf):
    events = load(spark, sf, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    by_day = states.partial_states(events, [F.to_date("ts").alias("day")], _value_states())
    weekly = states.merge_states(by_day.withColumn("week_start", F.to_date(F.date_trunc("week", "day"))), ["week_start"])
    final = states.finalize_states(weekly, _value_states())
    week = F.to_date(F.date_trunc("week", "ts")).alias("week_start")
    exact = events.groupBy(week).agg(F.count_distinct("user_id").alias("exact"))
    close = F.abs(F.col("users") - F.col("exact")) <= F.greatest(F.lit(2), F.col("exact") * 0.08)
    out = final.join(exact, "week_start").withColumn("users_close", close).drop("users", "exact")
    return out.withColumns({"avg_value": settled("avg_value", 4), "total_value": settled("total_value", 2)})


@query(
    "weekly_engagement",
    f"""SELECT {day("date_trunc('week', ts)")} AS week_start, count(*) AS total_records, {rounded('avg(user_id)', 4)} AS avg_points,
      max(user_id) AS max_points, min(user_id) AS min_points, CAST(sum(user_id) AS BIGINT) AS total_points,
      count(DISTINCT event_id) = count(*) AS total_leads
    FROM events GROUP BY 1""",
)
def weekly_engagement(spark, sf):
    leads = load(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("points"), F.col("ts").alias("date_added")
    )
    out = states.finalize_states(states.weekly_engagement(leads), states.ENGAGEMENT)
    close = F.abs(F.col("total_leads") - F.col("total_records")) <= F.greatest(F.lit(2), F.col("total_records") * 0.08)
    return out.withColumn("total_leads", close).withColumn("avg_points", settled("avg_points", 4))


@query(
    "summing_merge",
    f"""SELECT event_type, {day('ts')} AS day, count(*) AS hits, {money('value')} AS total FROM events GROUP BY ALL""",
)
def summing_merge(spark, sf):
    e = load(spark, sf, "events")
    keys = ["event_type", F.to_date("ts").alias("day")]
    part = lambda df: df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("hits"), metrics.exact_sum("value").alias("total")
    )
    parts = part(e.filter("event_id % 2 = 0")).unionByName(part(e.filter("event_id % 2 = 1")))
    return states.summing_merge(parts, ["event_type", "day"])


def purchases(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.lit("main").alias("organization_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("order_value"),
        F.to_date("o_orderdate").alias("first_purchase_date"),
        F.to_date("o_orderdate").alias("last_purchase_date"),
        F.to_date("o_orderdate").alias("processing_date"),
    )


_SUMMARY = """s AS (SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS DATE) AS first_d, CAST(max(o_orderdate) AS DATE) AS last_d,
   count(DISTINCT o_orderkey) AS n, round(fsum(o_totalprice), 6) AS rev,
   date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-01-01') AS recency,
   date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS life
  FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2001-01-01' GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 2)"""


@query(
    "customer_summary",
    f"""WITH {_SUMMARY} SELECT customer_id, 'main' AS organization_id, {day('first_d')} AS first_purchase_date,
      {day('last_d')} AS last_purchase_date, n AS total_orders, rev AS total_revenue, {rounded('rev / n', 2)} AS avg_order_value,
      recency AS recency_days, n AS frequency, rev AS monetary, life AS customer_lifespan_days, '2001-01-01' AS calculation_date
    FROM s""",
)
def customer_summary(spark, sf):
    out = metrics.customer_summary(purchases(spark, sf), "2001-01-01", 2)
    return out.withColumn("avg_order_value", settled("avg_order_value", 2))


@query(
    "rfm_segments",
    f"""WITH {_SUMMARY}, e AS (SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS er, quantile_cont(n, [0.2, 0.4, 0.6, 0.8]) AS ef,
       quantile_cont(rev, [0.2, 0.4, 0.6, 0.8]) AS em FROM s),
     q AS (SELECT s.*, 5 - (recency > er[1])::INT - (recency > er[2])::INT - (recency > er[3])::INT - (recency > er[4])::INT AS rs,
       1 + (n > ef[1])::INT + (n > ef[2])::INT + (n > ef[3])::INT + (n > ef[4])::INT AS fs,
       1 + (rev > em[1])::INT + (rev > em[2])::INT + (rev > em[3])::INT + (rev > em[4])::INT AS ms FROM s, e)
    SELECT customer_id, CAST(rs AS BIGINT) AS recency_score, CAST(fs AS BIGINT) AS frequency_score, CAST(ms AS BIGINT) AS monetary_score,
      CAST(rs + fs + ms AS BIGINT) AS rfm_score,
      CASE WHEN rs + fs + ms >= 13 THEN 'Champions' WHEN rs + fs + ms >= 10 THEN 'Loyal Customers'
           WHEN rs + fs + ms >= 7 THEN 'Potential Loyalists' WHEN rs + fs + ms >= 5 THEN 'At Risk' ELSE 'Lost' END AS customer_segment,
      CASE WHEN life = 0 THEN 1 ELSE life END AS customer_lifespan_days,
      {rounded('rev / n * (n / (CASE WHEN life = 0 THEN 1 ELSE life END / 365.0)) * 3 * 0.2', 2)} AS predicted_clv,
      {rounded('n / (CASE WHEN life = 0 THEN 1 ELSE life END / 365.0)', 6)} AS purchase_rate, {rounded('rev / n', 4)} AS avg_order_value
    FROM q""",
)
def rfm_segments(spark, sf):
    summary = materialize(metrics.customer_summary(purchases(spark, sf), "2001-01-01", 2), "customers")
    scored = metrics.rfm(summary)
    return scored.select(
        "customer_id",
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_score",
        "customer_segment",
        "customer_lifespan_days",
        "predicted_clv",
        settled("purchase_rate", 6).alias("purchase_rate"),
        settled("avg_order_value", 4).alias("avg_order_value"),
    )


@query(
    "group_quantiles",
    f"""SELECT l_returnflag, l_linestatus, {rounded('quantile_cont(l_extendedprice, 0.05)', 4)} AS p05,
      {rounded('quantile_cont(l_extendedprice, 0.5)', 4)} AS p50, {rounded('quantile_cont(l_extendedprice, 0.95)', 4)} AS p95
    FROM lineitem GROUP BY 1, 2""",
)
def group_quantiles(spark, sf):
    lines = load(spark, sf, "lineitem")
    q = quantiles.exact_quantiles(lines, "l_extendedprice", (0.05, 0.5, 0.95), ["l_returnflag", "l_linestatus"])
    named = {n: F.round(F.col("quantiles")[i], 4) for i, n in enumerate(("p05", "p50", "p95"))}
    return q.withColumns(named).drop("quantiles")


@query(
    "table_quantiles",
    f"""SELECT {rounded('quantile_cont(l_quantity, 0.25)', 4)} AS q1, {rounded('quantile_cont(l_quantity, 0.75)', 4)} AS q3,
      max(l_quantity) AS top FROM lineitem""",
)
def table_quantiles(spark, sf):
    q = quantiles.exact_quantiles(load(spark, sf, "lineitem"), "l_quantity", (0.25, 0.75, 1.0))
    return q.select(*[F.round(F.col("quantiles")[i], 4).alias(n) for i, n in enumerate(("q1", "q3", "top"))])


@query(
    "revenue_growth",
    f"""WITH d AS (SELECT c_mktsegment AS org, CAST(o_orderdate AS DATE) AS md, {money('o_totalprice')} AS total, avg(o_totalprice) AS mean,
       stddev_samp(o_totalprice) AS sd, count(*) AS n, count(DISTINCT o_custkey) AS customers
     FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
     g AS (SELECT *, lag(total) OVER (PARTITION BY org ORDER BY md) AS prev FROM d)
    SELECT org AS organization_id, {day('md')} AS metric_date, total AS total_revenue, {rounded('total / n', 2)} AS avg_revenue,
      coalesce({rounded('sd', 2)}, 0) AS std_revenue, n AS transaction_count, customers AS unique_customers,
      {rounded('total / customers', 2)} AS revenue_per_customer, coalesce({rounded('sd / (total / n)', 4)}, 0) AS revenue_coefficient_of_variation,
      coalesce(prev, 0) AS prev_day_revenue, coalesce({rounded('(total - prev) / prev * 100', 2)}, 0) AS revenue_growth_rate
    FROM g""",
)
def revenue_growth(spark, sf):
    c = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("organization_id")
    )
    o = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("processing_date"),
        F.col("o_totalprice").alias("revenue"),
    )
    out = metrics.revenue_metrics(o.join(c, "customer_id"))
    return out.withColumns(
        {
            "avg_revenue": settled("avg_revenue", 2),
            "std_revenue": settled("std_revenue", 2),
        }
    )


@query(
    "top_values",
    """WITH n AS (SELECT l_returnflag || l_linestatus AS flags, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL),
     c AS (SELECT *, row_number() OVER (PARTITION BY flags ORDER BY n DESC, l_partkey) AS r FROM n)
    SELECT flags, CAST(to_json(list(l_partkey ORDER BY r)) AS VARCHAR) AS top_parts FROM c WHERE r <= 5 GROUP BY 1""",
)
def top_values(spark, sf):
    lines = load(spark, sf, "lineitem").withColumn("flags", F.concat("l_returnflag", "l_linestatus"))
    return metrics.top_values(lines, ["flags"], "l_partkey", 5, "top_parts")


@query(
    "group_summary",
    f"""SELECT l_returnflag, count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_ids, round(fsum(net), 4) AS total,
      {rounded('avg(net)', 6)} AS average, min(net) AS minimum, max(net) AS maximum
    FROM (SELECT *, l_extendedprice * 0.001 * l_discount AS net FROM lineitem) AS l GROUP BY 1""",
)
def group_summary(spark, sf):
    lines = load(spark, sf, "lineitem").withColumn("net", F.col("l_extendedprice") * 0.001 * F.col("l_discount"))
    out = metrics.group_summary(lines, ["l_returnflag"], "l_orderkey", "net")
    return out.withColumns({"average": settled("average", 6), "total": F.round("total", 4)})


@query(
    "latest_events",
    f"SELECT {ts('ts')} AS ts, event_id, event_type FROM events ORDER BY events.ts DESC, event_id LIMIT 50",
)
def latest_events(spark, sf):
    e = load(spark, sf, "events").select("ts", "event_id", "event_type")
    return metrics.top_n(e, [F.desc("ts"), F.asc("event_id")], 50)


@query(
    "metric_hybrid",
    f"""WITH e AS (SELECT user_id, event_type, {money('value')} AS spent FROM events WHERE CAST(ts AS DATE) <= DATE '{DS}' GROUP BY ALL)
    SELECT user_id, spent, event_type AS favourite, '{DS}' AS as_of FROM e
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY spent DESC, event_type) = 1""",
)
def metric_hybrid(spark, sf):
    def favourite(spend, ds, **context):
        best = keep_latest(spend, ["user_id"], ["spent DESC", "event_type"])
        return best.withColumnsRenamed({"event_type": "favourite"}).withColumn("as_of", F.lit(ds))

    sql = """SELECT user_id, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM shop_events
             WHERE toDate(ts) <= toDate('{{ ds }}') GROUP BY user_id, event_type"""
    metric = Metric("favourites", sql=sql, fn=favourite, required=("user_id", "spent", "favourite"), numeric=("spent",))
    return metric.run(spark, {"shop_events": load(spark, sf, "events")}, DS)


@query(
    "first_touch_daily",
    f"WITH {_HITS} " + _ATTRIBUTION.format(where="CAST(date_hit AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'"),
)
def first_touch_daily(spark, sf):
    hits, table = page_hits(spark, sf), first_touch.first_touch_table(spark, shared_dir(spark, "touches"))
    first_touch.load_history(hits, table, "2024-01-10")
    days = [f"2024-01-{d}" for d in range(10, 16)]
    out = [first_touch.attribution_day(hits, table, d) for d in days]
    return functools.reduce(lambda a, b: a.unionByName(b), out)


_WEEKLY = """w AS (SELECT date_trunc('week', l_shipdate) AS week_start, l_extendedprice AS x FROM lineitem)"""


@query(
    "weekly_quantile_states",
    f"""WITH {_WEEKLY} SELECT {day('week_start')} AS week_start, count(*) AS n,
      {rounded('quantile_cont(x, 0.5)', 4)} AS median, {rounded('quantile_cont(x, 0.95)', 4)} AS p95 FROM w GROUP BY 1""",
)
def weekly_quantile_states(spark, sf):
    """Daily sketches are stored, merged to weeks, and each week's median and p95 held against the exact ranks."""
    lines = load(spark, sf, "lineitem").select("l_shipdate", F.col("l_extendedprice").alias("x"))
    spec = [states.State("n", "count"), states.State("q", "quantiles", "x")]
    daily = materialize(states.partial_states(lines, ["l_shipdate"], spec), "daily")
    weeks = daily.withColumn("week_start", monday("l_shipdate")).drop("l_shipdate")
    weekly = materialize(states.finalize_states(states.merge_states(weeks, ["week_start"]), spec), "weekly")
    dated = lines.withColumn("week_start", monday("l_shipdate"))
    exact = quantiles.exact_quantiles(dated, "x", (0.5, 0.95), ["week_start"])
    below = dated.join(weekly.select("week_start", "q"), "week_start").groupBy("week_start").agg(
        *[F.sum((F.col("x") < F.col("q")[i]).cast("long")).alias(f"less{i}") for i in range(2)],
        *[F.sum((F.col("x") <= F.col("q")[i]).cast("long")).alias(f"upto{i}") for i in range(2)],
    )
    checked = weekly.join(exact, "week_start").join(below, "week_start")
    for i, p in enumerate((0.5, 0.95)):
        slack = states.KLL_ERROR * F.col("n") + 1
        near = (F.col(f"less{i}") <= p * F.col("n") + slack) & (F.col(f"upto{i}") >= p * F.col("n") - slack)
        wrong = F.raise_error(F.lit("a sketch is off by more than its error")).cast("double")
        checked = checked.withColumn(f"e{i}", F.when(near, F.round(F.col("quantiles")[i] * (1 + 1e-12), 4)).otherwise(wrong))
    return checked.select("week_start", "n", F.col("e0").alias("median"), F.col("e1").alias("p95"))


@query(
    "frequent_values",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 0.011 * (SELECT count(*) FROM lineitem)",
)
def frequent_values(spark, sf):
    return metrics.frequent_values(load(spark, sf, "lineitem"), "l_suppkey", 0.011)
