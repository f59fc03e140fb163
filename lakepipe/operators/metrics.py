"""Business metrics over clean tables.

Sums of money are taken on exact decimals, so results do not depend on the
order in which partitions arrive.  Metrics with several distinct counts first
aggregate per entity, which avoids multiplying every input row, and then
aggregate the small result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.functions import as_col, case
from lakepipe.functions.text import if_null
from lakepipe.functions.times import day_diff, second_diff
from lakepipe.operators.joins import HOT_ROWS
from lakepipe.operators.quantiles import exact_quantiles, score

EXACT = "decimal(38,10)"  # holds ten decimals of totals up to 10^28


def exact_sum(c) -> Column:
    """Sum that does not depend on the order of the rows; a value that is no number raises."""
    c = as_col(c)
    bad = F.raise_error(F.lit("a value to be summed is not a number")).cast(EXACT)
    return F.sum(F.when(F.isnan(c), bad).otherwise(c.cast(EXACT)))


def rate_pct(hits: Column, total: Column, digits: int = 2) -> Column:
    """100 * hits / total, NULL for an empty group."""
    return F.round(hits * 100.0 / F.nullif(total, F.lit(0)), digits)


def filled(c) -> Column:
    """Neither NULL nor ''."""
    c = as_col(c)
    return c.isNotNull() & (c != "")


def _days(df: DataFrame, ts: str, start: str | None, end: str | None) -> DataFrame:
    df = df.filter(F.col(ts).isNotNull())
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1))
    return df


def top_values(df: DataFrame, keys: Sequence[str], value: str, k: int = 5, out: str = "top_values") -> DataFrame:
    """The k most frequent values per group, as an array (ties by value)."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("_n"), F.asc(value))
    best = counts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)
    ordered = F.sort_array(F.collect_list(F.struct("_rank", value)))
    return best.groupBy(*keys).agg(F.transform(ordered, lambda x: x[value]).alias(out))


_USER_KEYS = ("metric_date", "organization_id")


def _user_rows(df: DataFrame, ds: str | None, tenant: str) -> DataFrame:
    df = df.withColumnsRenamed({"processing_date": "metric_date", tenant: "organization_id"})
    return df if ds is None else df.filter(F.col("metric_date") == F.lit(ds).cast("date"))


def _cells(rows: DataFrame, values: Sequence[str], **sums: Column) -> DataFrame:
    """Per group, one row for each distinct value of each listed column: ``_kind`` names the column, ``_n`` counts rows.

    One scan and one shuffle serve all columns.  Tasks combine rows first, so a hot group sends its distinct values.
    """
    copied = rows.withColumn("_kind", F.explode(F.lit(list(values))))
    own = [F.when(F.col("_kind") == v, F.col(v)).alias(v) for v in values]
    counted = copied.select(*_USER_KEYS, "_kind", *own, *[c.alias(n) for n, c in sums.items()])
    # bits are ored, numbers summed
    merged = [(F.bit_or if n == "_bits" else F.sum)(n).alias(n) for n in sums]
    return counted.groupBy(*_USER_KEYS, "_kind", *values).agg(F.count(F.lit(1)).alias("_n"), *merged)


def _age_columns(age: str, probs: dict[str, float]) -> list[Column]:
    # whole-day ages have a small domain, so the exact percentile runs over one cell per (group, age)
    n = F.when(F.col(age).isNotNull(), F.col("_n"))
    return [
        (F.sum(F.col(age) * n) / F.sum(n)).alias(f"avg_{age}"),
        F.min(age).alias(f"min_{age}"),
        F.max(age).alias(f"max_{age}"),
        *[F.percentile(age, p, F.coalesce(n, F.lit(0))).alias(f"{name}_{age}") for name, p in probs.items()],
    ]


def user_daily(df: DataFrame, ds: str | None = None, tenant: str = "organization_id") -> DataFrame:
    """Distinct users per day and tenant: totals, states, age statistics, cohorts, top domains.

    The input is read once: users, ages and domains become cells of one aggregation; those of users and ages fold into
    one row each, so only distinct domains are ranked.
    """
    rows, age = _user_rows(df, ds, tenant), F.col("user_age_days")
    flags = {
        "active_users": F.col("is_active") == 1,
        "inactive_users": F.col("is_active") == 0,
        "new_users": F.to_date("created_date") == F.col("metric_date"),
        "status_active": F.col("status") == "active",
        "status_inactive": F.col("status") == "inactive",
        "users_0_30_days": age <= 30,
        "users_31_90_days": (age > 30) & (age <= 90),
        "users_91_365_days": (age > 90) & (age <= 365),
        "users_over_1_year": age > 365,
    }
    bits = F.lit(0)
    for i, c in enumerate(flags.values()):
        bits = bits.bitwiseOR(F.when(c, 1 << i).otherwise(0))
    cells = _cells(rows, ["user_id", "user_age_days", "email_domain"], _bits=F.when(F.col("_kind") == "user_id", bits))
    counts = [F.count("user_id").alias("total_users")] + [
        F.count_if(F.col("user_id").isNotNull() & (F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0)).alias(n)
        for i, n in enumerate(flags)
    ]
    ages = _age_columns("user_age_days", {"median": 0.5})
    folded = cells.groupBy(*_USER_KEYS, "_kind", "email_domain").agg(*counts, *ages, F.sum("_n").alias("_n"))
    # the two folded rows and the five best domains; rows without a domain rank last
    w = Window.partitionBy(*_USER_KEYS).orderBy(
        F.col("_kind") == "email_domain", F.col("email_domain").isNull(), F.desc("_n"), F.asc("email_domain")
    )
    few = folded.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= 2 + 5)
    named = (F.col("_kind") == "email_domain") & F.col("email_domain").isNotNull()
    best = F.sort_array(F.collect_list(F.when(named, F.struct("_rank", "email_domain"))))
    domains = F.when(F.count_if(named) > 0, F.transform(best, lambda x: x["email_domain"])).alias("top_email_domains")
    sums = [F.sum(n).alias(n) for n in ("total_users", *flags)]
    stats = [F.max(f"{x}_user_age_days").alias(f"{x}_user_age_days") for x in ("avg", "min", "max", "median")]
    return few.groupBy(*_USER_KEYS).agg(*sums, *stats, domains)


def user_daily_counts(df: DataFrame, ds: str | None = None, tenant: str = "organization_id") -> DataFrame:
    """Users per day and tenant with row counts for active / inactive, median and p95 age, newest first."""
    rows = _user_rows(df, ds, tenant).filter(F.col("user_id").isNotNull())
    state = {f"_{n}": F.when((F.col("_kind") == "user_id") & (F.col("is_active") == v), 1).otherwise(0) for v, n in ((1, "on"), (0, "off"))}
    out = _cells(rows, ["user_id", "user_age_days"], **state).groupBy(*_USER_KEYS).agg(
        F.count("user_id").alias("total_users"),
        F.sum("_on").alias("active_users"),
        F.sum("_off").alias("inactive_users"),
        *_age_columns("user_age_days", {"median": 0.5, "p95": 0.95}),
    )
    return out.orderBy(F.desc("metric_date"), F.asc("organization_id"))


def lead_daily_stats(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Leads per day: counts, points and completeness.  One day, or a range of days in one pass."""
    points, rows = F.coalesce(F.col("points"), F.lit(0)), F.count(F.lit(1))
    identified = F.count_if(F.col("date_identified").isNotNull())
    return (
        _days(df, "date_added", start, end or start)
        .groupBy(F.to_date("date_added").alias("metric_date"))
        .agg(
            rows.alias("new_leads"),
            identified.alias("identified_leads"),
            F.sum(points).alias("total_points"),
            F.avg(points).alias("avg_points"),
            F.max(points).alias("max_points"),
            F.count_if(filled("email")).alias("leads_with_email"),
            F.count_if(filled("company")).alias("leads_with_company"),
            F.count_if(filled("phone")).alias("leads_with_phone"),
            rate_pct(identified, rows).alias("identification_rate"),
        )
    )


def page_hits_daily(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Page hits per day and country.

    Hits collapse to one row per (day, country, lead, url) first, so the two distinct counts copy collapsed rows only.
    """
    seconds = F.when(F.col("date_left").isNotNull(), second_diff("date_hit", "date_left"))
    keys = [F.to_date("date_hit").alias("metric_date"), if_null("country", "Unknown", True).alias("country")]
    visits = (
        _days(df, "date_hit", start, end or start)
        .groupBy(*keys, "lead_id", "url")
        .agg(
            F.count(F.lit(1)).alias("_hits"),
            F.sum(seconds).alias("_seconds"),
            F.count(seconds).alias("_timed"),
            F.count_if(filled("referer")).alias("_referred"),
        )
    )
    rows, referred = F.sum("_hits"), F.sum("_referred")
    return visits.groupBy("metric_date", "country").agg(
        rows.alias("total_hits"),
        F.count_distinct("lead_id").alias("unique_leads"),
        F.count_distinct("url").alias("unique_urls"),
        (F.sum("_seconds") / F.nullif(F.sum("_timed"), F.lit(0))).alias("avg_time_on_page_seconds"),
        referred.alias("hits_with_referer"),
        rate_pct(referred, rows).alias("referer_rate"),
    )


def attribution_by_source(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Visits, leads and first-touch leads per day and traffic source.

    A lead's first touch is its earliest hit up to the day.  Hits are first
    collapsed to one row per (lead, day, source), with everything before
    ``start`` in a single row per lead, so the first-touch window sees a few
    rows per lead however many hits the lead has, and no join or distinct
    aggregate is needed.
    """
    end = end or start
    hits = _days(df, "date_hit", None, end).filter(F.col("lead_id").isNotNull())
    in_range = F.col("date_hit") >= F.lit(start).cast("date")
    per_lead = hits.groupBy(
        "lead_id",
        F.when(in_range, F.to_date("date_hit")).alias("metric_date"),
        F.when(in_range, if_null("source", "direct", True)).alias("traffic_source"),
    ).agg(F.count(F.lit(1)).alias("_hits"), F.min("date_hit").alias("_first"))
    lead = Window.partitionBy("lead_id")
    touched = per_lead.withColumn("_touch", F.col("_first") == F.min("_first").over(lead))
    rows, visits = F.count(F.lit(1)), F.sum("_hits")
    return (
        touched.filter(F.col("metric_date").isNotNull())
        .groupBy("metric_date", "traffic_source")
        .agg(
            rows.alias("unique_leads"),
            visits.alias("total_visits"),
            F.count_if("_touch").alias("first_touch_leads"),
            F.round(visits / F.nullif(rows, F.lit(0)), 2).alias("visits_per_lead"),
        )
    )


def frequent_values(df: DataFrame, c: str, share: float) -> DataFrame:
    """Every value that at least ``share`` of the rows hold, with its exact count.

    For columns with too many values to count them all: a frequency sketch, of a size set by ``share`` alone, names all
    values that may be as frequent (it misses none: an item above one part in three quarters of its places is kept), and a
    second scan counts those.  Neither shuffles values.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    tracked = 1 << max(4, math.ceil(math.log2(4 / share)))
    if tracked > 1 << 20:
        raise ValueError("a share this small needs all values counted")
    most = min(tracked, math.ceil(2 / share))
    found, total = df.agg(F.call_function("approx_top_k", F.xxhash64(c), F.lit(most), F.lit(tracked)), F.count(F.lit(1))).first()
    some = [r["item"] for r in found or ()]
    counts = df.where(F.xxhash64(c).isin(some)).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= share * total)


def customer_summary(
    df: DataFrame, ds: str, min_orders: int = 1, tenant: str = "organization_id"
) -> DataFrame:
    """First and last purchase, orders, revenue, recency and lifespan per customer up to ``ds``."""
    last, first = F.max("last_purchase_date"), F.min("first_purchase_date")
    orders, revenue = F.count_distinct("order_id"), exact_sum("order_value")
    day = F.lit(ds).cast("date")
    return (
        df.filter(F.col("processing_date") <= day)
        .groupBy("customer_id", F.col(tenant).alias("organization_id"))
        .agg(
            first.alias("first_purchase_date"),
            last.alias("last_purchase_date"),
            orders.alias("total_orders"),
            revenue.cast("double").alias("total_revenue"),
            (revenue / F.count("order_value")).cast("double").alias("avg_order_value"),
            day_diff(last, day).alias("recency_days"),
            orders.alias("frequency"),
            revenue.cast("double").alias("monetary"),
            day_diff(first, last).alias("customer_lifespan_days"),
        )
        .filter(F.col("total_orders") >= min_orders)
        .withColumn("calculation_date", day)
    )


# Lowest total score of each segment.
SEGMENTS = [(13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (5, "At Risk")]
LAST_SEGMENT = "Lost"

_QUINTILES = (0.2, 0.4, 0.6, 0.8)


def quintile_edges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with an array of four quintile edges per column, over all rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("m"), F.col(c).cast("double").alias("v")) for c in cols])
    long = df.select(F.explode(pairs).alias("_p")).select(F.col("_p.m").alias("measure"), F.col("_p.v").alias("value"))
    edges = exact_quantiles(long, "value", _QUINTILES, ["measure"])
    return edges.agg(*[F.max(F.when(F.col("measure") == c, F.col("quantiles"))).alias(c) for c in cols])


def quintile_scores(df: DataFrame, cols: dict[str, bool]) -> DataFrame:
    """Add ``<column>`` scores 1-5 as ``_score_<column>``; value True reverses the scale."""
    edges = quintile_edges(df, list(cols)).first()  # four numbers per column
    found = {c: F.lit(edges[c] if edges[c] is not None else [None] * 4).cast("array<double>") for c in cols}
    scored = {
        f"_score_{c}": score(F.col(c).cast("double"), found[c], 4, reverse) for c, reverse in cols.items()
    }
    return df.withColumns(scored)


def rfm(summary: DataFrame, margin: float = 0.2, years: int = 3) -> DataFrame:
    """Purchase rate, predicted value, recency / frequency / monetary scores and a segment.

    The summary is read twice (edges, then scores); pass a materialized one.
    """
    lifespan = F.when(F.col("customer_lifespan_days") == 0, 1).otherwise(F.col("customer_lifespan_days"))
    rate = F.col("frequency") / (lifespan / 365.0)
    value = F.col("total_revenue") / F.col("frequency")
    scored = quintile_scores(summary, {"recency_days": True, "frequency": False, "monetary": False})
    out = scored.withColumns(
        {
            "customer_lifespan_days": lifespan,
            "purchase_rate": rate,
            "avg_order_value": value,
            # binary fractions put exact ties of half a cent on either side; the tiny factor rounds all of them up
            "predicted_clv": F.round(value * rate * years * margin * (1 + 1e-12), 2),
        }
    ).withColumnsRenamed(
        {
            "_score_recency_days": "recency_score",
            "_score_frequency": "frequency_score",
            "_score_monetary": "monetary_score",
        }
    )
    out = out.withColumn("rfm_score", F.expr("recency_score + frequency_score + monetary_score"))
    label = case([(F.col("rfm_score") >= low, F.lit(name)) for low, name in SEGMENTS], F.lit(LAST_SEGMENT))
    return out.withColumn("customer_segment", label)


def revenue_metrics(df: DataFrame, ds: str | None = None, tenant: str = "organization_id") -> DataFrame:
    """Revenue per tenant and day with spread, customers and growth over the previous day present.

    The previous day comes from the full history (one row per tenant and day by
    then), and only afterwards the result is narrowed to ``ds``.
    """
    daily = df.groupBy(
        F.col(tenant).alias("organization_id"), F.col("processing_date").alias("metric_date")
    ).agg(
        exact_sum("revenue").alias("_sum"),
        F.stddev_samp("revenue").alias("std_revenue"),
        F.count("revenue").alias("transaction_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    w = Window.partitionBy("organization_id").orderBy("metric_date")
    daily = daily.withColumn("_before", F.lag("_sum").over(w))
    if ds is not None:
        daily = daily.filter(F.col("metric_date") == F.lit(ds).cast("date"))
    total, before = F.col("_sum"), F.col("_before")
    per = lambda n: total / F.nullif(F.col(n), F.lit(0))
    spread = F.col("std_revenue") / F.nullif(per("transaction_count").cast("double"), F.lit(0.0))
    growth = (total - before).cast("double") / F.nullif(before.cast("double"), F.lit(0.0)) * 100
    return daily.select(
        "organization_id",
        "metric_date",
        total.cast("double").alias("total_revenue"),
        per("transaction_count").cast("double").alias("avg_revenue"),
        "std_revenue",
        "transaction_count",
        "unique_customers",
        F.round(per("unique_customers"), 2).cast("double").alias("revenue_per_customer"),
        F.round(spread, 4).alias("revenue_coefficient_of_variation"),
        before.cast("double").alias("prev_day_revenue"),
        F.round(growth, 2).cast("double").alias("revenue_growth_rate"),
    ).na.fill(0.0)


def events_by_type(timeline: DataFrame) -> DataFrame:
    """Event counts and first / last time per type and timestamp source."""
    return timeline.groupBy("event_type", "event_timestamp_source").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest")
    )


def events_by_source(timeline: DataFrame) -> DataFrame:
    """Events, distinct entities and audit-time presence per source table."""
    return timeline.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("entity_id").alias("unique_entities"),
        F.count_if(F.col("rec_add").isNotNull()).alias("has_rec_add"),
        F.count_if(F.col("rec_edit").isNotNull()).alias("has_rec_edit"),
    )


def entity_lifecycle(timeline: DataFrame, period: str = "month", max_events: int = HOT_ROWS) -> DataFrame:
    """Types, times and timestamp sources of each entity's events in time order.

    One row per entity and period.  An entity with more than ``max_events``
    events in a period is spread over several rows (``piece`` 0, 1, ...), each
    sorted by time, so no array and no task grows with a hot entity and every
    event is kept.
    """
    keys = ["entity_type", "entity_id", "period_start"]
    rows = timeline.withColumn("period_start", F.to_date(F.date_trunc(period, "timestamp")))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = counts.filter(F.col("_n") > max_events).select(*keys, F.ceil(F.col("_n") / max_events).alias("_pieces"))
    piece = F.coalesce(F.pmod(F.xxhash64("event_id"), F.col("_pieces")), F.lit(0)).cast("int")
    rows = rows.join(large, keys, "left").withColumn("piece", piece)
    item = F.struct("timestamp", "event_type", "event_timestamp_source")
    return (
        rows.groupBy(*keys, "piece")
        .agg(F.sort_array(F.collect_list(item)).alias("_e"))
        .select(
            *keys,
            "piece",
            F.col("_e.event_type").alias("events"),
            F.col("_e.timestamp").alias("timestamps"),
            F.col("_e.event_timestamp_source").alias("sources"),
        )
    )


def updated_entities(timeline: DataFrame) -> DataFrame:
    """Entities with update events, most updated first."""
    return (
        timeline.groupBy("entity_id")
        .agg(
            F.count_if(F.col("event_type").like("%\\_created")).alias("created_events"),
            F.count_if(F.col("event_type").like("%\\_updated")).alias("updated_events"),
        )
        .filter("updated_events > 0")
        .orderBy(F.desc("updated_events"), F.asc("entity_id"))
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows; the ordering should end in a unique column."""
    return df.orderBy(*order).limit(n)


def group_summary(df: DataFrame, keys: Sequence[str], distinct: str, measure: str) -> DataFrame:
    """Rows, distinct ids, total, average, minimum and maximum per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(distinct).alias("distinct_ids"),
        exact_sum(measure).cast("double").alias("total"),
        F.avg(measure).alias("average"),
        F.min(measure).alias("minimum"),
        F.max(measure).alias("maximum"),
    )
