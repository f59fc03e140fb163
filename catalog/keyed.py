"""Deduplication and joins."""

from pyspark.sql import functions as F

from catalog.common import SQL, day, load, query, ts
from lakepipe.operators import dedupe, joins
from lakepipe.session import materialize


@query(
    "keep_latest_user_day",
    f"""SELECT user_id, {day('ts')} AS day, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
)
def keep_latest_user_day(spark, sf):
    df = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    kept = dedupe.keep_latest(df, ["user_id", "to_date(ts)"], ["ts DESC", "event_id DESC"])
    return kept.select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type")


@query(
    "keep_latest_ordered",
    """SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 THEN 999 ELSE event_id % 7 END ASC,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END DESC NULLS LAST, event_id) = 1""",
)
def keep_latest_ordered(spark, sf):
    df = load(spark, sf, "events").select(
        "user_id",
        "event_id",
        "value",
        F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 7).alias("ordinal"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"),
    )
    kept = dedupe.keep_latest(df, ["user_id"], ["COALESCE(ordinal, 999) ASC", "v DESC NULLS LAST", "event_id"])
    return kept.select("user_id", "event_id", "value")


@query(
    "keep_latest_cross_partition",
    f"""SELECT user_id, event_type, {day('ts')} AS processing_date, event_id FROM events
    WHERE ts < TIMESTAMP '2024-01-16'
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1""",
)
def keep_latest_cross_partition(spark, sf):
    df = load(spark, sf, "events").filter(F.col("ts") < F.lit("2024-01-16").cast("date"))
    df = df.select("user_id", "event_type", F.to_date("ts").alias("processing_date"), "event_id")
    return dedupe.keep_latest(df, ["user_id", "event_type"], ["processing_date DESC", "event_id DESC"])


@query(
    "distinct_rows",
    """SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem""",
    integers=("l_linenumber",),
)
def distinct_rows(spark, sf):
    return dedupe.distinct_rows(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "replacing_merge",
    """WITH u AS (
      SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version, 0 AS newer FROM orders
      UNION ALL SELECT o_orderkey, 'X', o_totalprice * 2, CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END, 1
      FROM orders WHERE o_orderkey % 2 = 0
      UNION ALL SELECT o_orderkey + 1000000000, 'N', o_totalprice, 1, 1 FROM orders WHERE o_orderkey % 100 = 0)
    SELECT o_orderkey, o_orderstatus, o_totalprice, version FROM u
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC, newer DESC) = 1""",
    integers=("version",),
)
def replacing_merge(spark, sf):
    old = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("version"))
    k = F.col("o_orderkey")
    version = F.when(k % 3 == 0, 2).when(k % 3 == 1, 1).otherwise(0)
    changed = old.filter(k % 2 == 0).select(
        k, F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice"), version.alias("version")
    )
    added = old.filter(k % 100 == 0).select(
        (k + 1000000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice", "version"
    )
    return dedupe.replacing_merge(old, changed.unionByName(added), ["o_orderkey"], "version")


@query(
    "keep_first_and_last",
    """SELECT f.user_id, f.event_id AS first_event, l.event_id AS last_event
    FROM (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1) f
    JOIN (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1) l USING (user_id)""",
)
def keep_first_and_last(spark, sf):
    df = load(spark, sf, "events").select("user_id", "event_id")
    first = dedupe.keep_first(df, ["user_id"], "event_id").withColumnRenamed("event_id", "first_event")
    last = dedupe.keep_last(df, ["user_id"], "event_id").withColumnRenamed("event_id", "last_event")
    return first.join(last, "user_id")


def _some_parts(spark, sf):
    return load(spark, sf, "part").filter(F.col("p_size") > 10)


@query(
    "orphans",
    """SELECT count(*) AS orphaned FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size > 10)""",
)
def orphans(spark, sf):
    return joins.orphans(load(spark, sf, "lineitem"), _some_parts(spark, sf), [("l_partkey", "p_partkey")])


@query(
    "orphans_three_keys",
    """SELECT count(*) AS orphaned FROM lineitem a LEFT JOIN (
      SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_quantity > 5) b
      ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_suppkey = b.l_suppkey
    WHERE b.l_orderkey IS NULL""",
)
def orphans_three_keys(spark, sf):
    lines = load(spark, sf, "lineitem")
    return joins.orphans(lines, lines.filter("l_quantity > 5"), ["l_orderkey", "l_linenumber", "l_suppkey"])


@query(
    "not_exists_rows",
    """SELECT event_id, user_id FROM events e WHERE NOT EXISTS (
      SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal > 0 AND c.c_nationkey < 12)""",
)
def not_exists_rows(spark, sf):
    wanted = load(spark, sf, "customer").filter("c_acctbal > 0 AND c_nationkey < 12")
    return joins.orphan_rows(load(spark, sf, "events"), wanted, [("user_id", "c_custkey")]).select("event_id", "user_id")


@query(
    "joined_threads",
    f"""SELECT o_custkey AS k, o_orderkey, c_name, c_mktsegment AS label_right, o_orderpriority AS label
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def joined_threads(spark, sf):
    left = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), "o_orderkey", F.col("o_orderpriority").alias("label")
    )
    right = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), "c_name", F.col("c_mktsegment").alias("label")
    )
    return joins.join_on(left, right, ["k"]).drop("row_id")


@query(
    "key_coverage",
    """SELECT count(DISTINCT c_custkey) AS keys, count(DISTINCT o_custkey) AS covered,
      CAST(round(CAST(count(DISTINCT o_custkey) * 100.0 / count(DISTINCT c_custkey) AS DECIMAL(18,8)), 2) AS DOUBLE) AS coverage_pct
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) o ON c_custkey = o_custkey""",
)
def key_coverage(spark, sf):
    keys = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    buyers = load(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    return joins.coverage(keys, buyers, ["k"])


@query(
    "keep_children",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    integers=("l_linenumber",),
)
def keep_children(spark, sf):
    final = load(spark, sf, "orders").filter("o_orderstatus = 'F'")
    kept = joins.keep_children(load(spark, sf, "lineitem"), final, [("l_orderkey", "o_orderkey")])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "fk_null",
    """SELECT l_orderkey, l_linenumber, coalesce(CAST(p_partkey AS VARCHAR), 'none') AS l_partkey
    FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) p ON l_partkey = p_partkey""",
    integers=("l_linenumber",),
)
def fk_null(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    fixed = joins.null_bad_fk(lines, "l_partkey", _some_parts(spark, sf), "p_partkey")
    return fixed.withColumn("l_partkey", F.coalesce(F.col("l_partkey").cast("string"), F.lit("none")))


@query(
    "fk_remap",
    """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 15) n ON c_nationkey = n_nationkey""",
)
def fk_remap(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    lookup = load(spark, sf, "nation").filter("n_nationkey < 15")
    return joins.remap_key(df, "nation", lookup, "n_nationkey", "n_name")


@query(
    "first_touch",
    f"""SELECT user_id, {ts('min(ts)')} AS first_ts FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY user_id""",
)
def first_touch(spark, sf):
    return joins.first_per_key(load(spark, sf, "events"), "user_id", "ts", F.lit("2024-01-20").cast("date"))


@query("key_coverage_states", SQL["key_coverage"])
def key_coverage_states(spark, sf):
    keys = joins.key_states(load(spark, sf, "customer"), "c_custkey", ["c_nationkey"])
    big = load(spark, sf, "orders").filter("o_totalprice > 400000")
    buyers = joins.key_states(big, "o_custkey", [F.year("o_orderdate").alias("year")])
    return joins.coverage_of_states(materialize(keys, "keys"), materialize(buyers, "keys"))
