"""Data-quality suites, contracts, inventories and related tables."""

from pyspark.sql import functions as F

from catalog.common import load, query, rounded, ts
from lakepipe.operators import checks as q
from lakepipe.operators import contract as ct
from lakepipe.operators import inventory as iv
from lakepipe.operators import profile as pf
from lakepipe.operators.dedupe import distinct_rows
from lakepipe.operators.filters import drop_missing
from lakepipe.plans import related as rl
from lakepipe.sources import readers, writers
from lakepipe.sources.writers import land_with_audit
from lakepipe.session import shared_dir

_DATES = "o_orderdate < TIMESTAMP '1998-01-01'"


def _checks_sql(rows: list[tuple]) -> str:
    """UNION ALL of (table, check, severity, ok expression over n, SQL giving n)."""
    parts = [
        f"""SELECT '{t}' AS "table", '{c}' AS "check", '{s}' AS severity, {ok} AS ok, CAST(n AS DOUBLE) AS observed FROM ({sql})"""
        for t, c, s, ok, sql in rows
    ]
    return "\nUNION ALL ".join(parts)


def _count(table: str, where: str) -> str:
    return f"SELECT count(*) AS n FROM {table} WHERE {where}"


def _nulls(table: str, c: str, where: str = "true") -> str:
    return _count(table, f"{c} IS NULL AND {where}")


def _repeats(table: str, c: str) -> str:
    return f"SELECT count(*) AS n FROM (SELECT {c} FROM {table} GROUP BY {c} HAVING count(*) > 1)"


def _has(table: str, c: str, kind: str = "%") -> str:
    return f"SELECT count(*) AS n FROM (DESCRIBE {table}) WHERE column_name = '{c}' AND column_type LIKE '{kind}'"


ORDER_SUITE = [
    q.row_count("orders", 1000),
    q.not_null("orders", "o_orderkey", strict=True),
    q.not_null("orders", "o_custkey"),
    q.accepted_values("orders", "o_orderstatus", ["F", "O"]),
    q.in_range("orders", "o_totalprice", 0, 450000, "warning"),
    q.implies("orders", "final_is_cheap", "o_orderstatus = 'F'", "o_totalprice < 400000", "warning"),
    q.not_blank("orders", ["o_orderpriority", "o_orderstatus"]),
    q.not_future("orders", "o_orderdate", "2001-01-01", "warning"),
    q.not_older("orders", "o_orderdate", "2001-01-01", 2000),
    q.matches("orders", "o_orderpriority", "^[1-3]-[A-Z]+$"),
    q.text_length("orders", "o_orderpriority", 5, 10),
    q.complete("orders", "o_orderpriority", 99.0),
    q.share_at_most("orders", "urgent_share", "o_orderpriority = '1-URGENT'", 10.0),
    q.fresh("orders", "o_orderdate", "2001-09-01", 90),
    q.unique("orders", ["o_orderkey"]),
    q.unique("orders", ["o_custkey"], "warning"),
    q.group_total("orders", "customer_total", ["o_custkey"], "o_totalprice", 1500000, 1000000, "warning"),
    q.references("orders", [("o_custkey", "c_custkey")], "customer"),
    q.references("orders", [("o_custkey", "id")], "absent_table", optional=True),
    q.covered("customer", ["c_custkey"], "order_customers", 95.0),
    q.column_type("orders", "o_totalprice", "Float64"),
    q.column_type("orders", "o_comment"),
    q.measured("orders", "average_price", "round(avg(o_totalprice), 0)"),
]


@query(
    "dq_suite",
    _checks_sql(
        [
            ("orders", "row_count", "error", "n >= 1000", "SELECT count(*) AS n FROM orders"),
            ("orders", "not_null:o_orderkey", "error", "n = 0", _count("orders", "o_orderkey IS NULL OR o_orderkey = 0")),
            ("orders", "not_null:o_custkey", "error", "n = 0", _count("orders", "o_custkey IS NULL")),
            ("orders", "accepted_values:o_orderstatus", "error", "n = 0", _count("orders", "o_orderstatus NOT IN ('F', 'O')")),
            ("orders", "range:o_totalprice", "warning", "n = 0", _count("orders", "o_totalprice < 0 OR o_totalprice > 450000")),
            ("orders", "final_is_cheap", "warning", "n = 0", _count("orders", "o_orderstatus = 'F' AND NOT o_totalprice < 400000")),
            ("orders", "not_blank:o_orderpriority|o_orderstatus", "error", "n = 0", _count("orders", "trim(coalesce(o_orderpriority, '') || coalesce(o_orderstatus, '')) = ''")),
            ("orders", "not_future:o_orderdate", "warning", "n = 0", _count("orders", "o_orderdate > TIMESTAMP '2001-01-01'")),
            ("orders", "not_older:o_orderdate", "warning", "n = 0", _count("orders", "o_orderdate < DATE '2001-01-01' - 2000")),
            ("orders", "matches:o_orderpriority", "warning", "n = 0", _count("orders", "NOT regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+$')")),
            ("orders", "length:o_orderpriority", "warning", "n = 0", _count("orders", "length(o_orderpriority) NOT BETWEEN 5 AND 10")),
            ("orders", "complete:o_orderpriority", "warning", "n >= 99", "SELECT round(count(o_orderpriority) * 100.0 / count(*), 4) AS n FROM orders"),
            ("orders", "urgent_share", "error", "n <= 10", f"SELECT {rounded('avg(CASE WHEN o_orderpriority = $$1-URGENT$$ THEN 100.0 ELSE 0 END)', 4)} AS n FROM orders"),
            ("orders", "fresh:o_orderdate", "warning", "n <= 90", "SELECT date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-09-01') AS n FROM orders"),
            ("orders", "unique:o_orderkey", "error", "n = 0", "SELECT count(*) AS n FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)"),
            ("orders", "unique:o_custkey", "warning", "n = 0", "SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)"),
            ("orders", "customer_total", "warning", "n = 0", "SELECT count(*) AS n FROM (SELECT sum(o_totalprice) AS t FROM orders GROUP BY o_custkey) WHERE abs(t - 1500000) > 1000000"),
            ("orders", "references:o_custkey->customer", "error", "n = 0", _count("orders", "o_custkey NOT IN (SELECT c_custkey FROM customer)")),
            ("customer", "covered:c_custkey->order_customers", "warning", "n >= 95", f"SELECT {rounded('count(DISTINCT o_custkey) * 100.0 / count(DISTINCT c_custkey)', 4)} AS n FROM customer LEFT JOIN (SELECT * FROM orders WHERE {_DATES}) o ON c_custkey = o_custkey"),
            ("orders", "column:o_totalprice", "error", "n = 1", _has("orders", "o_totalprice", "DOUBLE")),
            ("orders", "column:o_comment", "error", "n = 1", _has("orders", "o_comment")),
            ("orders", "average_price", "info", "true", "SELECT round(avg(o_totalprice), 0) AS n FROM orders"),
        ]
    ),
)
def dq_suite(spark, sf):
    orders = load(spark, sf, "orders")
    tables = {
        "orders": orders,
        "customer": load(spark, sf, "customer"),
        "order_customers": orders.filter(_DATES).select(F.col("o_custkey").alias("c_custkey")),
    }
    return q.run_checks(tables, ORDER_SUITE).drop("details")


@query(
    "dq_lineitem",
    _checks_sql(
        [
            ("lineitem", "charge_matches", "warning", "n = 0", _count("lineitem", "abs(l_extendedprice * (1 - l_discount) - l_extendedprice) > greatest(0.05 * l_extendedprice * (1 - l_discount), 100)")),
            ("lineitem", "ordered:l_discount<=l_tax", "warning", "n = 0", _count("lineitem", "l_discount > l_tax")),
            ("lineitem", "references:l_partkey->part", "error", "n = 0", _count("lineitem", "l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")),
            ("lineitem", "unique:l_orderkey+l_linenumber", "warning", "n = 0", "SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
            ("lineitem", "quantity_bounds", "critical", "n = 1", "SELECT (min(l_quantity) >= 1 AND max(l_quantity) <= 50)::INT AS n FROM lineitem"),
            ("lineitem", "flags_add_up", "error", "n = 1", "SELECT (count(*) FILTER (l_returnflag = 'A') + count(*) FILTER (l_returnflag <> 'A') = count(*))::INT AS n FROM lineitem"),
        ]
    ),
)
def dq_lineitem(spark, sf):
    suite = [
        q.reconciles("lineitem", "charge_matches", "l_extendedprice * (1 - l_discount)", "l_extendedprice", 100, 0.05),
        q.ordered("lineitem", "l_discount", "l_tax", "warning"),
        q.references("lineitem", [("l_partkey", "p_partkey")], "part"),
        q.unique("lineitem", ["l_orderkey", "l_linenumber"], "warning"),
        q.aggregate_holds("lineitem", "quantity_bounds", "min(l_quantity) >= 1 AND max(l_quantity) <= 50", "critical"),
        q.aggregate_holds(
            "lineitem", "flags_add_up", "countIf(l_returnflag = 'A') + countIf(l_returnflag != 'A') = count()"
        ),
    ]
    tables = {"lineitem": load(spark, sf, "lineitem"), "part": load(spark, sf, "part").filter("p_size > 10")}
    return q.run_checks(tables, suite).drop("details")


# a check file as it would stand beside a table
CHECK_DECLARATION = {
    "tests": [
        {"type": "row_count", "min": 1},
        {"type": "not_null", "columns": ["o_orderkey", "o_custkey"]},
        {"type": "unique", "columns": ["o_orderkey"]},
        {"type": "accepted_values", "column": "o_orderstatus", "values": ["F", "O", "P"], "severity": "warning"},
        {
            "name": "cheap_orders",
            "type": "custom",
            "severity": "warning",
            "query": "SELECT count() as invalid FROM {{ target_table }} WHERE o_orderdate >= toDate('{{ ds }}') AND o_totalprice < 2000",
        },
        {
            "name": "all_customers_known",
            "type": "referential_integrity",
            "query": """SELECT count() as orphaned FROM {database}.{table} s LEFT JOIN {{ source_table }} b ON s.o_custkey = b.c_custkey
                        WHERE b.c_custkey IS NULL""",
            "expect": {"orphaned": 0},
        },
        {
            "name": "busy_customers",
            "type": "uniqueness",
            "severity": "warning",
            "query": "SELECT o_custkey, count() AS cnt FROM {database}.{table} GROUP BY o_custkey HAVING cnt > 12",
            "expect_empty": True,
        },
        {"name": "enough", "type": "assertion", "query": "SELECT count() FROM {database}.{table}", "threshold": 1, "comparison": ">="},
        {"name": "positive", "query": "SELECT min(o_totalprice) >= 0 FROM {database}.{table}", "expected": True, "severity": "critical"},
        {"name": "small_keys", "query": "SELECT count(o_custkey) FROM o_custkey WHERE o_custkey <= 5", "threshold": 0, "severity": "warning"},
        {"name": "elsewhere", "query": "SELECT count(*) FROM nowhere.table", "threshold": 0, "skip_if_missing_table": "nowhere.table"},
    ]
}


@query(
    "dq_declared",
    _checks_sql(
        [
            ("shop.orders", "row_count", "error", "n >= 1", "SELECT count(*) AS n FROM orders"),
            ("shop.orders", "not_null:o_orderkey", "error", "n = 0", _nulls("orders", "o_orderkey")),
            ("shop.orders", "not_null:o_custkey", "error", "n = 0", _nulls("orders", "o_custkey")),
            ("shop.orders", "unique:o_orderkey", "error", "n = 0", _repeats("orders", "o_orderkey")),
            ("shop.orders", "accepted_values:o_orderstatus", "warning", "n = 0", _count("orders", "o_orderstatus NOT IN ('F','O','P')")),
            ("shop.orders", "cheap_orders", "warning", "n = 0", _count("orders", "o_orderdate >= DATE '1998-01-01' AND o_totalprice < 2000")),
            ("shop.orders", "all_customers_known", "error", "n = 0", _count("orders", "o_custkey NOT IN (SELECT c_custkey FROM customer)")),
            ("shop.orders", "busy_customers", "warning", "n = 0", "SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 12)"),
            ("shop.orders", "enough", "error", "n >= 1", "SELECT count(*) AS n FROM orders"),
            ("shop.orders", "positive", "critical", "n = 0", "SELECT (NOT min(o_totalprice) >= 0)::INT AS n FROM orders"),
            ("shop.orders", "small_keys", "warning", "n = 0", _count("orders", "o_custkey <= 5")),
        ]
    ),
)
def dq_declared(spark, sf):
    suite = q.suite_from_dict(CHECK_DECLARATION, "shop.orders", "shop.customer_raw", ds="1998-01-01")
    orders = load(spark, sf, "orders")
    tables = {"shop.orders": orders, "shop.customer_raw": load(spark, sf, "customer"), "o_custkey": orders.select("o_custkey")}
    return q.run_checks(tables, suite).drop("details")


@query(
    "dq_gold",
    _checks_sql(
        [
            ("segments", "not_empty", "critical", "n = 1", "SELECT (count(*) > 0)::INT AS n FROM customer"),
            ("segments", "value_positive", "critical", "n = 1", "SELECT (min(abs(c_acctbal)) >= 0)::INT AS n FROM customer"),
            ("segments", "accepted_values:segment", "critical", "n = 0", _count("customer", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")),
            ("segments", "parts_equal_total", "error", "n = 0", _count("customer", "(c_acctbal > 0)::INT + (c_acctbal <= 0)::INT <> 1")),
        ]
    ),
)
def dq_gold(spark, sf):
    c = load(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.abs("c_acctbal").alias("value"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("a"),
        F.when(F.col("c_acctbal") > 0, 0).otherwise(1).alias("b"),
    )
    suite = [
        q.aggregate_holds("segments", "not_empty", "count() > 0", "critical"),
        q.aggregate_holds("segments", "value_positive", "min(value) >= 0", "critical"),
        q.accepted_values("segments", "segment", ["BUILDING", "MACHINERY"], "critical"),
        q.bad_rows("segments", "parts_equal_total", "a + b != 1"),
    ]
    return q.run_checks({"segments": c}, suite).drop("details")


CUSTOMER_CONTRACT = ct.Contract(
    "customer",
    [
        ct.ColumnContract("c_custkey", "integer", False, True),
        ct.ColumnContract("c_name", "string", False, pattern="^Customer#[0-9]+$", max_length=17),
        ct.ColumnContract("c_nationkey", "integer", min_value=2, max_value=20),
        ct.ColumnContract("balance", "decimal", min_value=0),
        ct.ColumnContract("c_phone", "string"),
    ],
    columns_rule="subset",
    ignore_case=True,
)


@query(
    "contract_report",
    _checks_sql(
        [
            ("customer", "missing_columns", "error", "n IS NULL", f"SELECT CASE WHEN n = 0 THEN -1 END AS n FROM ({_has('customer', 'c_phone')})"),
            ("customer", "extra_columns", "warning", "n IS NULL", f"SELECT CASE WHEN n = 0 THEN -1 END AS n FROM ({_has('customer', 'spare')})"),
            ("customer", "not_null:c_custkey", "error", "n = 0", _nulls("customer", "c_custkey")),
            ("customer", "type:c_custkey", "error", "n = 0", _count("customer", "TRY_CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) IS NULL")),
            ("customer", "not_null:c_name", "error", "n = 0", _count("customer", "c_custkey % 50 = 1")),
            ("customer", "pattern:c_name", "error", "n = 0", _count("customer", "NOT regexp_matches(c_name, '^Customer#[0-9]+$') AND c_custkey % 50 <> 1")),
            ("customer", "max_length:c_name", "error", "n = 0", _count("customer", "length(c_name) > 17 AND c_custkey % 50 != 1")),
            ("customer", "type:c_nationkey", "error", "n = 0", _count("customer", "c_custkey % 40 = 0")),
            ("customer", "min:c_nationkey", "error", "n = 0", _count("customer", "c_custkey % 40 != 0 AND c_nationkey < 2")),
            ("customer", "max:c_nationkey", "error", "n = 0", _count("customer", "c_custkey % 40 != 0 AND c_nationkey > 20")),
            ("customer", "min:balance", "error", "n = 0", _count("customer", "c_acctbal < 0")),
            ("customer", "unique:c_custkey", "error", "n = 0", _repeats("customer", "c_custkey")),
        ]
    ),
)
def contract_report(spark, sf):
    df = load(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias(" C_CustKey "),
        F.when(F.col("c_custkey") % 50 != 1, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 40 == 0, "east").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.col("c_acctbal").alias("Balance"),
        F.lit(1).alias("spare"),
    )
    out = ct.contract_report(df, CUSTOMER_CONTRACT).drop("details")
    return out.withColumn("observed", F.coalesce("observed", F.lit(-1.0)))


@query(
    "business_rules",
    _checks_sql(
        [
            ("mail", "unique:thread_id", "warning", "n = 0", "SELECT count(DISTINCT conv_id) AS n FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) > 1)"),
            ("mail", "email:sender", "warning", "n = 0", _count("conversations", "role = 'system'")),
            ("mail", "not_future:timestamp", "warning", "n = 0", _count("conversations", "turn >= 5")),
            ("mail", "range:customer_satisfaction", "warning", "n = 0", _count("conversations", "turn > 1")),
        ]
    ),
)
def business_rules(spark, sf):
    mail = load(spark, sf, "conversations").select(
        F.col("conv_id").alias("thread_id"),
        F.when(F.col("role") == "system", "system@").otherwise(F.concat("role", F.lit("@a.org"))).alias("sender"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).cast("timestamp").alias("timestamp"),
        F.col("turn").alias("customer_satisfaction"),
    )
    suite = ct.business_rules("mail", mail, "2024-01-05")
    return q.run_checks({"mail": mail}, suite).drop("details")


_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
_FIELDS = {t: [c.split(" ", 1) for c in cols.split(", ")] for t, cols in _COLUMNS.items()}
_LISTED = " UNION ALL ".join(f"SELECT table_name, column_name FROM (DESCRIBE {t}), (SELECT '{t}' AS table_name)" for t in _COLUMNS)


def _tables(spark, sf):
    return {t: load(spark, sf, t) for t in _COLUMNS}


@query(
    "profile_tables",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {i + 1} AS ordinal, '{kind}' AS data_type,
        count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM {t}"""
        for t, cols in _FIELDS.items()
        for i, (c, kind) in enumerate(cols)
    ),
    integers=("ordinal",),
)
def profile_tables(spark, sf):
    return pf.profile_tables(_tables(spark, sf), exact=True).drop("nullable")


@query(
    "widest_tables",
    f"""SELECT table_name, count(*) AS col_count FROM ({_LISTED}) AS l WHERE table_name <> 'region'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
)
def widest_tables(spark, sf):
    return pf.widest(pf.listed(_tables(spark, sf)), 3, exclude=["^region$"])


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, 'exact' AS row_count_method FROM {t}" for t in _COLUMNS),
)
def row_counts(spark, sf):
    return pf.row_counts(_tables(spark, sf))


@query(
    "inventory_summary",
    f"""SELECT '2024-06-01' AS date, (SELECT count(DISTINCT table_name) FROM ({_LISTED}) AS l) AS tables,
      (SELECT count(*) FROM ({_LISTED}) AS l) AS columns, """
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in _COLUMNS)
    + " AS rows",
)
def inventory_summary(spark, sf):
    tables, path = _tables(spark, sf), shared_dir(spark, "inventory")
    summary = pf.inventory_summary(pf.listed(tables), pf.row_counts(tables), "2024-06-01")
    writers.write_partitions(summary, path, ["date"])
    return readers.read_raw(spark, path, partitions={"date": "Date"})


def _inventory_sql(period: str, where: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{period}' AS period, 'events' AS table_name, '{c}' AS column_name, {i + 1} AS ordinal, '{kind}' AS data_type,
        count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values,
        CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM events WHERE {where}"""
        for i, (c, kind) in enumerate(_FIELDS["events"])
    )


@query(
    "inventory_by_day",
    _inventory_sql("all", "true") + " UNION ALL " + _inventory_sql("late", "CAST(ts AS DATE) >= DATE '2024-01-20'"),
    integers=("ordinal",),
)
def inventory_by_day(spark, sf):
    events, path, day = load(spark, sf, "events"), shared_dir(spark, "inventory_days"), F.col("ts")
    iv.store_days(events, day, path, end="2024-01-15", distinct="keys")
    iv.store_days(events, day, path, start="2024-01-15", distinct="keys")  # the 15th again: it counts once
    some = lambda period, start=None: iv.inventory(
        iv.read_days(spark, path, start), "events", events.schema, "keys"
    ).select(F.lit(period).alias("period"), "*")
    return some("all").unionByName(some("late", "2024-01-20"))


@query(
    "catalog_drift",
    """WITH recorded AS (SELECT column_name, row_number() OVER () AS at FROM (DESCRIBE orders)),
    live AS (SELECT column_name, row_number() OVER () AS at FROM (DESCRIBE
      SELECT o_orderkey, o_custkey AS o_buyer, o_totalprice, o_orderstatus, o_orderdate, o_orderpriority FROM orders))
    SELECT 'orders' AS table_name, column_name, coalesce(r.at, 0) AS recorded_at, coalesce(l.at, 0) AS live_at,
      CASE WHEN l.at IS NULL THEN 'removed' WHEN r.at IS NULL THEN 'added' ELSE 'moved' END AS change
    FROM recorded r FULL JOIN live l USING (column_name) WHERE r.at IS DISTINCT FROM l.at""",
    integers=("recorded_at", "live_at"),
)
def catalog_drift(spark, sf):
    orders = load(spark, sf, "orders")
    live = orders.select(
        "o_orderkey", F.col("o_custkey").alias("o_buyer"), "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    return ct.catalog_drift(pf.profile(orders, "orders"), pf.profile(live, "Orders")).fillna(0)


@query(
    "pre_run_gate",
    """SELECT 'table_exists' AS "check", 'error' AS severity, true AS ok, 1.0::DOUBLE AS observed
    UNION ALL SELECT 'has_data', 'error', count(*) > 0, least(count(*), 1) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'
    UNION ALL SELECT 'freshness', 'warning', h <= 2, h FROM (SELECT date_diff('hour', CAST(max(ts) AS DATE), TIMESTAMP '2024-01-31') AS h FROM events)
    UNION ALL SELECT 'table_exists', 'error', false, 0.0""",
)
def pre_run_gate(spark, sf):
    load(spark, sf, "events").withColumn("processing_date", F.to_date("ts")).createOrReplaceTempView("gate_events")
    there = q.gate(spark, "gate_events", "processing_date", "2024-01-05", "2024-01-31")
    absent = q.gate(spark, "gate_nowhere", "processing_date", "2024-01-01", "2024-01-31")
    return there.unionByName(absent).select("check", "severity", "ok", "observed")


# three of the tables as they would arrive in text files
RELATED = {
    "customers": rl.RelatedTable(
        {"id": "string", "name": "string", "balance": "float", "is_deleted": "bool"},
        required=["id", "name"],
        keys=["id"],
        filters=["is_deleted != true OR is_deleted IS NULL"],
        fill={"balance": 0.0},
    ),
    "purchases": rl.RelatedTable(
        {"order_id": "string", "customer_id": "string", "paid_at": "datetime", "zone": "string"},
        required=["order_id"],
        keys=["order_id"],
        order="paid_at",
        zones={"paid_at": "zone"},
    ),
    "lines": rl.RelatedTable(
        {"id": "string", "order_ref": "string", "quantity": "int"}, required=["id", "order_ref"], keys=["id"]
    ),
}
RELATED_KEYS = [
    rl.ForeignKey("purchases", "customer_id", "customers", "id", True, "null"),
    rl.ForeignKey("lines", "order_ref", "purchases", "order_id", False, "drop"),
]
RELATED_REMAP = [rl.Remap("lines", "order_ref", "purchases", "number", "order_id")]


def related_raw(spark, sf):
    c, o, li = load(spark, sf, "customer"), load(spark, sf, "orders"), load(spark, sf, "lineitem")
    k, ok = F.col("c_custkey"), F.col("o_orderkey")
    customers = c.select(
        k.cast("string").alias("id"),
        F.when(k % 10 == 0, " null ").otherwise(F.concat(F.lit(" "), "c_name")).alias("name"),
        F.when(k % 6 == 0, "ten days").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(k % 9 == 0, "TRUE").when(k % 9 == 1, "no").alias("is_deleted"),
    )
    purchases = o.select(
        F.when(ok % 25 == 0, "").otherwise(F.concat(F.lit("O"), ok)).alias("order_id"),
        ok.cast("string").alias("number"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("paid_at"),
        F.when(ok % 2 == 0, "Asia/Jakarta").alias("zone"),
    )
    lines = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("string")).alias("id"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_orderkey").cast("string"))
        .otherwise(F.concat(F.lit("O"), "l_orderkey"))
        .alias("order_ref"),
        F.col("l_quantity").cast("string").alias("quantity"),
    )
    return {"customers": customers, "purchases": purchases, "lines": lines}


def related(spark, sf):
    return rl.clean_related(related_raw(spark, sf), RELATED, RELATED_KEYS, RELATED_REMAP)


_RELATED_SQL = """c AS (SELECT c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_custkey % 10 != 0 AND c_custkey % 9 != 0),
  o AS (SELECT o_orderkey, 'O' || o_orderkey AS order_id, o_custkey,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate - INTERVAL '7 hours' ELSE o_orderdate END AS paid_at FROM orders WHERE o_orderkey % 25 != 0),
  l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM o))"""


@query(
    "related_purchases",
    f"""WITH {_RELATED_SQL} SELECT order_id, coalesce(CAST(c.id AS VARCHAR), 'none') AS customer_id, {ts('paid_at')} AS paid_at
    FROM o LEFT JOIN c ON o.o_custkey = c.id""",
)
def related_purchases(spark, sf):
    out = related(spark, sf)["purchases"]
    return out.select("order_id", F.coalesce("customer_id", F.lit("none")).alias("customer_id"), "paid_at")


@query("related_lines", f"WITH {_RELATED_SQL} SELECT 'O' || l_orderkey AS order_ref, count(*) AS n FROM l GROUP BY 1")
def related_lines(spark, sf):
    return related(spark, sf)["lines"].groupBy("order_ref").agg(F.count(F.lit(1)).alias("n"))


@query(
    "related_validation",
    f"WITH {_RELATED_SQL} "
    + _checks_sql(
        [
            ("customers", "row_count", "error", "n >= 1", "SELECT count(*) AS n FROM c"),
            ("customers", "not_null:id", "error", "n = 0", _nulls("c", "id")),
            ("customers", "not_null:balance", "error", "n = 0", _nulls("c", "balance")),
            ("customers", "unique:id", "error", "n = 0", _repeats("c", "id")),
            ("purchases", "row_count", "error", "n >= 1", "SELECT count(*) AS n FROM o"),
            ("purchases", "not_null:order_id", "error", "n = 0", _nulls("o", "order_id")),
            ("purchases", "unique:order_id", "error", "n = 0", _repeats("o", "order_id")),
            ("lines", "row_count", "error", "n >= 1", "SELECT count(*) AS n FROM l"),
            ("lines", "not_null:id", "error", "n = 0", _nulls("l", "(l_orderkey, l_linenumber)")),
            ("lines", "not_null:order_ref", "error", "n = 0", _nulls("l", "l_orderkey")),
            ("lines", "unique:id", "error", "n = 0", _repeats("l", "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice")),
            ("purchases", "references:customer_id->customers", "error", "n = 0", _count("(SELECT c.id AS known, p.id AS wanted FROM (SELECT * FROM o JOIN c ON o.o_custkey = c.id) AS p LEFT JOIN c ON p.id = c.id)", "known IS NULL")),
            ("lines", "references:order_ref->purchases", "error", "n = 0", _count("l", "l_orderkey NOT IN (SELECT o_orderkey FROM o)")),
        ]
    ),
)
def related_validation(spark, sf):
    suite = rl.related_checks(RELATED, RELATED_KEYS, {"customers": ["id", "balance"]})
    return q.run_checks(related(spark, sf), suite).drop("details")


@query(
    "load_summary",
    """WITH d AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0)
    SELECT 'orders' AS table_name, count(*) AS source_rows, count(DISTINCT o_orderkey) FILTER (o_orderkey % 7 <> 0) AS final_rows,
      count(*) - count(DISTINCT o_orderkey) FILTER (o_orderkey % 7 <> 0) AS dropped_rows, count(*) FILTER (o_orderkey % 7 = 0) AS dropped_missing,
      count(*) FILTER (o_orderkey % 7 <> 0) - count(DISTINCT o_orderkey) FILTER (o_orderkey % 7 <> 0) AS dropped_repeats, 0 AS failed_checks,
      count(DISTINCT o_orderkey) FILTER (o_orderkey % 7 <> 0) AS audited_rows FROM d""",
    integers=("failed_checks",),
)
def load_summary(spark, sf):
    orders = load(spark, sf, "orders")
    blank = F.when(F.col("o_orderkey") % 7 == 0, " ").otherwise(F.col("o_orderpriority"))
    rows = orders.unionByName(orders.filter("o_orderkey % 10 = 0")).withColumn("o_orderpriority", blank)
    source, before = pf.observed(rows, "source")
    there, missing = pf.dropping(source, lambda df: drop_missing(df, ["o_orderpriority"]), "missing")
    once, repeats = pf.dropping(there, distinct_rows, "repeats")
    final, after = pf.observed(once, "final")
    path = shared_dir(spark, "landed")
    audit = land_with_audit(final, path, "shop.orders", "shop", "run-1", "2024-06-01", ["o_orderstatus"])
    results = q.run_checks({"orders": spark.read.parquet(path)}, [q.row_count("orders"), q.not_null("orders", "__run_id")])
    dropped = {"missing": missing, "repeats": repeats}
    row = pf.load_summary(spark, "orders", before, after, path, results, dropped).drop("location")
    return row.join(audit.select(F.lit("orders").alias("table_name"), F.col("rows_written").alias("audited_rows")), "table_name")
