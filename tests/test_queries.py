"""Every registered query against its SQL on the smallest tables, and the plans' shape."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.common import QUERIES
from lakepipe.session import shared_dir

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = db.execute(sql)
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(r[i] for i in order) for r in cur.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark):
    skip = ("stream", "load_summary")  # these run jobs when built
    for name, fn in QUERIES.items():
        if not name.startswith(skip):
            text = plan(fn(spark, SF))
            assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_latest_prunes_before_the_shuffle(spark):
    text = plan(entry.queries()["keep_latest_user_day"](spark, SF))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_timeline_reads_once_without_shuffle(spark):
    text = plan(entry.queries()["timeline_orders"](spark, SF))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_suite_reads_each_table_once_for_row_checks(spark):
    from lakepipe.operators import checks as q

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    local = [q.row_count("o"), q.not_null("o", "o_orderkey"), q.in_range("o", "o_totalprice", 0), q.fresh("o", "o_orderdate", "2001-01-01", 9)]
    text = plan(q.run_checks({"o": orders}, local))
    assert text.count("FileScan") == 1 and "o_orderpriority" not in text


def test_key_checks_share_one_pass(spark):
    text = plan(entry.queries()["dq_suite"](spark, SF))
    # orders: rows, then keys; its filtered copy and customer: keys
    assert text.count("FileScan") == 4 and "Join" not in text
    text = plan(entry.queries()["related_validation"](spark, SF))
    assert "Join" not in text and text.count("FileScan") <= 2 * len(set(__import__("re").findall(r"InMemoryFileIndex\(1 paths\)\[([^\]]*)\]", text)))


def test_user_metrics_read_their_input_once(spark):
    for name in ("user_daily_metrics", "user_daily_counts"):
        assert plan(entry.queries()[name](spark, SF)).count("FileScan") == 2, name  # customer and orders


def test_attribution_has_no_join_and_pushes_the_date(spark):
    text = plan(entry.queries()["flagship_attribution"](spark, SF))
    assert "Join" not in text and "Expand" not in text
    assert "PushedFilters" in text and "LessThan(ts" in text and "props" not in text.split("ReadSchema")[1]


def test_partition_filter_prunes(spark):
    from lakepipe.sources import readers, writers

    path = shared_dir(spark, "raw")
    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", "to_date(ts) AS d")
    writers.write_partitions(events, path, ["d"], mode="overwrite")
    raw = readers.read_raw(spark, path, partitions={"d": "Date"}).filter("d = date'2024-01-05'")
    assert "PartitionFilters: [isnotnull(d" in plan(raw)
    assert len(raw.inputFiles()) > 0 and raw.count() == events.filter("d = date'2024-01-05'").count()
