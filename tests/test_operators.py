import pytest
from pyspark.sql import functions as F

from lakepipe.operators import checks as q
from lakepipe.operators import clean, contract, dedupe, filters, inventory, joins, metrics, profile, quantiles, states
from lakepipe.operators.states import State, finalize_states, merge_states, partial_states
from lakepipe.session import shared_dir


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (0, "b"), (2, ""), (3, None), (None, "c")], "n int, s string")
    assert rows(filters.require_keys(df, ["n", "s"]), "n") == [(1,)]
    flags = spark.createDataFrame([(1, True, None), (2, True, True), (3, None, None)], "i int, a boolean, b boolean")
    assert rows(filters.exclude_both(flags, "a", "b"), "i") == [(1,), (3,)]
    st = spark.createDataFrame([(1, "Done"), (2, None), (3, "open")], "i int, status string")
    assert rows(filters.skip_done(st, "status"), "i") == [(2,), (3,)]
    miss = spark.createDataFrame([(1, " NULL"), (2, "none"), (3, "null"), (4, "ok"), (5, "")], "i int, s string")
    assert rows(filters.drop_missing(miss, ["s", "not_there"]), "i") == [(1,), (4,)]
    names = spark.createDataFrame([("pg_x",), ("app",)], "n string")
    assert rows(filters.exclude_names(names, "n", ["^pg_"]), "n") == [("app",)]
    days = spark.sql("SELECT date'2024-01-01' + i AS d FROM (SELECT explode(sequence(0, 9)) i)")
    assert filters.lookback(days, "d", "2024-01-08", 3).count() == 4
    assert filters.lookback(days, "d", "2024-01-08", None).count() == 10
    assert filters.on_date(days, "d", "2024-01-05").count() == 1


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", None, "n"), ("b", 1, "z"), ("c", 5, "p"), ("c", 5, "q")], "k string, v int, t string"
    )
    latest = dedupe.keep_latest(df, ["k"], ["v DESC"])
    got = rows(latest, "k", "t")
    assert got[:2] == [("a", "y"), ("b", "z")]
    for n in (1, 3, 7):  # ties settle the same way under any partitioning, and once is enough
        assert rows(dedupe.keep_latest(df.repartition(n), ["k"], ["v DESC"]), "k", "t") == got
    assert rows(dedupe.keep_latest(latest, ["k"], ["v DESC"]), "k", "t") == got
    assert rows(dedupe.keep_latest(df, ["upper(k)"], ["v DESC NULLS FIRST", "t"]), "k", "t")[1] == ("b", "n")
    asc = dedupe.keep_latest(df, ["k"], ["COALESCE(v, 999) ASC", "t"])
    assert rows(asc, "k", "t") == [("a", "x"), ("b", "z"), ("c", "p")]


def test_replacing_merge(spark):
    old = spark.createDataFrame([(1, "o", 1), (2, "o", 3)], "k int, v string, ver int")
    new = spark.createDataFrame([(1, "n", 1), (2, "n", 2), (3, "n", 0)], "k int, v string, ver int")
    merged = dedupe.replacing_merge(old, new, ["k"], "ver")
    assert rows(merged, "k", "v") == [(1, "n"), (2, "o"), (3, "n")]
    assert rows(dedupe.replacing_merge(merged, new.limit(0), ["k"], "ver"), "k", "v") == rows(merged, "k", "v")


def test_joins_and_nulls(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 10)], "i int, fk int")
    parent = spark.createDataFrame([(10,), (10,), (20,)], "pk int")
    on = [("fk", "pk")]
    assert joins.orphans(child, parent, on).first()[0] == 2
    assert joins.orphans(child, parent, on, nullable=True).first()[0] == 1
    assert rows(joins.orphan_rows(child, parent, on), "i") == [(2,), (3,)]
    assert rows(joins.keep_children(child, parent, on), "i", "fk") == [(1, 10), (4, 10)]
    fixed = {r.i: r.fk for r in joins.null_bad_fk(child, "fk", parent, "pk").collect()}
    assert fixed == {1: 10, 2: None, 3: None, 4: 10}
    lookup = spark.createDataFrame([(10, 11), (99, 12), (99, 13)], "a int, b int")
    remapped = {r.i: r.fk for r in joins.remap_key(child, "fk", lookup, "a", "b").collect()}
    assert remapped == {1: 11, 2: 13, 3: None, 4: 11}
    assert tuple(joins.coverage(parent.withColumnRenamed("pk", "k"), child.withColumnRenamed("fk", "k"), ["k"]).first()) == (2, 1, 50.0)
    both = joins.join_on(child.withColumn("n", F.lit(1)), parent.select(F.col("pk").alias("fk"), F.lit(2).alias("n")), ["fk"])
    assert set(both.columns) == {"fk", "i", "n", "n_right", "row_id"} and both.count() == 4


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    # one key holds a third of the rows and is salted
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("v")
    )
    right = spark.range(250).select((F.col("id") - 1).alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(right.filter("k < 3"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plain = rows(left.join(right, ["k"], how), "*")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        salted = joins.skew_join(left, right, ["k"], how, hot_rows=100)
        assert "_salt" in salted._jdf.queryExecution().toString()
        assert rows(salted, "*") == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_skew_join_moves_the_left_once(spark):
    path = shared_dir(spark, "left")
    k = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))  # a third one key, a third none
    spark.range(30000).select(k.alias("k"), "id").write.parquet(path)
    left, right = spark.read.parquet(path), spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 9).alias("w"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plain = {how: rows(left.join(right, ["k"], how), "id") for how in ("inner", "left", "left_semi", "left_anti")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how, want in plain.items():
            joined = joins.skew_join(left, right, ["k"], how, hot_rows=500)
            text = joined._jdf.queryExecution().executedPlan().toString()
            assert text.count("Exchange hashpartitioning") == 2 and "_salt" in text  # one of each side
            assert rows(joined, "id") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_quantiles_narrow_whatever_the_values(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=20000), np.full(50, 1e15), rng.exponential(size=5000) * 1e-9, np.repeat(4.0, 3000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    probs = (0.001, 0.25, 0.5, 0.998, 0.9999)
    held, inside = [], quantiles._inside

    def watched(counted, state, by, which):
        held.append([b.held for r in state.collect() for b in r._brackets])
        return inside(counted, state, by, which)

    monkeypatch.setattr(quantiles, "_inside", watched)
    got = quantiles.exact_quantiles(df, "x", probs, accuracy=500, ranked=100).first().quantiles
    assert np.allclose(got, np.quantile(x, probs), rtol=1e-12)
    assert max(held[0]) > 20000 and max(held[-1]) <= 100 and len(held) <= 4  # narrowed at once, outliers or not
    two = df.select((F.col("x") > 0).alias("g"), "x").unionByName(df.select(F.lit(None).cast("boolean").alias("g"), "x"))
    parts = {r.g: r.quantiles for r in quantiles.exact_quantiles(two, "x", probs, ["g"], ranked=50).collect()}
    for g, v in ((True, x[x > 0]), (False, x[x <= 0]), (None, x)):
        assert np.allclose(parts[g], np.quantile(v, probs), rtol=1e-12)


def test_quantile_values_come_once_however_many_ranks(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.rand(1).alias("x"))
    held, inside = [], quantiles._inside

    def watched(*args):
        out = inside(*args)
        held.append(out.count())
        return out

    monkeypatch.setattr(quantiles, "_inside", watched)
    quantiles.exact_quantiles(df, "x", (0.1, 0.5, 0.9), ["g"], ranked=100).collect()
    assert held[0] == 5000  # not six times as many


def test_quantile_states_merge(spark):
    import numpy as np

    spec = [State("q", "quantiles", "x", (0.1, 0.5, 0.99)), State("k", "keys", "id"), State("n", "count")]
    df = spark.range(40000).select("id", (F.col("id") % 40).alias("day"), (F.rand(3) * 1e6).alias("x")).withColumn("all", F.lit(1))
    df = df.unionByName(df.where("false")).cache()
    parts = partial_states(df, ["day", "all"], spec)
    got = finalize_states(merge_states(parts.drop("day"), ["all"]), spec).first()
    x = np.array([r.x for r in df.select("x").collect()])
    for q, p in zip(got.q, (0.1, 0.5, 0.99)):
        assert abs((x < q).mean() - p) < 0.01
    assert got.n == got.k == 40000
    none = finalize_states(partial_states(df.where("false").withColumn("g", F.lit(1)), [], spec), spec).first()
    assert none.n == 0 and none.k == 0 and none.q == [None, None, None]


def test_coverage_of_states(spark):
    a, b = spark.range(0, 900), spark.range(600, 2000)
    day = (F.col("id") % 5).alias("day")
    got = joins.coverage_of_states(joins.key_states(a, "id", [day]), joins.key_states(b, "id", [day])).first()
    assert tuple(got) == (900, 300, 33.33)
    big = joins.coverage_of_states(joins.key_states(spark.range(300000), "id"), joins.key_states(spark.range(150000, 500000), "id")).first()
    assert abs(big.keys / 300000 - 1) < 0.02 and abs(big.covered / 150000 - 1) < 0.03


def test_frequent_values_miss_none(spark):
    df = spark.range(50000).select(F.when(F.col("id") % 10 == 0, F.lit("a")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("x"), "id")).alias("v"))
    got = {r.v: r.n for r in metrics.frequent_values(df, "v", 0.02).collect()}
    assert got == {"a": 5000, None: 1000}
    assert metrics.frequent_values(df.limit(0), "v", 0.5).count() == 0
    with pytest.raises(ValueError, match="share"):
        metrics.frequent_values(df, "v", 0)


def test_exact_quantiles(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    data = {"a": rng.normal(size=5000), "b": np.repeat([1.0, 2.0, 3.0], [1700, 2000, 300]), "c": np.array([5.0]), "d": rng.exponential(size=777)}
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v], "k string, x double")
    probs = (0.0, 0.05, 0.2, 0.5, 0.8, 0.999, 1.0)
    for accuracy in (50, 4000):
        got = {r.k: r.quantiles for r in quantiles.exact_quantiles(df, "x", probs, ["k"], accuracy).collect()}
        for k, v in data.items():
            assert np.allclose(got[k], np.quantile(v, probs), rtol=1e-12)
    whole = quantiles.exact_quantiles(df, "x", probs).first().quantiles
    assert np.allclose(whole, np.quantile(np.concatenate(list(data.values())), probs))


def test_quintile_scores_with_ties(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(1, 11)], "i int, x double, same double")
    got = metrics.quintile_scores(df, {"x": False, "same": False}).orderBy("i").collect()
    assert [r["_score_x"] for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert {r["_score_same"] for r in got} == {1}
    back = metrics.quintile_scores(df, {"x": True}).orderBy("i").collect()
    assert [r["_score_x"] for r in back] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]


def test_first_touch_counts_ties_per_source(spark):
    hits = spark.sql(
        """SELECT * FROM VALUES (1, timestamp'2024-01-01 10:00:00', 'ad'), (1, timestamp'2024-01-01 10:00:00', 'mail'),
        (1, timestamp'2024-01-02 10:00:00', 'ad'), (2, timestamp'2024-01-02 09:00:00', ''), (NULL, timestamp'2024-01-02 09:00:00', 'ad')
        AS t(lead_id, date_hit, source)"""
    )
    both = metrics.attribution_by_source(hits, "2024-01-01", "2024-01-02")
    cols = ["metric_date", "traffic_source", "unique_leads", "total_visits", "first_touch_leads"]
    got = rows(both.withColumn("metric_date", F.col("metric_date").cast("string")), *cols)
    assert got == [
        ("2024-01-01", "ad", 1, 1, 1), ("2024-01-01", "mail", 1, 1, 1), ("2024-01-02", "ad", 1, 1, 0), ("2024-01-02", "direct", 1, 1, 1),
    ]
    single = metrics.attribution_by_source(hits, "2024-01-02")
    assert rows(single.withColumn("metric_date", F.col("metric_date").cast("string")), *cols) == got[2:]


def test_revenue_growth_uses_history(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('t', date'2024-01-01', 100.0D, 1), ('t', date'2024-01-02', 50.0D, 1), ('t', date'2024-01-02', 100.0D, 2)
        AS v(organization_id, processing_date, revenue, customer_id)"""
    )
    r = metrics.revenue_metrics(df, "2024-01-02").first()
    assert (r.total_revenue, r.prev_day_revenue, r.revenue_growth_rate, r.revenue_per_customer) == (150.0, 100.0, 50.0, 75.0)
    first = metrics.revenue_metrics(df, "2024-01-01").first()
    assert (first.std_revenue, first.prev_day_revenue, first.revenue_growth_rate) == (0.0, 0.0, 0.0)


def test_lifecycle_splits_hot_entities(spark):
    tl = spark.range(1000).select(
        F.col("id").cast("string").alias("event_id"), F.lit("account").alias("entity_type"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("entity_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"),
        F.lit("x").alias("event_type"), F.lit("rec_add").alias("event_timestamp_source"),
    )
    out = metrics.entity_lifecycle(tl, "month", max_events=40).collect()
    hot = [r for r in out if r.entity_id == "hot"]
    assert len(hot) == 9 and sum(len(r.events) for r in hot) == 334
    assert sum(len(r.events) for r in out) == 1000
    assert all(r.timestamps == sorted(r.timestamps) for r in out)


def test_states_merge_equals_recompute(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") * 3 % 11).alias("points"), F.col("id").alias("u"))
    spec = [states.State("n", "count"), states.State("p", "avg", "points"), states.State("hi", "max", "points"),
            states.State("lo", "min", "points"), states.State("s", "sum", "points"), states.State("d", "uniq", "u")]
    whole = states.finalize_states(states.partial_states(df, ["k"], spec), spec)
    parts = states.partial_states(df.filter("id % 2 = 0" if "id" in df.columns else "u % 2 = 0"), ["k"], spec).unionByName(
        states.partial_states(df.filter("u % 2 = 1"), ["k"], spec)
    )
    merged = states.finalize_states(states.merge_states(parts, ["k"]), spec)
    assert rows(whole, "*") == rows(merged, "*")
    with pytest.raises(ValueError):
        states.aggregate_state("median", "points")


def spec(**kw):
    base = {
        "source": {"database": "s", "table": "raw"}, "target": {"database": "c", "table": "t"},
        "dedupe": {"partition_by": ["id"], "order_by": ["edited DESC"]}, "transforms": {"edited": {"transform": "parse_date"}},
        "filters": ["id IS NOT NULL", "id != ''"],
    }
    return clean.TableSpec.from_dict({**base, **kw})


def test_build_clean(spark):
    raw = spark.createDataFrame(
        [(" a ", "09/01/2024", " x ", "j", 1), ("a", "2024-02-01", "y", "j", 2), ("  ", "2024-01-01", "z", "j", 3), (None, None, None, "j", 4)],
        "id string, edited string, note string, _raw_json string, n int",
    )
    out = clean.build_clean(raw, spec(exclude=["n"]), as_of="2024-06-01")
    assert out.columns == ["id", "edited", "note", "_loaded_at", "_source_table", "_source_timestamp"]
    # both spellings of the key are one key once cleaned, and the newest by time wins
    assert rows(out.select("id", "note", F.col("_source_table")), "*") == [("a", "y", "s.raw")]
    with pytest.raises(ValueError, match="columns not found"):
        clean.build_clean(raw.drop("id"), spec())
    with pytest.raises(ValueError, match="lacks"):
        clean.TableSpec.from_dict({"source": {}})


def test_date_filter_runs_before_dedupe(spark):
    raw = spark.sql(
        "SELECT * FROM VALUES ('a', date'2024-01-01', 'x'), ('a', date'2024-01-02', 'y') AS t(id, processing_date, note)"
    )
    s = spec(dedupe={"partition_by": ["id"], "order_by": ["processing_date DESC"]}, transforms={})
    assert rows(clean.build_clean(raw, s, ds="2024-01-01"), "id", "note") == [("a", "x")]
    s = spec(dedupe={"partition_by": ["id"], "order_by": ["processing_date DESC"]}, transforms={}, lookback_days=90)
    assert rows(clean.build_clean(raw, s, ds="2024-01-02"), "id", "note") == [("a", "y")]


def test_frame_cleaning(spark):
    df = spark.createDataFrame([(" a ", " "), (None, "")], "s string, t string")
    assert rows(clean.trim_strings(df), "*") == [("a", None)]
    typed = clean.coerce(
        spark.createDataFrame([("1.0", "x", "Y", "2024-01-05"), ("2.5", "3.5", "?", "bad")], "i string, f string, b string, d string"),
        {"i": "int", "f": "float", "b": "bool", "d": "date", "gone": "int"},
    )
    got = [tuple(r) for r in typed.withColumn("d", F.col("d").cast("string")).collect()]
    assert got == [(1, None, True, "2024-01-05"), (None, 3.5, None, None)]
    flags = spark.createDataFrame([("t", "x")], "is_on string, island string")
    assert clean.flag_columns(flags) == ["is_on"]
    assert clean.booleanize(flags).first()[0] == "true"
    odd = spark.createDataFrame([("maybe",), (None,), ("no",)], "is_on string")
    assert [r[0] for r in clean.booleanize(odd).collect()] == ["maybe", None, "false"]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "", None), (2, None, 7.0)], "id int, s string, x double")
    suite = [
        q.row_count("t", 2), q.not_null("t", "s"), q.not_null("t", "s", strict=True), q.unique("t", ["id"], "warning"),
        q.accepted_values("t", "s", ["a", ""]), q.in_range("t", "x", 0, 6, "warning"), q.complete("t", "x", 60),
        q.group_total("t", "sums", ["id"], "x", 5, 0.5, "warning"), q.references("t", ["id"], "p", severity="warning"),
        q.references("t", ["id"], "absent", optional=True), q.measured("t", "avg_x", "avg(x)"), q.column_type("t", "x", "Float64"),
        q.implies("t", "s_then_x", "s IS NOT NULL", "x IS NOT NULL", "warning"),
        q.custom_sql("t", "none_big", "SELECT id FROM t WHERE x > 100", expect_empty=True),
    ]
    res = q.run_checks({"t": df, "p": spark.createDataFrame([(1,)], "id int")}, suite)
    got = {r.check: (r.ok, r.observed) for r in res.collect()}
    assert got["row_count"] == (True, 3.0) and got["column:x"] == (True, 1.0)
    assert got["unique:id"] == (False, 1.0) and got["accepted_values:s"] == (True, 0.0)
    assert got["range:x"] == (False, 1.0) and got["complete:x"] == (True, 66.6667)
    assert got["sums"] == (False, 1.0) and got["references:id->p"] == (False, 1.0)
    assert got["s_then_x"] == (False, 1.0) and got["none_big"] == (True, 0.0) and got["avg_x"] == (True, 6.0)
    assert "references:id->absent" not in got
    with pytest.raises(q.ChecksFailed, match="not_null:s"):
        q.raise_on_failure(res)
    q.raise_on_failure(res.filter("severity = 'warning'"))


def test_key_checks_against_plain_ones(spark):
    child = spark.createDataFrame([(1, None, 2.0), (1, None, 3.0), (None, 1, 1.0), (None, 1, 1.0), (2, 2, -0.0), (2, 2, 0.0), (9, 9, 5.0)], "a int, b int, x double")
    parent = spark.createDataFrame([(1, "p"), (2, "p"), (2, "q"), (None, "n"), (5, None)], "k long, s string")
    tables = {"c": child, "p": parent, "k": parent.select(F.col("k").alias("a"))}
    suite = [
        q.unique("c", ["a", "b"]), q.unique("c", ["a", "b"], ignore_null=True), q.unique("c", ["x"]), q.unique("p", ["s"]),
        q.references("c", [("a", "k")], "p"), q.references("c", [("a", "k")], "p", nullable=True),
        q.references("c", [("x", "k")], "p"), q.references("p", [("k", "k")], "p"), q.references("c", [("a", "z")], "absent", optional=True),
        q.covered("c", ["a"], "k", 50), q.group_total("c", "totals", ["a"], "x", 5.0, 0.5),
    ]
    got = [r.observed for r in q.run_checks(tables, suite).collect()]
    # groups: (1, -) (-, 1) (2, 2) (9, 9); x: 2 3 1 0 5; a without parent: two NULL and 9
    assert got == [3, 1, 2, 1, 3, 1, 3, 1, 66.6667, 2]


def test_checks_on_empty_table(spark):
    empty = spark.createDataFrame([], "id int, d date")
    suite = [q.row_count("t"), q.fresh("t", "d", "2024-01-01", 3), q.complete("t", "id", 50), q.not_null("t", "id")]
    got = {r.check: r.ok for r in q.run_checks({"t": empty}, suite).collect()}
    assert got == {"row_count": False, "fresh:d": False, "complete:id": False, "not_null:id": True}


def test_declared_checks(spark):
    declared = {
        "tests": [
            {"name": "nulls", "type": "schema", "query": "SELECT countIf(id IS NULL) AS a, countIf(id = 0) AS b FROM {database}.{table}",
             "expect": {"a": 0, "b": 1}},
            {"name": "share", "type": "assertion", "query": "SELECT countIf(id > 1) * 100.0 / count() > 80 FROM {database}.{table}", "expected": False},
            {"name": "at_least", "query": "SELECT count() FROM {{ target_table }}", "threshold": 5, "comparison": ">", "severity": "warning"},
            {"name": "more", "query": "SELECT count() AS n, max(id) AS m FROM {{ target_table }}", "expect_greater_than": {"n": 2, "m": 2}},
            {"name": "least", "query": "SELECT count() AS n FROM {{ target_table }}", "expect_greater_than_or_equal": {"n": 3}},
            {"name": "days", "query": "SELECT countIf(dateDiff('day', toDateTime64('2024-01-01 23:59:59', 3), toDateTime('2024-01-02')) != 1) FROM {database}.{table}"},
            {"name": "text", "query": "SELECT countIf(NOT match(string(id), '^[0-9]$')) FROM {database}.{table}", "threshold": 0},
            {"name": "monday", "query": "SELECT max(toMonday(toDate('2024-01-03'))) = toDate('2024-01-01') FROM {database}.{table}"},
            {"name": "broken", "type": "mystery", "severity": "info"},
        ]
    }
    df = spark.createDataFrame([(0,), (1,), (2,)], "id int")
    got = {r.check: r.ok for r in q.run_checks({"shop.t": df}, q.suite_from_dict(declared, "shop.t")).collect()}
    assert got == {
        "nulls": True, "share": True, "at_least": False, "more": False, "least": True, "days": True, "text": True,
        "monday": True, "broken": False,
    }


def test_gate(spark):
    assert [r.check for r in q.gate(spark, "no_such_table", "d", "2024-01-01", "2024-01-01").collect()] == ["table_exists"]
    spark.sql("SELECT date'2024-01-01' AS d").createOrReplaceTempView("gated")
    got = {r.check: r.ok for r in q.gate(spark, "gated", "d", "2024-01-01", "2024-01-01 01:00:00").collect()}
    assert got == {"table_exists": True, "has_data": True, "freshness": True}
    got = {r.check: r.ok for r in q.gate(spark, "gated", "d", "2024-01-02", "2024-01-02 00:00:00").collect()}
    assert got == {"table_exists": True, "has_data": False, "freshness": False}


def test_contract(spark):
    c = contract.Contract.from_dict(
        {"columns": [{"name": "id", "type": "integer", "nullable": False, "primary_key": True}, {"name": "v", "type": "decimal", "min_value": 0}]},
        "t", columns_rule="order",
    )
    df = spark.createDataFrame([("1", "5"), ("1", "-2"), ("x", "y"), (None, None)], "id string, v string")
    got = {r.check: r.observed for r in contract.contract_report(df, c).collect()}
    assert got == {"not_null:id": 1.0, "type:id": 1.0, "type:v": 1.0, "min:v": 1.0, "unique:id": 1.0}
    assert contract.column_problems(df.select("v", "id"), c) == [("column_order", "error", "v,id")]
    assert [p[0] for p in contract.column_problems(df.withColumn("z", F.lit(1)).drop("v"), c)] == ["missing_columns", "extra_columns"]
    with pytest.raises(ValueError):
        contract.validate_frame(df, ["nope"])
    with pytest.raises(ValueError):
        contract.validate_frame(df, ["id"], ["v"])


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "i int, s string")
    got = rows(profile.profile(df, "t", exact=True), "column_name", "ordinal", "nulls", "distinct_values")
    assert got == [("i", 1, 0, 2), ("s", 2, 1, 1)]
    counts = profile.row_counts({"big": spark.range(100000).toDF("id")}).first()
    assert counts.row_count_method == "exact" and counts.row_count == 100000
    assert rows(profile.profile(df, "t"), "column_name", "nulls", "distinct_values") == [("i", 0, 2), ("s", 1, 1)]
    assert rows(profile.profile(df.limit(0), "t", exact=True), "nulls", "distinct_values") == [(0, 0), (0, 0)]
    assert "Expand" not in profile.profile(df, "t", exact=True)._jdf.queryExecution().toString()


def test_distinct_counts_and_sketches(spark):
    rng = F.rand(4)
    df = spark.range(60000).select(
        "id", (F.col("id") % 4095).alias("under"), (F.col("id") % 4096).alias("at"), F.when(F.col("id") % 3 == 0, F.lit("")).alias("s"),
        F.array(F.col("id") % 7).alias("list"), F.round(rng * 9000).alias("x"), F.lit(None).cast("int").alias("none"),
    )
    x = df.select("x").distinct().count()
    want = [(0, 60000), (0, 4095), (0, 4096), (40000, 1), (0, 7), (0, x), (60000, 0)]
    few = df.select("at")
    for sketch in (12, 18):  # large columns are counted apart, then none is large
        assert profile.distinct_counts({"t": df, "few": few}, sketch) == {"t": want, "few": [(0, 4096)]}
    assert profile.distinct_counts({"t": df.where("false")}, 12) == {"t": [(0, 0)] * 7}
    sketched = profile.profile(df.drop("list"), "t").collect()
    exact = profile.profile(df.drop("list"), "t", exact=True).collect()
    for a, b in zip(sketched, exact):  # the sketch form promises 5 % (one standard error)
        assert (a.column_name, a.nulls) == (b.column_name, b.nulls)
        assert abs(a.distinct_values - b.distinct_values) <= 0.2 * b.distinct_values


def test_inventory_by_day(spark, tmp_path):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))
    df = spark.range(40000).select(
        F.when(F.col("id") % 100 != 0, day).alias("d"), "id", F.col("id").cast("string").alias("a.b`c"),
        F.when(F.col("id") % 5 == 0, F.lit("")).alias("s"), F.array("id").alias("list"), F.create_map("id", "id").alias("map"),
    )
    path = str(tmp_path / "days")
    inventory.store_days(df, F.col("d"), path)
    one_day = inventory.day_states(df.where("id = 1"), F.col("d"))
    text = one_day._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "Expand" not in text
    # a day that is run again counts once, a later column is unknown to earlier days
    wider = df.withColumn("late", F.lit(1.5))
    inventory.store_days(wider, F.col("d"), path, "2024-01-03", "2024-01-03")
    got = {r.column_name: r for r in inventory.inventory(inventory.read_days(spark, path), "t", wider.schema).collect()}
    assert list(got) == wider.columns and [r.ordinal for r in got.values()] == list(range(1, 8))
    assert {r.rows for r in got.values()} == {40000}
    assert got["d"].nulls == 400 and (got["d"].min_value, got["d"].max_value) == ("2024-01-01", "2024-01-04")
    assert got["s"].nulls == 32000 and got["s"].distinct_values == 1 and got["s"].min_value == ""
    assert (got["late"].nulls, got["late"].distinct_values, got["late"].min_value) == (0, 1, "1.5")
    assert (got["id"].min_value, got["id"].max_value, got["list"].min_value, got["map"].max_value) == ("0", "39999", None, None)
    for name in ("id", "a.b`c", "list", "map"):  # within four standard errors
        assert abs(got[name].distinct_values / 40000 - 1) < 0.08
    part = inventory.read_days(spark, path, "2024-01-02", "2024-01-03")
    assert inventory.inventory(part, "t", df.schema).first().rows == 20000
    assert "PartitionFilters: [isnotnull(inventory_day" in part._jdf.queryExecution().executedPlan().toString()
    none = inventory.read_days(spark, path, "2030-01-01")
    assert [tuple(r)[4:] for r in inventory.inventory(none, "t", df.select("id").schema).collect()] == [(0, 0, 0, None, None)]
    with pytest.raises(ValueError, match="sketch"):
        inventory.day_states(df, F.col("d"), "exact")


def test_lifecycle_is_the_same_from_any_source(spark, tmp_path):
    cols = "entity_type string, entity_id string, timestamp timestamp, event_type string, event_timestamp_source string, event_id string"
    days = [("order", "a", f"2024-01-0{i + 1} 00:00:00", f"t{i}", "s", f"e{i}") for i in range(6)]
    df = spark.createDataFrame(days, cols.replace("timestamp timestamp", "timestamp string")).withColumn("timestamp", F.to_timestamp("timestamp"))
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    both = [sorted(map(str, metrics.entity_lifecycle(x, max_events=2).collect())) for x in (df, stored)]
    assert both[0] == both[1] and len(both[0]) > 1


def test_sums_keep_their_decimals(spark):
    df = spark.createDataFrame([(1, 0.004)] * 1000, "g int, v double")
    got = metrics.group_summary(df, ["g"], "g", "v").first()
    assert got.total == 4.0 and got.average == pytest.approx(0.004)
    nan = spark.createDataFrame([(1, float("nan"))], "g int, v double")
    with pytest.raises(Exception, match="not a number"):
        metrics.group_summary(nan, ["g"], "g", "v").collect()


def test_skewed_and_null_keys_are_dealt(spark):
    left = spark.range(2000).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, w string")
    for how in ("left", "inner", "left_anti", "left_semi"):
        assert rows(joins.skew_join(left, right, ["k"], how, hot_rows=50), "id") == rows(left.join(right, ["k"], how), "id")
    hot, missing = joins.hot_keys(left, ["k"], 50)
    assert len(hot) == 3 and all(5 <= n <= 8 for n in hot.values()) and missing == 1000
    text = joins.skew_join(left, right, ["k"], "left", hot_rows=50)._jdf.queryExecution().toString()
    assert "_salt" in text and "HINT" not in text.upper().split("PHYSICAL")[0]


def test_a_table_may_share_its_name_with_a_column(spark):
    df = spark.createDataFrame([(7,), (3,)], "user int")
    suite = [
        q.custom_sql("user", "big", "SELECT count(user) FROM user WHERE user > 5", threshold=1),
        q.custom_sql("user", "own", "SELECT count(u.user) FROM user AS u JOIN user v ON u.user = v.user", threshold=2),
        q.custom_sql("user", "said", "SELECT count(user.user) FROM user", threshold=2),
    ]
    assert [r.ok for r in q.run_checks({"user": df}, suite).collect()] == [True] * 3

def test_derived_columns_see_cleaned_values(spark):
    raw = spark.createDataFrame([("1", " Ann ", None), ("2", None, " Lee"), ("3", "", "")], "id string, first string, last string")
    s = spec(
        dedupe={"partition_by": ["id"], "order_by": ["id"]}, transforms={},
        derived={"full": "CASE WHEN first != '' AND last != '' THEN concat(first, ' ', last) WHEN first != '' THEN first WHEN last != '' THEN last ELSE 'Unknown' END"},
    )
    assert rows(clean.build_clean(raw, s), "id", "full") == [("1", "Ann"), ("2", "Lee"), ("3", "Unknown")]
    by_derived = spec(dedupe={"partition_by": ["n"], "order_by": ["id DESC"]}, transforms={}, derived={"n": "length(first)"})
    assert rows(clean.build_clean(raw, by_derived), "id") == [("1",), ("3",)]


def test_user_daily_with_missing_values(spark):
    rows = spark.createDataFrame(
        [(1, "a", 10, "x", 1), (1, "a", 20, "x", 0), (2, "a", None, None, 1), (None, "a", 400, "y", 1), (3, "b", None, None, None)]
        + [(9, "c", 1, d, 1) for d in ("p", "q", "q", "r", "s", "t", "u", None, None, None)],
        "user_id long, organization_id string, user_age_days int, email_domain string, is_active int",
    ).selectExpr("*", "date'2024-01-01' AS processing_date", "date'2024-01-01' AS created_date", "'active' AS status")
    got = {r.organization_id: r for r in metrics.user_daily(rows).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.total_users, a.active_users, a.inactive_users, a.users_0_30_days, a.users_over_1_year, a.new_users) == (2, 2, 1, 1, 0, 2)
    assert (a.avg_user_age_days, a.min_user_age_days, a.max_user_age_days, a.median_user_age_days) == (430 / 3, 10, 400, 20.0)
    assert a.top_email_domains == ["x", "y"]
    assert (b.total_users, b.active_users, b.avg_user_age_days, b.median_user_age_days, b.top_email_domains) == (1, 0, None, None, None)
    assert c.top_email_domains == ["q", "p", "r", "s", "t"] and c.total_users == 1
    counts = {r.organization_id: r for r in metrics.user_daily_counts(rows).collect()}
    assert (counts["a"].total_users, counts["a"].active_users, counts["a"].inactive_users) == (2, 2, 1)
    assert (counts["a"].median_user_age_days, counts["b"].avg_user_age_days, counts["c"].active_users) == (15.0, None, 10)
    assert metrics.user_daily(rows.limit(0)).count() == 0
