import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators.dedupe import replacing_merge
from lakepipe.operators.states import State
from lakepipe.plans import backfill, related, timeline
from lakepipe.plans.metric import Metric
from lakepipe.session import shared_dir
from lakepipe.sources import readers, writers
from lakepipe.sources.deltas import DeltaTable
from lakepipe.streaming import incremental as inc


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


ACCOUNT = {
    "source": {"database": "crm_silver", "table": "account", "primary_key": "rec_id", "org_filter_column": "org"},
    "timeline": {
        "entity_type": "account",
        "events": [
            {"type": "account_created", "timestamp_field": "rec_add", "timestamp_source": "rec_add", "condition": "rec_add IS NOT NULL",
             "description_template": "Account '{name}' created", "metadata": {"kind": "COALESCE(kind, '')", "n": "toString(COALESCE(n, 0))"}},
            {"type": "account_updated", "timestamp_field": "rec_edit", "timestamp_source": "rec_edit",
             "condition": "rec_edit IS NOT NULL AND rec_add IS NOT NULL AND rec_edit != rec_add", "description_template": "Account updated"},
        ],
    },
}


def accounts(spark):
    return spark.sql(
        """SELECT * FROM VALUES
        (1, 'o1', 'A', NULL, 3, timestamp'2024-01-01', timestamp'2024-01-02', date'2024-01-03'),
        (2, 'o1', NULL, 'k', NULL, timestamp'2024-01-01', timestamp'2024-01-01', date'2024-01-03'),
        (3, 'o2', 'C', 'k', 1, NULL, timestamp'2024-01-02', date'2024-02-03'),
        (NULL, 'o1', 'D', 'k', 1, timestamp'2024-01-01', NULL, date'2024-01-03')
        AS t(rec_id, org, name, kind, n, rec_add, rec_edit, processing_date)"""
    )


def test_timeline(spark):
    spec = timeline.TimelineSpec.from_dict(ACCOUNT)
    out = timeline.build_timeline(accounts(spark), spec, as_of="2024-06-01")
    assert out.schema.simpleString() == timeline.SCHEMA.simpleString()
    got = rows(out, "entity_id", "event_type", "description", "metadata")
    assert got == [
        ("account_1", "account_created", "Account 'A' created", '{"kind":"","n":"3"}'),
        ("account_1", "account_updated", "Account updated", None),
        ("account_2", "account_created", "Account '' created", '{"kind":"k","n":"0"}'),
    ]
    again = timeline.build_timeline(accounts(spark), spec, as_of="2024-07-01")
    assert rows(out, "event_id") == rows(again, "event_id")
    assert timeline.build_timeline(accounts(spark), spec, tenant="o2").count() == 0
    # re-loading the same rows does not add events
    assert timeline.merge_timeline(out, again).count() == 3


def test_registry_of_providers():
    providers = [
        {"name": "crm", "sources": [{"name": "a", "config_path": "a.yaml"}, {"name": "b", "config_path": "b.yaml", "enabled": False}]},
        {"name": "off", "enabled": False, "sources": [{"name": "c", "config_path": "c.yaml"}]},
    ]
    entries = timeline.enabled_sources(providers, lambda path: {"a.yaml": ACCOUNT}[path])
    assert [(e.spec.source, e.spec.system) for e in entries] == [("crm_silver.account", "crm")]


def test_entity_events(spark):
    spec = timeline.TimelineSpec("s.t", "call", "rec_id", timeline.entity_events("rec_add", "rec_edit", "call", ("made", "made_at")), "s", "org")
    df = accounts(spark).withColumn("made_at", F.lit("2024-01-01").cast("timestamp"))
    out = timeline.build_timeline(df, spec)
    assert rows(out, "entity_id", "event_type") == [
        ("call_1", "call_created"), ("call_1", "call_updated"), ("call_2", "call_created"), ("call_3", "call_made"),
    ]


def test_stream_equals_batch_and_does_not_repeat(spark):
    src, out, progress = (shared_dir(spark, n) for n in ("src", "out", "cp"))
    spec = timeline.TimelineSpec.from_dict(ACCOUNT)
    accounts(spark).filter("rec_id = 1").write.parquet(src)
    schema = accounts(spark).schema

    def run():
        inc.append_timeline(inc.stream_folder(spark, src, schema), spec, out, progress, as_of="2024-06-01").awaitTermination()
        return rows(spark.read.parquet(out), "event_id", "event_type")

    assert len(run()) == 2
    assert len(run()) == 2
    accounts(spark).filter("rec_id > 1").write.mode("append").parquet(src)
    assert run() == rows(timeline.build_timeline(accounts(spark), spec), "event_id", "event_type")


def test_maintained_metric_replays_once(spark):
    src, out, progress, second = (shared_dir(spark, n) for n in ("src", "out", "cp", "cp"))
    keys, spec = ["k"], [State("n", "count"), State("avg", "avg", "v"), State("users", "uniq", "v")]
    data = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    data.filter("v < 40").write.parquet(src)
    run = lambda cp: inc.maintain_metric(inc.stream_folder(spark, src, data.schema), keys, spec, out, cp).awaitTermination()
    run(progress)
    run(second)  # the same batch again, as after a lost commit
    data.filter("v >= 40").write.mode("append").parquet(src)
    run(progress)
    got = rows(inc.read_metric(spark, out, keys, spec), "k", "n", "avg")
    assert got == rows(data.groupBy("k").agg(F.count("*").alias("n"), F.avg("v").alias("avg")), "k", "n", "avg")


def test_upsert_adds_each_batch_once_per_partition(spark):
    path, keys, spec = shared_dir(spark, "upsert"), ["k"], [State("n", "count"), State("top", "max", "v")]
    batch = lambda lo, hi: spark.range(lo, hi).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("day"), F.col("id").alias("v"))
    inc.upsert_batch(batch(0, 100), 0, keys, ["day"], spec, path)
    inc.upsert_batch(batch(100, 200), 1, keys, ["day"], spec, path)
    inc.upsert_batch(batch(100, 200), 1, keys, ["day"], spec, path)  # again
    inc.upsert_batch(batch(200, 300).where("day = 1"), 2, keys, ["day"], spec, path)  # reached one partition only,
    inc.upsert_batch(batch(200, 300), 2, keys, ["day"], spec, path)  # then all of them
    stored = spark.read.parquet(path)
    assert stored.count() == stored.select("k", "day").distinct().count() == 12
    want = batch(0, 300).groupBy("k", "day").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    assert rows(inc.read_upserted(spark, path, spec), "k", "day", "n", "top") == rows(want, "k", "day", "n", "top")


def test_delta_table(spark):
    frame = lambda xs: spark.createDataFrame(xs, "id long, version int, v string")
    base = [(i, 1, "base") for i in range(100)]
    table = DeltaTable(spark, shared_dir(spark, "deltas"), ["id"], ["version DESC"], frame([]).schema)
    assert table.read().count() == 0
    table.merge(frame(base), 0)
    files = sorted(spark.read.parquet(table.parts()[0].path).inputFiles())
    want = frame(base)
    for n in range(1, 6):
        new = frame([(n, 2, f"new{n}"), (50, n, "fifty"), (50, n - 1, "late"), (7, 0, "old"), (200 + n, 1, "more")])
        assert table.merge(new, n) and not table.merge(frame([(1, 99, "replayed")]), n)
        want = replacing_merge(want, new, ["id"], "version")
    assert len(table.parts()) == 6 and sorted(spark.read.parquet(table.parts()[0].path).inputFiles()) == files
    assert rows(table.read(), "*") == rows(want, "*")
    before = rows(table.read(before=3), "*")
    spark.createDataFrame([(1, 5, "x", 9)], "id long, version int, v string, _change long").write.parquet(f"{table.path}/half")
    half = f"{table.path}/{1:012d}-{5:012d}"  # a compaction that was cut off: files, but no mark
    spark.createDataFrame([(1, 5, "x", 9)], "id long, version int, v string, _change long").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert len(table.parts()) == 6 and rows(table.read(), "*") == rows(want, "*")
    table.compact(most=3)
    assert [(p.first, p.last) for p in table.parts()] == [(0, 0), (1, 5)]  # the base is larger and stays
    assert rows(table.read(), "*") == rows(want, "*") and rows(table.read(before=3), "*") == before
    table.merge(frame([(i, 9, "all") for i in range(300)]), 6)
    table.compact(most=2)
    assert [(p.first, p.last) for p in table.parts()] == [(0, 6)] and table.read().count() == 300


def test_first_touch_day_by_day(spark):
    from lakepipe.operators.metrics import attribution_by_source
    from lakepipe.plans import first_touch as ft

    path = shared_dir(spark, "hits")
    hits = spark.range(4000).select(
        F.when(F.col("id") % 97 > 0, F.col("id") * 7919 % 300).alias("lead_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("id") * 3)).alias("date_hit"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    ).withColumn("day", F.to_date("date_hit"))
    hits.write.partitionBy("day").parquet(path)
    hits, table = spark.read.parquet(path), ft.first_touch_table(spark, shared_dir(spark, "touches"))
    ft.load_history(hits, table, "2024-01-03")
    names = ("traffic_source", "unique_leads", "total_visits", "first_touch_leads", "visits_per_lead")
    for day in ("2024-01-03", "2024-01-04", "2024-01-04", "2024-01-05"):
        got = ft.attribution_day(hits.where(F.col("day") == F.lit(day).cast("date")), table, day)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [isnotnull(day" in text  # that day's folder and the state, nothing else
        assert rows(got, *names) == rows(attribution_by_source(hits, day), *names)
    assert len(table.parts()) == 4


def test_messages(spark):
    raw = spark.createDataFrame([('{"a":1,"b":"x"}',), ("{bad",)], "value string")
    assert [tuple(r) for r in inc.parse_messages(raw, T.StructType.fromDDL("a INT, b STRING")).collect()] == [(1, "x"), (None, None)]


def test_read_raw(spark):
    path = shared_dir(spark, "raw")
    spark.sql("SELECT 1 AS id, '007' AS part").write.partitionBy("part").orc(path)
    spark.sql("SELECT 2 AS id, 'n' AS extra, '008' AS part").write.mode("append").partitionBy("part").orc(path)
    fixed = readers.read_raw(spark, path, "orc", [{"name": "id", "type": "Int32"}, {"name": "extra", "type": "String"}], {"part": "String"})
    assert rows(fixed.fillna("-"), "id", "extra", "part") == [(1, "-", "007"), (2, "n", "008")]
    inferred = readers.read_raw(spark, path, "orc", None, {"part": "Int32"}, "*.orc")
    assert rows(inferred.fillna("-"), "id", "extra", "part") == [(1, "-", 7), (2, "n", 8)]


def test_read_csv(spark, tmp_path):
    f = tmp_path / "x.csv"
    f.write_text(' ID ,Name\n1," two\nlines "\nNULL,NA\n')
    df = readers.read_csv(spark, str(f), multiline=True)
    assert df.columns == ["id", "name"] and [tuple(r) for r in df.collect()] == [("1", "two\nlines"), (None, None)]
    assert readers.read_csv_typed(spark, str(f)).columns == [" ID ", "Name"]


def test_merge_keeps_rows_without_a_partition(spark):
    path = shared_dir(spark, "merge")
    old = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, None, 1)], "k int, p string, v int")
    writers.write_partitions(old, path, ["p"], mode="overwrite")
    new = spark.createDataFrame([(3, None, 2), (4, None, 1)], "k int, p string, v int")
    writers.merge_partitions(new, path, ["k"], "v", ["p"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 1), (3, 2), (4, 1)]


def test_partition_overwrite_leaves_the_rest(spark):
    path = shared_dir(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, p string")
    writers.write_partitions(df, path, ["p"], mode="overwrite")
    writers.write_partitions(spark.createDataFrame([(9, "a")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "v") == [(2,), (3,), (9,)]
    with pytest.raises(ValueError):
        writers.write_partitions(df, path, ["p"], mode="merge")


def test_publish_and_expire(spark):
    df = spark.sql("SELECT 1 AS v, date'2024-01-01' AS d UNION ALL SELECT 2, date'2024-03-01'")
    writers.publish(df, "published", ["d"])
    writers.publish(df.select("d", "v"), "published", ["d"], "append")
    assert spark.table("published").count() == 4
    assert writers.drop_expired(spark, "published", "d", 30, "2024-03-10") == 1
    assert rows(spark.table("published"), "v") == [(2,), (2,)]
    writers.publish(df, "published", ["d"], "overwrite")
    assert spark.table("published").count() == 2
    with pytest.raises(ValueError):
        writers.publish(df, "published", [], "upsert")
    spark.sql("DROP TABLE published")


def test_insert_new(spark):
    path = shared_dir(spark, "t")
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(path)
    offered = spark.createDataFrame([(1, "new"), (2, "x"), (2, "y"), (3, "z")], "k int, v string")
    for _ in range(2):
        writers.insert_new(offered, path, ["k"], ["v DESC"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "old"), (2, "y"), (3, "z")]


def test_audit(spark):
    path = shared_dir(spark, "landed")
    df = spark.range(7).withColumn("p", F.col("id") % 2)
    audit = writers.land_with_audit(df, path, "s.t", "src", "r1", "2024-01-01", ["p"]).first()
    assert audit.rows_written == 7 and spark.read.parquet(path).filter("__run_id = 'r1'").count() == 7
    assert writers.append_counted(df, shared_dir(spark, "sink")) == 7


def test_date_parts(spark):
    df = spark.sql("SELECT timestamp'2024-05-06' AS t")
    assert tuple(writers.add_date_parts(df, "t").select("year", "month", "day").first()) == (2024, 5, 6)
    assert writers.add_date_parts(df, "t", ("year",), "email_").columns == ["t", "email_year"]
    assert writers.add_date_parts(df, "absent").columns == ["t"]


def test_backfill(spark):
    path = shared_dir(spark, "bf")
    src = spark.sql("SELECT date'2024-01-01' + i AS d, i FROM (SELECT explode(sequence(0, 9)) i)")
    backfill.backfill(src, "d", "2024-01-02", "2024-01-04", lambda df: df, path)
    backfill.backfill(src.withColumn("i", F.lit(0)), "d", "2024-01-04", "2024-01-05", lambda df: df, path)
    assert rows(spark.read.parquet(path), "i") == [(0,), (0,), (1,), (2,)]
    backfill.backfill(src, "d", "2024-01-09", "2024-01-09", lambda df: df, path, clear=True)
    assert rows(spark.read.parquet(path), "i") == [(8,)]
    with pytest.raises(ValueError):
        backfill.days("2024-01-02", "2024-01-01")


def test_metric_modes(spark):
    df = spark.sql("SELECT date'2024-01-01' + i % 2 AS d, i FROM (SELECT explode(sequence(0, 9)) i)")
    sql = Metric("m", sql="SELECT d, count() AS n FROM facts WHERE d = toDate('{{ ds }}') GROUP BY d", required=("d", "n"), numeric=("n",))
    assert sql.run(spark, {"facts": df}, "2024-01-01").first().n == 5
    assert sql.validate(sql.run(spark, {"facts": df}, "2024-01-01")).filter("ok").count() == 2
    py = Metric("m", fn=lambda tables, ds: tables["facts"].filter(F.col("d") == ds).agg(F.sum("i").alias("s")))
    assert py.run(spark, {"facts": df}, "2024-01-02").first().s == 25
    assert sql.backfill(spark, {"facts": df}, "2024-01-01", "2024-01-03").count() == 2
    path = shared_dir(spark, "days")
    assert sql.backfill(spark, {"facts": df}, "2024-01-01", "2024-01-02", path=path).count() == 2
    assert sql.backfill(spark, {"facts": df.where("i % 2 = 0")}, "2024-01-02", "2024-01-02", path=path).count() == 0  # that day only
    assert spark.read.parquet(path).select(F.col("run_date").cast("string"), "n").collect() == [("2024-01-01", 5)]
    ranged = Metric("n", sql="SELECT d, count(*) AS n FROM facts WHERE d BETWEEN '{{ start }}' AND '{{ end }}' GROUP BY d", ranged=True)
    out = ranged.backfill(spark, {"facts": df}, "2024-01-01", "2024-01-03")
    assert out._jdf.queryExecution().toString().count("Union") == 0 and out.count() == 2
    with pytest.raises(ValueError):
        Metric("m")
    with pytest.raises(ValueError):
        Metric("m", sql="SELECT 1 AS x", required=("y",)).run(spark, {}, "2024-01-01")


def test_related_tables(spark):
    raw = {
        "users": spark.createDataFrame(
            [("u1", "null", "true"), (" u2 ", "x", "no"), ("u3", "y", None), ("u3", "y", None)], "id string, name string, is_deleted string"
        ),
        "orders": spark.createDataFrame(
            [("1", "o1", "u2", "2024-01-01 10:00:00", "Asia/Jakarta"), ("2", "o2", "u9", "2024-01-01 10:00:00", "Nope"), ("3", "", "u3", "x", None)],
            "num string, id string, user string, at string, zone string",
        ),
        "logs": spark.createDataFrame([("l1", "1"), ("l2", "o2"), ("l3", "zz")], "id string, ref string"),
    }
    rules = {
        "users": related.RelatedTable({"is_deleted": "bool"}, ["id"], ["id"], filters=["is_deleted != true OR is_deleted IS NULL"]),
        "orders": related.RelatedTable({"id": "string"}, ["id"], ["id"], "at", zones={"at": "zone"}),
        "logs": related.RelatedTable({}, ["id", "ref"], ["id"]),
    }
    keys = [related.ForeignKey("orders", "user", "users", "id", True, "null"), related.ForeignKey("logs", "ref", "orders", "id", False, "drop")]
    out = related.clean_related(raw, rules, keys, [related.Remap("logs", "ref", "orders", "num", "id")])
    assert rows(out["users"], "id") == [("u2",), ("u3",)]
    at = F.date_format("at", "HH:mm").alias("at")
    assert rows(out["orders"].fillna("-"), "id", "user", at) == [("o1", "u2", "03:00"), ("o2", "-", "10:00")]
    assert rows(out["logs"], "id", "ref") == [("l1", "o1"), ("l2", "o2")]


def test_short_cleaning(spark):
    df = spark.createDataFrame([("1", "2024-01-01T00:00:00+01:00"), ("1", "2024-01-01T00:00:00+01:00"), (None, "x")], "id string, at string")
    got = related.drop_duplicates_to_utc(df, ["id"], ["at"])
    assert rows(got.withColumn("at", F.col("at").cast("string")), "*") == [("1", "2023-12-31 23:00:00")]


def test_merge_partitions_rewrites_only_touched_ones(spark):
    path = shared_dir(spark, "merge")
    old = spark.createDataFrame([(1, "a", 1, "p1"), (2, "b", 1, "p1"), (3, "c", 1, "p2")], "k int, v string, ver int, p string")
    writers.write_partitions(old, path, ["p"], mode="overwrite")
    kept = [f for f in spark.read.parquet(path).inputFiles() if "p=p2" in f]
    new = spark.createDataFrame([(1, "A", 2, "p1"), (2, "B", 0, "p1"), (4, "D", 1, "p1")], "k int, v string, ver int, p string")
    for _ in range(2):
        writers.merge_partitions(new, path, ["k", "p"], "ver", ["p"])
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "A"), (2, "b"), (3, "c"), (4, "D")]
    assert [f for f in spark.read.parquet(path).inputFiles() if "p=p2" in f] == kept


def test_a_large_flag_is_extracted_by_several_tasks(spark, tmp_path):
    import glob
    import re

    import __spark_entry__ as entry

    rows_ = spark.range(0, 60000, 1, 8).select(F.col("id").alias("l_orderkey"), F.lit("N").alias("l_returnflag"), F.rand(1).alias("x"))
    rows_.write.parquet(f"{tmp_path}/lineitem.parquet")
    base, size = spark.conf.get("spark.checkpoint.dir"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = set(glob.glob(f"{base}/chunks-*"))
    spark.conf.set(size, "64k")
    try:
        got = [tuple(r) for r in entry.queries()["chunked_extract"](spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset(size)
    assert got == [("N", 60000, 12)]
    (made,) = set(glob.glob(f"{base}/chunks-*")) - before
    tasks = {re.search(r"part-(\d+)", f).group(1) for f in glob.glob(f"{made}/*.orc")}
    assert len(tasks) > 3  # it was one task, for one flag


def test_partition_writers_do_not_sort_a_task(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    name = "spark.sql.maxConcurrentOutputFileWriters"
    seen, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (seen.append(spark.conf.get(name)), save(self, *a, **k))[1])
    df = spark.range(1000).select("id", (F.col("id") % 30).alias("p"), F.lit("2024-01-01").alias("d"))  # more folders than open files
    writers.write_partitions(df, f"{tmp_path}/a", ["p"], mode="overwrite")
    writers.write_partitions(df, f"{tmp_path}/b", ["p"], mode="overwrite", sort=["id"])
    writers.extract_table(df, f"{tmp_path}/c", "d")
    assert seen == [str(writers.OPEN_FILES), "0", str(writers.OPEN_FILES)] and spark.conf.get(name) == "0"
    for path in "ab":
        assert rows(spark.read.parquet(f"{tmp_path}/{path}"), "id", "p") == rows(df, "id", "p")
    assert spark.read.orc(f"{tmp_path}/c").count() == 1000


def test_related_rows_move_once_for_remap_and_reference(spark):
    import re

    moved = {}

    def stage(df, name):
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        moved[name] = len(re.findall(r"\) Exchange\nInput \[[^\n]*\bnote#", text))
        return df.localCheckpoint()

    parents = spark.createDataFrame([("O1", "1"), ("O2", "2"), ("O2", "2"), ("", "4")], "id string, number string")
    rows_ = [("a", "1", "x"), ("b", "O2", "y"), ("c", "3", "z"), ("d", None, "w"), ("e", "1", None), ("f", "4", "v"), ("g", "2", "u")]
    lines = spark.createDataFrame(rows_, "id string, ref string, note string")
    rules = {"p": related.RelatedTable({"id": "string"}, ["id"], ["id"]), "l": related.RelatedTable({"ref": "string"})}
    keys, remap = [related.ForeignKey("l", "ref", "p", "id", False, "drop")], [related.Remap("l", "ref", "p", "number", "id")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = related.clean_related({"p": parents, "l": lines}, rules, keys, remap, stage)["l"]
        assert out.columns == ["id", "ref", "note"]
        assert rows(out, *out.columns) == [("a", "O1", "x"), ("b", "O2", "y"), ("e", "O1", None), ("g", "O2", "u")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved["l"] == 1  # it was twice
