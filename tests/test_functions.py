import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakepipe.functions import dialect, jsons, numeric, registry, templates, text, times
from lakepipe.types import spark_type


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(build("c")).collect()]


def test_text(spark):
    assert apply(spark, [" padded ", None, ""], text.clean_string) == ["padded", "", ""]
    assert apply(spark, [" eur ", None], lambda c: text.clean_string(c, "USD")) == ["eur", "USD"]
    assert apply(spark, [" A@B.Org "], text.clean_email) == ["a@b.org"]
    assert apply(spark, ["+1 (555) 010-2x", None], text.clean_phone) == ["15550102", ""]
    emails = ["a@b.org", "nobody", "a@b@c.org", None]
    assert apply(spark, emails, text.extract_email_domain) == ["b.org", "", "b", ""]
    assert apply(spark, emails, lambda c: F.coalesce(text.email_domain_after_at(c), F.lit("-"))) == ["b.org", "", "b@c.org", ""]
    assert apply(spark, emails, text.email_last_part) == ["b.org", "nobody", "c.org", ""]
    assert apply(spark, [0, None, 7], text.id_or_blank, "int") == ["", "", "7"]
    assert apply(spark, ["", None, "x"], lambda c: text.if_null(c, "direct", True)) == ["direct", "direct", "x"]
    assert apply(spark, ["", " ", "null", "None", "x"], text.blank_to_null) == [None, None, None, None, "x"]


def test_normalize_keeps_declared_order(spark):
    words = ["Active", "Inactive", "closed", "Waiting", "removed", " Other ", "", None]
    got = apply(spark, words, text.normalize_status)
    assert got == ["active", "active", "closed", "pending", "deleted", "other", "unknown", "unknown"]
    rules = [("active", "active"), ("inactive", "inactive")]
    assert apply(spark, ["Inactive"], lambda c: text.normalize(c, rules, whole_word=True)) == ["inactive"]
    leads = [("qualified", "qualified"), ("unqualified", "unqualified")]
    assert apply(spark, ["Unqualified", "x"], lambda c: text.normalize(c, leads, "new", keep_other=False)) == ["qualified", "new"]


def test_names(spark):
    df = spark.createDataFrame([(" A ", "B"), ("A", None), (None, " B"), ("", "")], "f string, l string")
    assert [r[0] for r in df.select(text.full_name("f", "l")).collect()] == ["A B", "A", "B", "Unknown"]


def test_flags(spark):
    assert apply(spark, ["Yes", "0", "maybe", None], numeric.normalize_boolean) == [1, 0, 0, 0]
    assert apply(spark, [" YES ", "N", "maybe", None], numeric.parse_bool) == [True, False, None, None]
    assert apply(spark, [True, False, None], numeric.flag_to_int, "boolean") == [1, 0, 0]
    assert apply(spark, [True, None], lambda c: numeric.flag_to_int(c, True), "boolean") == [1, None]


def test_strict_money_raises(spark):
    assert apply(spark, ["$1,234.56", None], numeric.parse_money) == [Decimal("1234.56"), Decimal("0.00")]
    assert apply(spark, ["12.5%"], numeric.parse_percentage) == [Decimal("12.50")]
    with pytest.raises(PySparkException):
        apply(spark, ["junk"], numeric.parse_money)
    with pytest.raises(PySparkException):  # too wide for decimal(5,2)
        apply(spark, ["12345678.9"], numeric.parse_percentage)


def test_lenient_numbers(spark):
    values = ["$1,234.56", "junk", None, "-2.5", "1e2"]
    assert apply(spark, values, numeric.money_or_zero) == [Decimal(x) for x in ("1234.56", "0.00", "0.00", "-2.50", "100.00")]
    factor = lambda c: numeric.decimal_or(c, 1, 0, when_null=1)
    assert apply(spark, [None, "x", "2.5"], factor) == [Decimal("1.0"), Decimal("0.0"), Decimal("2.5")]
    assert apply(spark, [" 12 ", "1.5", "x", None, "99999999999999999999"], numeric.int_or_zero) == [12, 0, 0, 0, 0]
    assert apply(spark, ["12", "x", None], numeric.safe_int) == [12, None, None]
    assert apply(spark, ["1.5", "x", "NaN"], numeric.safe_float) == [1.5, None, None]


def test_parse_timestamp(spark):
    cases = {
        "2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05.250": dt.datetime(2024, 1, 2, 3, 4, 5, 250000),
        "2024-01-02T03:04:05+02:00": dt.datetime(2024, 1, 2, 1, 4, 5),
        "20240102": dt.datetime(2024, 1, 2),
        "20240102030405": dt.datetime(2024, 1, 2, 3, 4, 5),
        "1704164645": dt.datetime(2024, 1, 2, 3, 4, 5),
        "1704164645000": dt.datetime(2024, 1, 2, 3, 4, 5),
        "01/02/2024": dt.datetime(2024, 2, 1),
        "01/25/2024 10:30": dt.datetime(2024, 1, 25, 10, 30),
        "2024/01/02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "05 Jan 2024 10:00:00": dt.datetime(2024, 1, 5, 10),
        "Fri, 05 January 2024 10:00:00": dt.datetime(2024, 1, 5, 10),
        "Jan 5 2024": dt.datetime(2024, 1, 5),
        "Dec 31, 2024 23:59": dt.datetime(2024, 12, 31, 23, 59),
        "2024-01-02 03:04:05 PM": dt.datetime(2024, 1, 2, 15, 4, 5),
        "02/01/2024 12:30 am": dt.datetime(2024, 1, 2, 0, 30),
        "Jan 5 2024 12:05 PM": dt.datetime(2024, 1, 5, 12, 5),
        "20240102153000 pm": dt.datetime(2024, 1, 2, 15, 30),
        "20240102033000 PM": dt.datetime(2024, 1, 2, 15, 30),
        "05 Foo 2024": None,
        "2024-13-01": None,
        "junk": None,
        "": None,
    }
    out = lambda c: F.date_format(times.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    want = [v and v.strftime("%Y-%m-%d %H:%M:%S.%f") for v in cases.values()]
    assert apply(spark, list(cases), out) == want
    declared = lambda c: F.date_format(dialect.spark_expr("parseDateTime64BestEffortOrNull(v)"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    texts = spark.createDataFrame([(v,) for v in cases], "v string")
    assert [r[0] for r in texts.select(declared("v")).collect()] == want
    month_first = lambda c: F.to_date(times.parse_timestamp(c, day_first=False)).cast("string")
    assert apply(spark, ["01/02/2024", "25/01/2024"], month_first) == ["2024-01-02", "2024-01-25"]
    assert apply(spark, [20240102, 20241301], lambda c: times.parse_date(c).cast("string"), "int") == ["2024-01-02", None]


def test_differences_count_boundaries(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 23:59:59' AS a, timestamp'2024-01-02 00:00:00' AS b")
    got = df.select(times.day_diff("a", "b"), times.minute_diff("a", "b"), times.second_diff("a", "b"), times.minute_diff("b", "a"))
    assert tuple(got.first()) == (1, 1, 1, -1)
    assert df.select(times.monday("a").cast("string")).first()[0] == "2024-01-01"


def test_epochs_and_zones(spark):
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert apply(spark, ["1704164645999", "bad", None], lambda c: fmt(times.from_epoch_ms(c)))[:2] == ["2024-01-02 03:04:05", "1970-01-01 00:00:00"]
    df = spark.createDataFrame(
        [("2024-01-02 10:00:00", "Asia/Jakarta"), ("2024-01-02 10:00:00", "Mars/Base"), ("2024-01-02 10:00:00", None),
         ("2024-01-02T10:00:00Z", "Asia/Jakarta"), ("2024-07-02 10:00:00", "America/New_York"), ("x", "UTC")],
        "t string, z string",
    )
    got = [r[0] for r in df.select(fmt(times.to_utc("t", "z"))).collect()]
    assert got == ["2024-01-02 03:00:00", "2024-01-02 10:00:00", "2024-01-02 10:00:00", "2024-01-02 10:00:00", "2024-07-02 14:00:00", None]


def test_json(spark):
    docs = ['{"a":{"b":"x"},"n":3}', "{bad", None]
    assert apply(spark, docs, lambda c: jsons.json_string(c, "a", "b")) == ["x", "", ""]
    assert apply(spark, docs, lambda c: jsons.json_int(c, "n")) == [3, 0, 0]
    assert apply(spark, docs, jsons.is_valid_json) == [1, 0, 0]
    arrays = ['[{"t":1},{"t":2}]', "[]", "", None, "{bad"]
    assert apply(spark, arrays, jsons.json_array_size) == [2, 0, 0, 0, 0]
    assert apply(spark, arrays, lambda c: jsons.json_array_count(c, lambda x: F.get_json_object(x, "$.t") == "2")) == [1, 0, 0, 0, 0]
    df = spark.createDataFrame([(a,) for a in arrays], "c string")
    assert sorted(r[0] for r in jsons.explode_json(df, "c", "e").select("e").collect()) == ['{"t":1}', '{"t":2}']
    lists = ["['a', 'b']", "a, b", "", None, "x"]
    assert apply(spark, lists, jsons.parse_list) == [["a", "b"], ["a", "b"], [], [], ["x"]]


def test_interchange(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-02 03:04:05.5' t, date'2024-01-02' d, 1.50BD n, binary('hi') b, array(1,2) a, map('k',1) m, 1 i"
    )
    assert tuple(jsons.interchange(df).first()) == ("2024-01-02T03:04:05.500000", "2024-01-02", "1.50", "aGk=", "[1,2]", '{"k":1}', 1)


def test_templates(spark):
    df = spark.createDataFrame([("x", -2.5), (None, None)], "a string, b double")
    out = [r[0] for r in df.select(templates.render("[{a}] ${abs(b)} end")).collect()]
    assert out == ["[x] $2.5 end", "[] $ end"]
    ids = [r[0] for r in df.select(templates.stable_id("a", "b")).collect()]
    assert len(set(ids)) == 2 and ids == [r[0] for r in df.select(templates.stable_id("a", "b")).collect()]


def test_dialect():
    assert dialect.spark_text("toString(COALESCE(a, 0))") == "string(COALESCE(a, 0))"
    assert dialect.spark_text("count() , countDistinct(x), countIf(a = 1)") == "count(*) , count(DISTINCT x), count_if(a = 1)"
    assert dialect.spark_text("max(d) >= today() - 3") == "max(d) >= current_date() - 3"


def test_registry(spark):
    registry.register("shout", lambda c, mark="!": F.concat(F.upper(c), F.lit(mark)))
    assert apply(spark, ["a"], lambda c: registry.transform("shout", c, mark="?")) == ["A?"]
    with pytest.raises(KeyError):
        registry.transform("nothing", "c")


def test_types():
    assert spark_type("Nullable(DateTime64(3))").simpleString() == "timestamp"
    assert spark_type("LowCardinality(Nullable(String))").simpleString() == "string"
    assert spark_type("Decimal(15, 2)").simpleString() == "decimal(15,2)"
    assert spark_type("Decimal64(4)").simpleString() == "decimal(18,4)"
    assert spark_type("Array(String)").simpleString() == "array<string>"
    assert spark_type("Map(String, Int64)").simpleString() == "map<string,bigint>"
    with pytest.raises(ValueError):
        spark_type("Blob")


def test_session_folder(spark):
    from lakepipe.session import materialize, shared_dir

    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or shared_dir(spark, "x").startswith(base)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    stored = materialize(spark.range(3))
    assert stored.count() == 3 and (base is None or base in stored.inputFiles()[0])


def test_loaded_transforms_do_not_replace_builtin_ones(spark):
    names = registry.load_transforms({"string": {"clean_string": {"sql": "'lost'"}, "plus_one": {"sql": "toInt64({col}) + 1"}}})
    assert names == ["plus_one"]
    assert apply(spark, ["1"], lambda c: registry.transform("plus_one", c)) == [2]
    assert apply(spark, [" a "], lambda c: registry.transform("clean_string", c)) == ["a"]
