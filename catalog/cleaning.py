"""Column cleaning, filters and clean tables."""

from pyspark.sql import functions as F

from catalog.common import day, load, query, ts
from lakepipe.functions import case, jsons, numeric, registry, text, times
from lakepipe.functions.dialect import spark_expr
from lakepipe.operators import clean, filters
from lakepipe.operators.dedupe import keep_latest

# text of each customer's state, cycling through the awkward cases
_STATES = ["Active", "Inactive", "CLOSED account", " waiting ", "Removed", "", "Unqualified", None]


def _words(key: str, words):
    return case([(F.col(key) % len(words) == i, F.lit(w)) for i, w in enumerate(words)], None).cast("string")


def _words_sql(key: str, words) -> str:
    lit = lambda w: "NULL" if w is None else f"'{w}'"
    arms = " ".join(f"WHEN {key} % {len(words)} = {i} THEN {lit(w)}" for i, w in enumerate(words[:-1]))
    return f"CAST(CASE {arms} ELSE {lit(words[-1])} END AS VARCHAR)"


@query(
    "clean_strings",
    """SELECT c_custkey, c_name AS name, lower(c_name) || '@example.com' AS email,
       regexp_replace(c_name, '[^0-9]', '', 'g') AS phone, upper(c_mktsegment) AS segment,
       CASE WHEN c_custkey % 3 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
       CASE WHEN c_nationkey = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_id,
       CASE WHEN c_custkey % 4 = 0 THEN 'Unknown' WHEN c_custkey % 4 = 1 THEN c_mktsegment
            WHEN c_custkey % 4 = 2 THEN c_name ELSE c_name || ' ' || c_mktsegment END AS full_name
       FROM customer""",
)
def clean_strings(spark, sf):
    df = load(spark, sf, "customer").withColumns(
        {
            "raw_name": F.concat(F.lit("  "), "c_name", F.lit(" ")),
            "raw_email": F.concat(F.lit(" "), F.upper("c_name"), F.lit("@Example.COM ")),
            "raw_currency": F.when(F.col("c_custkey") % 3 != 0, F.lit(" EUR")),
            "first": F.when(F.col("c_custkey") % 4 >= 2, F.col("c_name")),
            "last": F.when(F.col("c_custkey") % 4 % 2 == 1, F.col("c_mktsegment")),
        }
    )
    return df.select(
        "c_custkey",
        text.clean_string("raw_name").alias("name"),
        text.clean_email("raw_email").alias("email"),
        text.clean_phone("c_name").alias("phone"),
        text.clean_upper("c_mktsegment").alias("segment"),
        text.clean_string("raw_currency", "USD").alias("currency"),
        text.id_or_blank("c_nationkey").alias("nation_id"),
        text.full_name("first", "last").alias("full_name"),
    )


@query(
    "email_domains",
    """SELECT c_custkey,
       CASE c_custkey % 3 WHEN 0 THEN '' ELSE 'a.org' END AS second_part,
       CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'a.org' ELSE 'a.org@b.net' END AS after_at,
       CASE c_custkey % 3 WHEN 0 THEN lower(c_name) WHEN 1 THEN 'a.org' ELSE 'b.net' END AS last_part
       FROM customer""",
)
def email_domains(spark, sf):
    tail = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "@a.org").otherwise("@a.org@b.net")
    df = load(spark, sf, "customer").withColumn("email", F.concat("c_name", tail))
    return df.select(
        "c_custkey",
        text.extract_email_domain("email").alias("second_part"),
        text.email_domain_after_at("email").alias("after_at"),
        text.email_last_part("email").alias("last_part"),
    )


_STATE_SQL = _words_sql("c_custkey", _STATES)


@query(
    "normalize_status",
    f"""WITH w AS (SELECT c_custkey, {_STATE_SQL} AS s FROM customer)
    SELECT c_custkey,
      CASE WHEN s ILIKE '%active%' THEN 'active'
           WHEN s ILIKE '%closed%' OR s ILIKE '%inactive%' OR s ILIKE '%disabled%' THEN 'closed'
           WHEN s ILIKE '%pending%' OR s ILIKE '%waiting%' THEN 'pending'
           WHEN s ILIKE '%deleted%' OR s ILIKE '%removed%' THEN 'deleted'
           WHEN s != '' THEN lower(trim(s)) ELSE 'unknown' END AS status,
      CASE WHEN regexp_matches(s, '(?i)\\bactive\\b') THEN 'active'
           WHEN regexp_matches(s, '(?i)\\b(inactive|closed)\\b') THEN 'closed' ELSE 'other' END AS whole_word,
      CASE WHEN s ILIKE '%qualified%' THEN 'qualified' WHEN s ILIKE '%unqualified%' THEN 'unqualified'
           WHEN s != '' THEN lower(trim(s)) ELSE 'new' END AS lead_status
    FROM w""",
)
def normalize_status(spark, sf):
    df = load(spark, sf, "customer").withColumn("s", _words("c_custkey", _STATES))
    return df.select(
        "c_custkey",
        text.normalize_status("s").alias("status"),
        text.normalize("s", [("active", "active"), (("inactive", "closed"), "closed")], "other", False, True).alias(
            "whole_word"
        ),
        text.normalize("s", [("qualified", "qualified"), ("unqualified", "unqualified")], "new").alias("lead_status"),
    )


_FLAGS = ["true", "Yes", "1", "no", "False", "maybe", None]


@query(
    "normalize_flags",
    f"""WITH w AS (SELECT c_custkey, c_nationkey, {_words_sql('c_custkey', _FLAGS)} AS f FROM customer)
    SELECT c_custkey, CASE WHEN f IN ('true','Yes','1') THEN 1 ELSE 0 END AS as_flag,
      CASE WHEN lower(f) IN ('true','yes','1') THEN 'true' WHEN lower(f) IN ('no','false') THEN 'false'
           ELSE coalesce(f, 'null') END AS as_boolean,
      CASE WHEN lower(f) IN ('true','yes','1') THEN 1 ELSE 0 END AS as_bit,
      CASE WHEN c_nationkey % 3 = 1 THEN 'active' WHEN c_nationkey % 3 = 0 THEN 'inactive' ELSE 'unknown' END AS label,
      CASE WHEN lower(f) IN ('true','yes','1') THEN true ELSE false END AS filled
    FROM w""",
    integers=("as_flag", "as_bit"),
)
def normalize_flags(spark, sf):
    df = load(spark, sf, "customer").withColumn("is_member", _words("c_custkey", _FLAGS))
    flags = clean.booleanize(df.select("c_custkey", "is_member")).withColumnRenamed("is_member", "b")
    both = df.join(flags, "c_custkey")
    return both.select(
        "c_custkey",
        numeric.normalize_boolean("is_member").alias("as_flag"),
        F.coalesce("b", F.lit("null")).alias("as_boolean"),
        numeric.flag_to_int(numeric.parse_bool("b")).alias("as_bit"),
        text.flag_label(F.col("c_nationkey") % 3, {1: "active", 0: "inactive"}).alias("label"),
        numeric.default_null(numeric.parse_bool("b"), False).alias("filled"),
    )


@query(
    "clean_numbers",
    """SELECT c_custkey,
      CAST(CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(15,2)) END AS DOUBLE) AS strict_money,
      CAST(CAST((c_custkey % 1000) / 10 AS DECIMAL(5,2)) AS DOUBLE) AS strict_percent,
      CAST(CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DOUBLE) AS lenient_money,
      CAST(CASE WHEN c_custkey % 11 = 0 THEN 1 WHEN c_custkey % 7 = 0 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(18,4)) END AS DOUBLE) AS factor,
      CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey END AS whole_or_zero,
      CASE WHEN c_custkey % 7 = 0 THEN 0.0 ELSE c_custkey / 4 END AS float_or_zero,
      CASE WHEN c_custkey % 7 = 0 THEN 'none' ELSE CAST(c_custkey AS VARCHAR) END AS safe_whole
    FROM customer""",
)
def clean_numbers(spark, sf):
    key = F.col("c_custkey")
    amount = F.when(key % 11 != 0, F.concat(F.lit("$"), F.format_number("c_acctbal", 2)))
    df = load(spark, sf, "customer").withColumns(
        {
            "amount": amount,
            "percent": F.concat(F.format_number((key % 1000) / 10, 2), F.lit("%")),
            "dirty": F.when(key % 7 == 0, F.when(key % 11 != 0, F.lit("junk"))).otherwise(amount),
            "plain": F.when(key % 7 == 0, F.when(key % 11 != 0, F.lit("junk"))).otherwise(
                F.when(key % 11 != 0, F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
            ),
            "whole": F.when(key % 7 == 0, "x1").otherwise(key.cast("string")),
            "half": F.when(key % 7 == 0, "1.2.3").otherwise((key / 4).cast("string")),
        }
    )
    return df.select(
        "c_custkey",
        numeric.parse_money("amount").alias("strict_money"),
        numeric.parse_percentage("percent").alias("strict_percent"),
        numeric.money_or_zero("dirty").alias("lenient_money"),
        numeric.decimal_or("plain", 4, 0, when_null=1).alias("factor"),
        numeric.int_or_zero("whole").alias("whole_or_zero"),
        numeric.float_or_zero("half").alias("float_or_zero"),
        F.coalesce(numeric.widen(numeric.safe_int("whole"), "string"), F.lit("none")).alias("safe_whole"),
    )


@query(
    "parse_times",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 6 THEN 'none' ELSE {ts('o_orderdate')} END AS parsed,
      CASE WHEN o_orderkey % 11 = 6 THEN 'none' ELSE {ts('o_orderdate')} END AS declared,
      CASE WHEN o_orderkey % 11 = 6 THEN 'none' ELSE {day('o_orderdate')} END AS parsed_day,
      {day('o_orderdate')} AS integer_date, {day("date_trunc('week', o_orderdate)")} AS week_start
    FROM orders""",
)
def parse_times(spark, sf):
    d, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 11
    shape = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k == 2, F.date_format(d, "yyyyMMdd"))
        .when(k == 3, F.date_format(d, "dd/MM/yyyy HH:mm:ss"))
        .when(k == 4, F.unix_seconds(d).cast("string"))
        .when(k == 5, F.date_format(d, "yyyyMMddHHmmss"))
        .when(k == 7, F.date_format(d, "yyyy/MM/dd HH:mm:ss"))
        .when(k == 8, F.date_format(d, "dd MMM yyyy HH:mm:ss"))
        .when(k == 9, F.date_format(d, "MMM d yyyy"))
        .when(k == 10, F.date_format(d, "yyyy-MM-dd hh:mm:ss a"))
        .otherwise("2024-13-45")
    )
    df = load(spark, sf, "orders").withColumn("t", F.concat(shape, F.lit(" ")))
    none = lambda c: F.coalesce(c, F.lit("none"))
    return df.select(
        "o_orderkey",
        none(F.date_format(times.parse_timestamp("t"), "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        none(F.date_format(spark_expr("parseDateTime64BestEffortOrNull(t)"), "yyyy-MM-dd HH:mm:ss")).alias("declared"),
        none(times.timestamp_date("t").cast("string")).alias("parsed_day"),
        times.parse_date(F.date_format(d, "yyyyMMdd").cast("int")).alias("integer_date"),
        times.monday("o_orderdate").alias("week_start"),
    )


@query(
    "time_differences",
    """WITH e AS (SELECT *, ts + to_seconds(event_id % 200000) AS ended FROM events)
    SELECT event_id, date_diff('day', ts, ended) AS days, date_diff('minute', ts, ended) AS minutes,
      date_diff('second', ts, ended) AS seconds FROM e""",
)
def time_differences(spark, sf):
    df = load(spark, sf, "events").withColumn(
        "ended", F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 200000).cast("decimal(18,6)"))
    )
    return df.select(
        "event_id",
        times.day_diff("ts", "ended").alias("days"),
        times.minute_diff("ts", "ended").alias("minutes"),
        times.second_diff("ts", "ended").alias("seconds"),
    )


@query(
    "epoch_times",
    f"""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '1970-01-01 00:00:00' ELSE {ts('ts')} END AS from_ms,
      CASE WHEN event_id % 5 = 0 THEN '1970-01-01 00:00:00' ELSE {ts('ts')} END AS from_s FROM events""",
)
def epoch_times(spark, sf):
    at, bad = F.col("ts").cast("timestamp"), F.col("event_id") % 5 == 0
    df = load(spark, sf, "events").withColumns(
        {
            "ms": F.when(bad, "soon").otherwise(F.unix_millis(at).cast("string")),
            "s": F.when(~bad, F.unix_seconds(at).cast("string")),
        }
    )
    return df.select("event_id", times.from_epoch_ms("ms").alias("from_ms"), times.from_epoch_s("s").alias("from_s"))


_ZONES = ["America/New_York", "Asia/Kolkata", "Europe/Berlin", "Nowhere/Land", None]


@query(
    "utc_normalize",
    f"""SELECT o_orderkey, CASE o_orderkey % 5
      WHEN 0 THEN {ts("(o_orderdate AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC'")}
      WHEN 1 THEN {ts("o_orderdate - INTERVAL '5 hours 30 minutes'")}
      WHEN 2 THEN {ts("(o_orderdate AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC'")}
      ELSE {ts('o_orderdate')} END AS utc,
      {ts("o_orderdate - INTERVAL '2 hours'")} AS offset_utc
    FROM orders""",
)
def utc_normalize(spark, sf):
    local = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    df = load(spark, sf, "orders").withColumns({"local": local, "zone": _words("o_orderkey", _ZONES)})
    return df.select(
        "o_orderkey",
        times.to_utc("local", "zone").alias("utc"),
        times.to_utc(F.concat("local", F.lit("+02:00")), "zone").alias("offset_utc"),
    )


@query(
    "json_extract",
    """SELECT event_id,
      CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS k_text,
      CASE WHEN event_id % 10 = 0 THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
      CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS valid,
      CASE WHEN event_id % 10 = 0 THEN '' ELSE event_type END AS nested,
      CASE WHEN event_id % 10 = 0 THEN 0 ELSE 2 END AS elements,
      CASE WHEN event_id % 10 = 0 THEN 0 WHEN event_type = 'click' THEN 2 ELSE 1 END AS required
    FROM events""",
    integers=("valid", "elements", "required"),
)
def json_extract(spark, sf):
    bad = F.col("event_id") % 10 == 0
    whole = F.concat(F.lit('{"a":{"b":"'), "event_type", F.lit('"}}'))
    items = F.concat(F.lit('[{"type":"Required"},{"type":"'), F.when(F.col("event_type") == "click", "required").otherwise("optional"), F.lit('"}]'))
    df = load(spark, sf, "events").withColumns(
        {
            "p": F.when(bad, "{broken").otherwise(F.col("props")),
            "nest": F.when(~bad, whole),
            "items": F.when(bad, "[]").otherwise(items),
        }
    )
    required = lambda x: F.lower(F.get_json_object(x, "$.type")) == "required"
    return df.select(
        "event_id",
        jsons.json_string("p", "k").alias("k_text"),
        jsons.json_int("p", "k").alias("k"),
        jsons.is_valid_json("p").alias("valid"),
        jsons.json_string("nest", "a", "b").alias("nested"),
        jsons.json_array_size("items").alias("elements"),
        jsons.json_array_count("items", required).alias("required"),
    )


@query(
    "explode_json_array",
    f"""WITH a AS (
      SELECT event_id % 500 AS meeting_id, ts, lower(event_type) || user_id || '@host' || (user_id % 3) || '.org' AS email,
             'accepted' AS response FROM events WHERE event_id % 10 != 0
      UNION ALL
      SELECT event_id % 500, ts, 'owner' || (event_id % 7) || '@host.org', 'none' FROM events WHERE event_id % 10 != 0)
    SELECT meeting_id, email, regexp_extract(email, '@(.*)$', 1) AS domain, response, {day('max(ts)')} AS processing_date
    FROM a GROUP BY meeting_id, email, response""",
)
def explode_json_array(spark, sf):
    person = lambda address, response: F.concat(
        F.lit('{"emailAddress":{"address":"'), address, F.lit(f'"}},"status":{{"response":"{response}"}}}}')
    )
    user = F.concat(F.lit(" "), F.upper("event_type"), "user_id", F.lit("@Host"), F.col("user_id") % 3, F.lit(".org"))
    owner = F.concat(F.lit("owner"), F.col("event_id") % 7, F.lit("@host.org"))
    attendees = F.concat(
        F.lit("["), person(user, "Accepted"), F.lit(","), person(owner, "none"), F.lit(","), person(F.lit(""), "x"), F.lit("]")
    )
    df = load(spark, sf, "events").select(
        (F.col("event_id") % 500).alias("meeting_id"),
        F.to_date("ts").alias("processing_date"),
        F.when(F.col("event_id") % 10 == 0, "[]").otherwise(attendees).alias("attendees_json"),
    )
    shape = "emailAddress struct<address: string>, status struct<response: string>"
    has_address = lambda x: x["emailAddress"]["address"] != ""
    rows = jsons.explode_json(df, "attendees_json", "a", has_address, shape).select(
        "meeting_id",
        text.clean_email("a.emailAddress.address").alias("email"),
        text.clean_email("a.status.response").alias("response"),
        "processing_date",
    )
    kept = keep_latest(rows, ["meeting_id", "email"], ["processing_date DESC"])
    return kept.withColumn("domain", text.email_last_part("email"))


@query(
    "list_columns",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 2 THEN '[]' WHEN doc_id % 4 = 3 THEN '["it''s","' || lang || '"]'
      ELSE '["' || lang || '","' || source || '"]' END AS tags
    FROM documents""",
)
def list_columns(spark, sf):
    k = F.col("doc_id") % 4
    raw = (
        F.when(k == 0, F.concat(F.lit("['"), "lang", F.lit("', '"), "source", F.lit("']")))
        .when(k == 1, F.concat(F.lit(" "), "lang", F.lit(" , "), "source"))
        .when(k == 3, F.concat(F.lit("[\"it's\", \""), "lang", F.lit('"]')))
    )
    df = load(spark, sf, "documents").withColumn("raw", raw)
    return df.select("doc_id", jsons.parse_list("raw").alias("tags"))


@query(
    "coerce_types",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN -1 ELSE o_custkey END AS customer,
      CASE WHEN o_orderkey % 8 = 0 THEN 0.0 ELSE o_totalprice END AS price,
      CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' ELSE 'null' END AS is_final,
      {day('o_orderdate')} AS ordered_on, {ts('o_orderdate')} AS ordered_at
    FROM orders""",
)
def coerce_types(spark, sf):
    df = load(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(F.col("o_orderkey") % 8 == 0, "").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderstatus") == "F", " Yes").when(F.col("o_orderstatus") == "O", "N").otherwise("?").alias("is_final"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered_on"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ordered_at"),
    )
    contract = {"customer": "int", "price": "float", "is_final": "bool", "ordered_on": "date", "ordered_at": "datetime"}
    typed = clean.fill_nulls(clean.coerce(df, contract), {"customer": -1, "price": 0.0})
    return typed.withColumn("is_final", F.coalesce(F.col("is_final").cast("string"), F.lit("null")))


@query(
    "trim_text_columns",
    """SELECT doc_id, lang, source, CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'x' END AS note FROM documents""",
)
def trim_text_columns(spark, sf):
    df = load(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit(" "), "lang", F.lit("  ")).alias("lang"),
        F.concat("source", F.lit(" ")).alias("src"),
        F.when(F.col("doc_id") % 2 == 0, "   ").otherwise(" x").alias("note"),
        F.lit("t").alias("scratch"),
    )
    trimmed = clean.trim_strings(df)
    return clean.blank_nulls(clean.rename_drop(trimmed, {"src": "source"}, ["scratch"]))


@query(
    "interchange_values",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''
        ELSE '.' || printf('%06d', CAST(epoch_us(ts) % 1000000 AS INTEGER)) END AS ts,
      printf('%.2f', value) AS value, base64(encode(event_type)) AS kind, '["' || event_type || '"]' AS tags
    FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE ts END AS ts) FROM events) AS e""",
)
def interchange_values(spark, sf):
    df = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts")).alias("ts"),
        F.col("value").cast("decimal(12,2)").alias("value"),
        F.encode("event_type", "UTF-8").alias("kind"),
        F.array("event_type").alias("tags"),
    )
    return jsons.interchange(df)


@query(
    "named_transforms",
    """SELECT c_custkey, upper(c_name) AS name, left(c_mktsegment, 3) AS code,
       CASE WHEN c_mktsegment LIKE 'B%' THEN 'b' WHEN c_mktsegment != '' THEN lower(c_mktsegment) ELSE 'none' END AS grp
    FROM customer""",
)
def named_transforms(spark, sf):
    registry.load_transforms(
        {
            "string": {"first_chars": {"sql": "substring({col}, 1, {n})"}},
            "status": {
                "segment_group": {
                    "type": "multiIf",
                    "mappings": [
                        {"match": "{col} LIKE 'B%'", "value": "b"},
                        {"match": "{col} != ''", "value": "lower(trimBoth({col}))", "is_expression": True},
                    ],
                    "default": "none",
                }
            },
        }
    )
    df = load(spark, sf, "customer")
    return df.select(
        "c_custkey",
        registry.transform("clean_upper", "c_name").alias("name"),
        registry.transform("first_chars", "c_mktsegment", n=3).alias("code"),
        registry.transform("segment_group", "c_mktsegment").alias("grp"),
    )


# a declaration as it would stand in a table's file
ORDER_DECLARATION = {
    "source": {"database": "shop", "table": "orders_raw"},
    "target": {"database": "shop_clean", "table": "orders"},
    "transforms": {
        "o_orderstatus": {"target": "status", "transform": "normalize", "params": {"rules": [["f", "final"], ["o", "open"]]}},
        "price_text": {"target": "price", "transform": "parse_money"},
        "edited": {"transform": "parse_date"},
        "absent_column": {"transform": "clean_string"},
    },
    "exclude": ["o_custkey"],
    "dedupe": {"partition_by": ["o_orderkey", "processing_date"], "order_by": ["edited DESC"]},
    "filters": ["o_orderkey IS NOT NULL", "o_orderkey != 0"],
    "lookback_days": 365,
}


@query(
    "build_clean_table",
    f"""WITH raw AS (
      SELECT *, CAST(o_orderdate AS DATE) AS processing_date, v FROM orders, (VALUES (0), (1)) t(v)
      WHERE o_orderkey != 0 AND o_orderdate >= TIMESTAMP '1997-07-02' AND o_orderdate < TIMESTAMP '1998-07-03')
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE lower(o_orderstatus) END AS status,
      o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) + 1 AS price,
      {ts("o_orderdate + INTERVAL '1 hour'")} AS edited, {day('processing_date')} AS processing_date,
      'shop.orders_raw' AS _source_table, {ts('processing_date')} AS _source_timestamp,
      '2024-01-01 00:00:00' AS _loaded_at
    FROM raw WHERE v = 1""",
)
def build_clean_table(spark, sf):
    orders = load(spark, sf, "orders")
    # two versions of every order; the second is newer although its text sorts lower
    versions = orders.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    at = F.col("o_orderdate").cast("timestamp")
    raw = versions.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.concat(F.lit(" "), "o_orderpriority").alias("o_orderpriority"),
        F.concat(F.lit("$"), F.format_number(F.col("o_totalprice") + F.col("v"), 2)).alias("price_text"),
        F.when(F.col("v") == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.unix_seconds(at + F.expr("INTERVAL 1 HOUR")).cast("string"))
        .alias("edited"),
        F.to_date(at).alias("processing_date"),
    )
    spec = clean.TableSpec.from_dict(ORDER_DECLARATION)
    return clean.build_clean(raw, spec, ds="1998-07-02", as_of="2024-01-01")


def _calendar_spec():
    """A hand-written kind of table: JSON fields, defaults, counts and a duration next to plain columns."""
    at = lambda c: times.parse_timestamp(jsons.json_string(c, "dateTime"))
    counted = lambda kind: jsons.json_array_count(
        "attendees_json", lambda x: F.lower(F.get_json_object(x, "$.type")) == kind
    )
    return clean.TableSpec(
        source="office.event_raw",
        target="office_clean.event",
        keys=["event_id", "processing_date"],
        order=["start_datetime DESC", "version DESC"],
        filters=["event_id IS NOT NULL", "event_id != ''"],
        rules={c: clean.ColumnRule() for c in ("start_json", "end_json", "attendees_json")},
        derived={
            "start_datetime": lambda: at("start_json"),
            "duration_minutes": lambda: times.minute_diff(at("start_json"), at("end_json")),
            "organizer_email": lambda: text.clean_email(jsons.json_string("organizer_json", "emailAddress", "address")),
            "is_online": lambda: numeric.default_null("online", False),
            "required_count": lambda: counted("required"),
            "attendee_count": lambda: jsons.json_array_size("attendees_json"),
            "subject_length": "length(subject)",
        },
        exclude=["start_json", "end_json", "attendees_json", "organizer_json", "online", "version"],
    )


@query(
    "build_calendar_table",
    f"""SELECT 'e' || event_id AS event_id, {day('ts')} AS processing_date, event_type AS subject,
      {ts("ts + INTERVAL '1 day'")} AS start_datetime, event_id % 90 AS duration_minutes, 'u' || user_id || '@a.org' AS organizer_email,
      event_id % 4 = 1 AS is_online, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS required_count,
      CASE WHEN event_id % 3 = 0 THEN 0 ELSE 2 END AS attendee_count, length(event_type) AS subject_length,
      'office.event_raw' AS _source_table, {ts('CAST(ts AS DATE)')} AS _source_timestamp, '2024-06-01 00:00:00' AS _loaded_at
    FROM events""",
    integers=("required_count", "attendee_count"),
)
def build_calendar_table(spark, sf):
    # two versions of each event, the second a day later
    e = load(spark, sf, "events").withColumn("version", F.explode(F.array(F.lit(0), F.lit(1))))
    at, k = F.col("ts").cast("timestamp") + F.make_dt_interval(days=F.col("version")), F.col("event_id")
    clock = lambda t: F.concat(
        F.lit('{"dateTime":"'), F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('","timeZone":"UTC"}')
    )
    raw = e.select(
        F.concat(F.lit(" e"), k).alias("event_id"),
        F.to_date("ts").alias("processing_date"),
        F.concat("event_type", F.lit(" ")).alias("subject"),
        clock(at).alias("start_json"),
        clock(at + F.make_dt_interval(mins=(k % 90).cast("int"))).alias("end_json"),
        F.concat(F.lit('{"emailAddress":{"address":" U'), "user_id", F.lit('@A.org"}}')).alias("organizer_json"),
        F.when(k % 3 != 0, '[{"type":"Required"},{"type":"optional"}]').alias("attendees_json"),
        F.when(k % 4 == 1, True).when(k % 4 == 2, False).alias("online"),
        "version",
    )
    return clean.build_clean(raw, _calendar_spec(), as_of="2024-06-01")


@query("required_keys", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey != 0 AND c_custkey != 0 AND c_custkey % 13 NOT IN (0, 1)", integers=("c_nationkey",))
def required_keys(spark, sf):
    key = F.col("c_custkey")
    df = load(spark, sf, "customer").withColumn(
        "code", F.when(key % 13 == 0, "").when(key % 13 == 1, "NONE").otherwise("c")
    )
    kept = filters.exclude_sentinel(filters.require_keys(df, ["c_custkey", "c_nationkey", "code"]), "code")
    return kept.select("c_custkey", "c_nationkey")


@query("flag_conflicts", "SELECT c_custkey FROM customer WHERE NOT (c_custkey % 4 = 3)")
def flag_conflicts(spark, sf):
    key = F.col("c_custkey") % 4
    df = load(spark, sf, "customer").select(
        "c_custkey",
        F.when(key == 3, True).when(key == 2, False).alias("is_primary"),
        F.when(key != 0, True).alias("is_secondary"),
    )
    return filters.exclude_both(df, "is_primary", "is_secondary").select("c_custkey")


@query(
    "lookback_window",
    f"""SELECT event_id, {day('ts')} AS part FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-18'""",
)
def lookback_window(spark, sf):
    df = filters.lookback(load(spark, sf, "events"), "ts", "2024-01-17", 7)
    return df.select("event_id", F.to_date("ts").alias("part"))


@query(
    "open_rows",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey % 6 NOT IN (0, 1) AND o_custkey % 5 != 0 AND o_orderpriority NOT LIKE '5-%' AND o_totalprice > 1000""",
)
def open_rows(spark, sf):
    k = F.col("o_orderkey") % 6
    df = load(spark, sf, "orders").withColumns(
        {
            "job_status": F.when(k == 0, "Done").when(k == 1, " completed ").when(k == 2, "new"),
            "owner": F.when(F.col("o_custkey") % 5 == 0, " null ").otherwise("me"),
        }
    )
    for status in filters.status_columns(df.select("job_status")):
        df = filters.skip_done(df, status)
    df = df.withColumn("owner", F.trim("owner"))
    df = filters.drop_missing(df, ["owner"])
    df = filters.apply_rules(df, ["o_totalprice > 1000"])
    return filters.exclude_names(df, "o_orderpriority", ["^5-"]).select("o_orderkey", "o_custkey")


@query("tenant_list", "SELECT DISTINCT c_mktsegment AS tenant FROM customer WHERE c_mktsegment <> 'BUILDING'")
def tenant_list(spark, sf):
    df = load(spark, sf, "customer").withColumn(
        "tenant", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("")
    )
    return filters.tenants(df, "tenant")
