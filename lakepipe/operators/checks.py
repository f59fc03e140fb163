"""Data-quality checks.

A suite is a list of checks.  All row-local checks of a table are evaluated by
one aggregation over one scan.  All checks on keys (uniqueness, totals per
group, references, coverage) share one aggregation by (check, key): each table
is read once for them, its rows turned into small counts, and no tables are
joined.  Checks in SQL text are separate branches.  The result is a DataFrame with one row per check:
``table, check, severity, ok, observed, details``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions.dialect import add_functions, spark_expr, spark_text
from lakepipe.operators.filters import present
from lakepipe.types import spark_type

SEVERITIES = ("info", "warning", "error", "critical")

# The address pattern of the business rules.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

RESULT = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("observed", T.DoubleType()),
        T.StructField("details", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Keys:
    """What a check looks at per key: rows of its table (``_n``), rows of another table (``_m``), a total (``_t``).

    ``observe`` is an aggregate over the keys, given which of them are the check's.
    """

    columns: tuple[str, ...]
    observe: Callable[[Column], Column]
    skip_null: bool = False
    value: str | None = None
    other: str | None = None
    other_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Check:
    """A named check on one table.

    Row-local checks set ``measure`` (DataFrame -> aggregate Column), checks on keys set ``keys``.  Others set
    ``branch`` (tables, DataFrame -> one-row DataFrame with an ``observed`` column).
    ``passes`` decides on the observed number; None means informational.
    """

    table: str
    name: str
    severity: str
    passes: Callable[[Column], Column] | None
    measure: Callable[[DataFrame], Column] | None = None
    branch: Callable[[dict, DataFrame], DataFrame] | None = None
    needs: tuple[str, ...] = ()
    label: str = "violations"
    keys: Keys | None = None


def _none(observed: Column) -> Column:
    return observed == 0


def bad_rows(table: str, name: str, condition, severity: str = "error") -> Check:
    """No row may satisfy ``condition`` (SQL text, or DataFrame -> Column)."""

    def measure(df: DataFrame) -> Column:
        return F.count_if(spark_expr(condition) if isinstance(condition, str) else condition(df))

    return Check(table, name, severity, _none, measure)


def row_count(table: str, minimum: int = 1, severity: str = "error", name: str | None = None) -> Check:
    return Check(
        table, name or "row_count", severity, lambda n: n >= minimum, lambda df: F.count(F.lit(1)), label="rows"
    )


def not_null(table: str, column: str, severity: str = "error", strict: bool = False) -> Check:
    """No NULLs; ``strict`` also rejects '' and 0."""
    bad = (lambda df: ~present(df, column)) if strict else (lambda df: F.col(column).isNull())
    return bad_rows(table, f"not_null:{column}", bad, severity)


def accepted_values(table: str, column: str, values: Sequence, severity: str = "error") -> Check:
    """Non-NULL values must come from the list."""
    return bad_rows(table, f"accepted_values:{column}", lambda df: ~F.col(column).isin(list(values)), severity)


def in_range(table: str, column: str, low=None, high=None, severity: str = "error") -> Check:
    def bad(df: DataFrame) -> Column:
        out = F.lit(False)
        if low is not None:
            out = out | (F.col(column) < F.lit(low))
        if high is not None:
            out = out | (F.col(column) > F.lit(high))
        return out

    return bad_rows(table, f"range:{column}", bad, severity)


def ordered(table: str, first: str, second: str, severity: str = "error") -> Check:
    """``first`` must not exceed ``second`` where both are known."""
    return bad_rows(table, f"ordered:{first}<={second}", lambda df: F.col(first) > F.col(second), severity)


def implies(table: str, name: str, when: str, then: str, severity: str = "error") -> Check:
    """Rows satisfying ``when`` must satisfy ``then``; an unknown ``then`` fails."""
    return bad_rows(table, name, f"({when}) AND NOT coalesce(({then}), false)", severity)


def not_blank(table: str, columns: Sequence[str], severity: str = "error") -> Check:
    """At least one of the columns holds text."""
    blank = lambda df: F.trim(F.concat_ws("", *columns)) == ""
    return bad_rows(table, "not_blank:" + "|".join(columns), blank, severity)


def not_future(table: str, column: str, as_of: str, severity: str = "error") -> Check:
    late = lambda df: F.col(column) > F.lit(as_of).cast("timestamp")
    return bad_rows(table, f"not_future:{column}", late, severity)


def not_older(table: str, column: str, as_of: str, days: int, severity: str = "warning") -> Check:
    old = lambda df: F.col(column) < F.date_sub(F.lit(as_of).cast("date"), days)
    return bad_rows(table, f"not_older:{column}", old, severity)


def matches(table: str, column: str, pattern: str, severity: str = "warning", name: str | None = None) -> Check:
    """Non-empty values must match the pattern."""

    def bad(df: DataFrame) -> Column:
        c = F.col(column).cast("string")
        return (c != "") & ~c.rlike(pattern)

    return bad_rows(table, name or f"matches:{column}", bad, severity)


def email_format(table: str, column: str, severity: str = "warning") -> Check:
    return matches(table, column, EMAIL, severity, f"email:{column}")


def text_length(table: str, column: str, low: int, high: int, severity: str = "warning") -> Check:

    def bad(df: DataFrame) -> Column:
        n = F.length(column)
        return (n > 0) & ((n < low) | (n > high))

    return bad_rows(table, f"length:{column}", bad, severity)


def reconciles(
    table: str, name: str, left: str, right: str, absolute: float = 0.01, relative: float = 0.0, severity="warning"
) -> Check:
    """``left`` and ``right`` agree within max(relative * |left|, absolute)."""

    def bad(df: DataFrame) -> Column:
        a, b = spark_expr(left), spark_expr(right)
        return F.abs(a - b) > F.greatest(relative * F.abs(a), F.lit(absolute))

    return bad_rows(table, name, bad, severity)


def complete(table: str, column: str, percent: float, severity: str = "warning") -> Check:
    """At least ``percent`` of the rows hold a value."""

    def measure(df: DataFrame) -> Column:
        c = F.col(column)
        full = c.isNotNull()
        if isinstance(df.schema[column].dataType, T.StringType):
            full = full & (c != "")
        return F.round(F.avg(F.when(full, 100.0).otherwise(0.0)), 4)

    return Check(table, f"complete:{column}", severity, lambda n: n >= percent, measure, label="percent")


def share_at_most(table: str, name: str, condition: str, percent: float, severity: str = "error") -> Check:
    """At most ``percent`` of the rows satisfy ``condition``."""

    def measure(df: DataFrame) -> Column:
        return F.round(F.avg(F.when(spark_expr(condition), 100.0).otherwise(0.0)), 4)

    return Check(table, name, severity, lambda n: n <= percent, measure, label="percent")


def fresh(table: str, column: str, as_of: str, days: int, severity: str = "warning") -> Check:
    """The newest value is at most ``days`` old; observed is its age in days."""
    age = lambda df: F.datediff(F.lit(as_of).cast("date"), F.to_date(F.max(column)))
    return Check(table, f"fresh:{column}", severity, lambda n: n <= days, age, label="days")


def lag_at_most(table: str, column: str, as_of: str, seconds: int, severity: str = "warning") -> Check:
    """The newest time lies at most ``seconds`` before ``as_of``; observed is the lag in seconds."""
    lag = lambda df: F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.max(column))
    return Check(table, f"lag:{column}", severity, lambda n: n <= seconds, lag, label="seconds")


def aggregate_holds(table: str, name: str, expression: str, severity: str = "error") -> Check:
    """An aggregate boolean holds, e.g. ``min(score) >= 3 AND max(score) <= 15``."""
    held = f"CASE WHEN {spark_text(expression)} THEN 1 ELSE 0 END"
    return Check(table, name, severity, lambda n: n == 1, lambda df: F.expr(held), label="holds")


def measured(table: str, name: str, expression: str) -> Check:
    """Informational number; never fails."""
    return Check(table, name, "info", None, lambda df: spark_expr(expression), label="value")


def unique(table: str, columns: Sequence[str], severity: str = "error", ignore_null: bool = False) -> Check:
    """Number of key groups with more than one row."""

    keys = Keys(tuple(columns), lambda own: F.count_if(own & (F.col("_n") > 1)), ignore_null)
    return Check(table, "unique:" + "+".join(columns), severity, _none, label="duplicate groups", keys=keys)


def group_total(
    table: str, name: str, keys: Sequence[str], column: str, target: float, tolerance: float, severity="error"
) -> Check:
    """Totals per group stay near a constant; observed is the number of groups that do not."""

    off = lambda own: F.count_if(own & (F.abs(F.col("_t") - F.lit(target)) > tolerance))
    return Check(table, name, severity, _none, label="groups off", keys=Keys(tuple(keys), off, value=column))


def references(
    table: str, on: Sequence, parent: str, nullable: bool = False, severity: str = "error", optional: bool = False
) -> Check:
    """Every row's key exists in the parent table.  ``optional`` skips the check when the parent is missing."""
    pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
    label = f"references:{'+'.join(c for c, _ in pairs)}->{parent}"

    orphaned = lambda own: F.coalesce(F.sum(F.when(own & (F.col("_m") == 0), F.col("_n"))), F.lit(0))
    keys = Keys(tuple(c for c, _ in pairs), orphaned, nullable, other=parent, other_columns=tuple(p for _, p in pairs))
    return Check(table, label, severity, _none, needs=(parent,) if optional else (), keys=keys)


def covered(table: str, on: Sequence[str], other: str, percent: float, severity: str = "warning") -> Check:
    """At least ``percent`` of the distinct keys occur in another table."""

    def share(own: Column) -> Column:
        held = own & (F.col("_n") > 0)
        return F.round(F.count_if(held & (F.col("_m") > 0)) * 100.0 / F.nullif(F.count_if(held), F.lit(0)), 4)

    keys = Keys(tuple(on), share, True, other=other, other_columns=tuple(on))
    return Check(table, f"covered:{'+'.join(on)}->{other}", severity, lambda n: n >= percent, label="percent", keys=keys)


def column_type(table: str, column: str, expected: str | None = None, severity: str = "error") -> Check:
    """The column exists (with the declared type, if given); observed is 1 or 0."""

    def branch(tables: dict, df: DataFrame) -> DataFrame:
        names = {f.name: f.dataType for f in df.schema.fields}
        good = column in names and (expected is None or names[column] == spark_type(expected))
        return df.sparkSession.range(1).select(F.lit(int(good)).alias("observed"))

    return Check(table, f"column:{column}", severity, lambda n: n == 1, branch=branch, label="present")


_SLOT = re.compile(r"\{\{\s*(\w+)\s*\}\}")


def fill_sql(sql: str, values: dict[str, str]) -> str:
    """Fill ``{{ ds }}``-style and ``{database}.{table}`` slots."""
    sql = sql.replace("{database}.{table}", "{{ target_table }}")
    return spark_text(_SLOT.sub(lambda m: str(values[m.group(1)]), sql))


_COMPARE = {
    "<=": lambda c, v: c <= v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    "==": lambda c, v: c == v,
}


_AFTER_TABLE = frozenset(
    "where group order having limit join left right inner outer full cross natural semi anti on using union except "
    "intersect minus window lateral qualify tablesample pivot unpivot sort cluster distribute".split()
)


def _named(found: re.Match, view: str, name: str) -> str:
    """The view in a table's place, under the table's own name unless the text gives another."""
    word = (found[3] or "").split()
    own = bool(word) and word[-1].lower() not in _AFTER_TABLE
    return f"{found[1]}{found[2]}{view}" + ("" if own else f" AS {name}")


def custom_sql(
    table: str,
    name: str,
    sql: str,
    severity: str = "error",
    source: str | None = None,
    ds: str | None = None,
    expect: dict | None = None,
    expect_empty: bool = False,
    at_least: dict | None = None,
    more_than: dict | None = None,
    threshold: float | None = None,
    comparison: str = "<=",
    expected: bool | None = None,
    needs: Sequence[str] = (),
) -> Check:
    """A SQL check over the suite's tables (named as in the suite).

    Passes when the query is empty (``expect_empty``), when every row holds the
    wanted values (``expect``, ``at_least``, ``more_than``: column -> number;
    observed counts the misses), when its single value compares with
    ``threshold``, or equals ``expected``.  Without any of these the first
    value must be 0 (or true).
    """
    wanted = [(c, v, lambda c, v: c == v) for c, v in (expect or {}).items()]
    wanted += [(c, v, _COMPARE[">="]) for c, v in (at_least or {}).items()]
    wanted += [(c, v, _COMPARE[">"]) for c, v in (more_than or {}).items()]

    def branch(tables: dict, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        text = fill_sql(sql, {"ds": ds or "", "target_table": table, "source_table": source or ""})
        for known, frame in tables.items():
            # only where a table can stand, so that a column may share its name
            place = re.compile(rf"\b(FROM|JOIN)(\s+){re.escape(known)}(?![\w.])(?=(\s+(?:AS\s+)?\w+)?)", re.I)
            if place.search(text):
                view = re.sub(r"\W", "_", known) + "_check"
                frame.createOrReplaceTempView(view)
                text = place.sub(lambda m: _named(m, view, known.rsplit(".", 1)[-1]), text)
        add_functions(spark, text)
        result = spark.sql(text)
        if expect_empty:
            return result.agg(F.count(F.lit(1)).alias("observed"))
        if wanted:
            misses = F.lit(0)
            for c, value, compare in wanted:
                held = F.coalesce(compare(F.col(c), F.lit(value)), F.lit(False))
                misses = misses + F.when(held, 0).otherwise(1)
            return result.agg(F.coalesce(F.sum(misses), F.lit(len(wanted))).alias("observed"))
        result = result.toDF(*[f"c{i}" for i in range(len(result.columns))])
        first = F.col("c0")
        if isinstance(result.schema[0].dataType, T.BooleanType):
            held = F.coalesce(first == F.lit(expected is not False), F.lit(False))
            return result.agg(F.count_if(~held).alias("observed"))
        return result.agg(F.max(first.cast("double")).alias("observed"))

    passes = _none
    if threshold is not None:
        passes = lambda n: _COMPARE[comparison](n, threshold)
    return Check(table, name, severity, passes, branch=branch, needs=tuple(needs), label="observed")


def unreadable(table: str, name: str, severity: str = "error") -> Check:
    """Stands for a declaration that states no rule; always fails, so it shows up in the report."""
    nothing = lambda tables, df: df.sparkSession.range(1).select(F.lit(None).alias("observed"))
    return Check(table, name, severity, _none, branch=nothing, label="no rule declared")


def suite_from_dict(declared: dict, table: str, source: str | None = None, ds: str | None = None) -> list[Check]:
    """Checks from the ``tests`` list of a declaration file."""
    out: list[Check] = []
    for i, t in enumerate((declared or {}).get("tests") or []):
        kind, severity = t.get("type", "custom"), t.get("severity", "error")
        name = t.get("name", f"{kind}_{i}")
        columns = t.get("columns") or ([t["column"]] if "column" in t else [])
        if kind == "row_count":
            out.append(row_count(table, t.get("min", 1), severity))
        elif kind == "not_null" and "query" not in t:
            out += [not_null(table, c, severity) for c in columns]
        elif kind in ("unique", "uniqueness") and columns:
            out.append(unique(table, columns, severity))
        elif kind == "accepted_values" and "values" in t:
            out.append(accepted_values(table, t["column"], t["values"], severity))
        elif kind == "completeness":
            out.append(complete(table, t["column"], t["min_completeness_pct"], severity))
        elif kind == "schema" and "expected_type" in t:
            out.append(column_type(table, t["column"], t["expected_type"], severity))
        elif "query" in t:
            out.append(
                custom_sql(
                    table,
                    name,
                    t["query"],
                    severity,
                    source=source,
                    ds=ds,
                    expect=t.get("expect"),
                    expect_empty=t.get("expect_empty", False),
                    at_least=t.get("expect_greater_than_or_equal"),
                    more_than=t.get("expect_greater_than"),
                    threshold=t.get("threshold"),
                    comparison=t.get("comparison", "<="),
                    expected=t.get("expected"),
                    needs=[t["skip_if_missing_table"]] if "skip_if_missing_table" in t else [],
                )
            )
        else:
            out.append(unreadable(table, name, severity))
    return out


def _verdict(check: Check, observed: Column) -> Column:
    ok = F.lit(True) if check.passes is None else F.coalesce(check.passes(observed), F.lit(False))
    return F.struct(
        F.lit(check.table).alias("table"),
        F.lit(check.name).alias("check"),
        F.lit(check.severity).alias("severity"),
        ok.alias("ok"),
        observed.alias("observed"),
        F.concat(F.lit(check.label + "="), F.coalesce(F.format_string("%.4f", observed), F.lit("none"))).alias(
            "details"
        ),
    )


def _shared_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which keys of two columns are compared."""
    if a == b:
        return a
    kinds = (a, b)
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    if any(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    if any(isinstance(k, (T.DateType, T.TimestampType, T.TimestampNTZType)) for k in kinds):
        return T.TimestampType()
    return T.StringType()


def _entry(df: DataFrame, i: int, columns: Sequence[str], kinds: Sequence[T.DataType], skip_null: bool, own: bool, value: str | None):
    """A row's part in check ``i``: its key as two 64-bit hashes, and what it adds; NULL where it has none."""
    cols = [F.col(f"`{c}`").cast(k) for c, k in zip(columns, kinds)]
    cols = [c + F.lit(0.0) if isinstance(k, (T.DoubleType, T.FloatType)) else c for c, k in zip(cols, kinds)]  # -0.0 is 0.0
    parts = [x for c in cols for x in (c.isNull(), c)]
    total = F.col(f"`{value}`").cast("double") if value else F.lit(None).cast("double")
    made = F.struct(
        F.lit(i).alias("_i"), F.xxhash64(F.lit(1), *parts).alias("_h"), F.xxhash64(F.lit(2), *parts).alias("_g"),
        F.lit(int(own)).alias("_n"), F.lit(int(not own)).alias("_m"), total.alias("_t"),
    )
    if not skip_null:
        return made
    return F.when(~functools.reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns]), made)


def _key_row(tables: dict[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """One row, a column k<i> with what each check on keys observes; a table is read once, for all of them."""
    entries: dict[str, list[Column]] = {}
    for i, c in enumerate(suite):
        k, df = c.keys, tables[c.table]
        kinds = [df.schema[x].dataType for x in k.columns]
        if k.other:
            far = tables[k.other]
            kinds = [_shared_type(a, far.schema[x].dataType) for a, x in zip(kinds, k.other_columns)]
            entries.setdefault(k.other, []).append(_entry(far, i, k.other_columns, kinds, True, False, None))
        entries.setdefault(c.table, []).append(_entry(df, i, k.columns, kinds, k.skip_null, True, k.value))
    rows = None
    for table, made in entries.items():
        some = F.filter(F.array(*made), lambda x: x.isNotNull())
        part = tables[table].select(F.inline(some))
        rows = part if rows is None else rows.unionByName(part)
    sums = [F.sum(x).alias(x) for x in ("_n", "_m", "_t")]
    per_key = rows.groupBy("_i", "_h", "_g").agg(*sums)
    return per_key.agg(*[c.keys.observe(F.col("_i") == i).cast("double").alias(f"k{i}") for i, c in enumerate(suite)])


def run_checks(tables: dict[str, DataFrame], suite: Sequence[Check]) -> DataFrame:
    """Evaluate a suite; checks whose optional tables are missing are left out."""
    suite = [c for c in suite if c.table in tables and all(n in tables for n in c.needs)]
    parts = []
    for table in dict.fromkeys(c.table for c in suite):
        local = [c for c in suite if c.table == table and c.measure]
        if local:
            df = tables[table]
            row = df.agg(*[c.measure(df).cast("double").alias(f"m{i}") for i, c in enumerate(local)])
            verdicts = F.array(*[_verdict(c, F.col(f"m{i}")) for i, c in enumerate(local)])
            parts.append(row.select(F.inline(verdicts)))
    keyed = [c for c in suite if c.keys]
    if keyed:
        verdicts = F.array(*[_verdict(c, F.col(f"k{i}")) for i, c in enumerate(keyed)])
        parts.append(_key_row(tables, keyed).select(F.inline(verdicts)))
    for c in suite:
        if c.branch:
            row = c.branch(tables, tables[c.table]).select(F.col("observed").cast("double").alias("m"))
            parts.append(row.select(F.inline(F.array(_verdict(c, F.col("m"))))))
    if not parts:
        raise ValueError("no check applies to the given tables")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ChecksFailed(RuntimeError):
    """An error-level check did not hold."""


def raise_on_failure(results: DataFrame) -> DataFrame:
    """Raise when an error or critical check failed; warnings pass.  Reads one row per failed check."""
    failed = results.filter(~F.col("ok") & F.col("severity").isin("error", "critical")).collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.table}.{r.check} ({r.details})" for r in failed))
    return results


def gate(spark: SparkSession, table: str, partition: str, ds: str, as_of: str, max_age_hours: int = 2) -> DataFrame:
    """Pre-run checks of a raw table: it exists, has rows for the date, is fresh (warning)."""
    if not spark.catalog.tableExists(table):
        rows = [(table, "table_exists", "error", False, 0.0, "exists=0")]
        return spark.createDataFrame(rows, RESULT)
    df = spark.table(table)
    today = df.filter(F.col(partition) == F.lit(ds).cast(df.schema[partition].dataType))
    has_rows = today.limit(1).agg(F.count(F.lit(1)).alias("m"))
    suite = [
        Check(table, "table_exists", "error", lambda n: n == 1, label="exists"),
        Check(table, "has_data", "error", lambda n: n >= 1, label="has rows"),
        Check(table, "freshness", "warning", lambda n: n <= max_age_hours, label="hours"),
    ]
    newest = df.agg(F.max(F.col(partition).cast("timestamp")).alias("t"))
    now = F.lit(as_of).cast("timestamp")
    age = newest.select(((F.unix_timestamp(now) - F.unix_timestamp("t")) / 3600.0).alias("m"))
    frames = [spark.range(1).select(F.lit(1.0).alias("m")), has_rows, age]
    out = None
    for check, frame in zip(suite, frames):
        part = frame.select(F.col("m").cast("double").alias("m")).select(F.inline(F.array(_verdict(check, F.col("m")))))
        out = part if out is None else out.unionByName(part)
    return out
