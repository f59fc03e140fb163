"""File and table contracts: columns, nullability, types, constraints, keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators import checks as q
from lakepipe.operators.clean import coerced
from lakepipe.types import spark_type


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: str = "string"
    nullable: bool = True
    primary_key: bool = False
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    max_length: int | None = None


@dataclass(frozen=True)
class Contract:
    """Expected columns of a table.

    ``columns_rule``: "set" (no missing, no extra), "order" (also in order) or
    "subset" (extra columns only warn).  ``severity`` is that of the data rules.
    """

    table: str
    columns: Sequence[ColumnContract]
    columns_rule: str = "set"
    severity: str = "error"
    ignore_case: bool = False

    @staticmethod
    def from_dict(d: dict, table: str, **options) -> "Contract":
        known = set(ColumnContract.__dataclass_fields__)
        cols = [ColumnContract(**{k: v for k, v in c.items() if k in known}) for c in d["columns"]]
        return Contract(table, cols, **options)


def match_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Rename columns that differ only in case or padding to their contract names."""
    if not contract.ignore_case:
        return df
    wanted = {c.name.strip().lower(): c.name for c in contract.columns}
    return df.toDF(*[wanted.get(n.strip().lower(), n) for n in df.columns])


def column_problems(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """(check, severity, details) for missing, extra and misplaced columns."""
    names, wanted = df.columns, [c.name for c in contract.columns]
    missing = [c for c in wanted if c not in names]
    extra = [c for c in names if c not in wanted]
    out = []
    if missing:
        out.append(("missing_columns", "error", ",".join(missing)))
    if extra:
        out.append(("extra_columns", "warning" if contract.columns_rule == "subset" else "error", ",".join(extra)))
    if contract.columns_rule == "order" and not missing and not extra and names != wanted:
        out.append(("column_order", "error", ",".join(names)))
    return out


def contract_checks(df: DataFrame, contract: Contract) -> list[q.Check]:
    """The contract's data rules as row-local checks (one pass) plus a key check."""
    t, level, out = contract.table, contract.severity, []
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        actual = df.schema[c.name].dataType
        col = F.col(c.name)
        if not c.nullable or c.primary_key:
            out.append(q.not_null(t, c.name, level))
        typed = coerced(c.name, c.type)
        if actual != spark_type(c.type) and not isinstance(spark_type(c.type), T.StringType):
            bad = col.isNotNull() & (F.trim(col.cast("string")) != "") & typed.isNull()
            out.append(q.bad_rows(t, f"type:{c.name}", lambda df, bad=bad: bad, level))
        if c.min_value is not None:
            out.append(q.bad_rows(t, f"min:{c.name}", lambda df, x=typed, v=c.min_value: x < v, level))
        if c.max_value is not None:
            out.append(q.bad_rows(t, f"max:{c.name}", lambda df, x=typed, v=c.max_value: x > v, level))
        if c.pattern is not None:
            out.append(q.bad_rows(t, f"pattern:{c.name}", lambda df, x=col, p=c.pattern: ~x.cast("string").rlike(p), level))
        if c.max_length is not None:
            too_long = lambda df, x=col, n=c.max_length: F.length(x.cast("string")) > n
            out.append(q.bad_rows(t, f"max_length:{c.name}", too_long, level))
    keys = [c.name for c in contract.columns if c.primary_key and c.name in df.columns]
    if keys:
        out.append(q.unique(t, keys, level, ignore_null=True))
    return out


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Check results of a contract: column problems first, then every data rule."""
    df = match_columns(df, contract)
    results = None
    suite = contract_checks(df, contract)
    if suite:
        results = q.run_checks({contract.table: df}, suite)
    problems = [(contract.table, n, s, False, None, d) for n, s, d in column_problems(df, contract)]
    if problems:
        frame = df.sparkSession.createDataFrame(problems, q.RESULT)
        results = frame if results is None else frame.unionByName(results)
    return results if results is not None else df.sparkSession.createDataFrame([], q.RESULT)


def validate_frame(df: DataFrame, required: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Raise on absent columns or non-numeric ones (schema only), return NULL checks on the required ones."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns missing: {absent}")
    wrong = [c for c in numeric if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"columns must be numeric: {wrong}")
    return q.run_checks({"output": df}, [q.not_null("output", c) for c in required])


def business_rules(table: str, df: DataFrame, as_of: str) -> list[q.Check]:
    """Warning-level rules for message tables, for whichever columns exist."""
    rules = {
        "thread_id": lambda: q.unique(table, ["thread_id"], "warning"),
        "sender": lambda: q.email_format(table, "sender"),
        "timestamp": lambda: q.not_future(table, "timestamp", as_of, "warning"),
        "customer_satisfaction": lambda: q.in_range(table, "customer_satisfaction", -1, 1, "warning"),
    }
    return [make() for c, make in rules.items() if c in df.columns]


def catalog_drift(recorded: DataFrame, live: DataFrame) -> DataFrame:
    """Columns recorded but gone, new, or at another position, from two column catalogs.

    Catalogs hold ``table_name, column_name, ordinal``; names compare without case.
    """
    key = lambda d, c: d.select(
        F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name"), F.col("ordinal").alias(c)
    )
    both = key(recorded, "recorded_at").join(key(live, "live_at"), ["table_name", "column_name"], "full")
    change = (
        F.when(F.col("live_at").isNull(), "removed")
        .when(F.col("recorded_at").isNull(), "added")
        .when(F.col("live_at") != F.col("recorded_at"), "moved")
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull())
