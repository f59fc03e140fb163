"""Clean tables from declarations, and whole-frame cleaning steps."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions import registry
from lakepipe.functions.dialect import spark_expr
from lakepipe.functions.numeric import parse_bool, to_number
from lakepipe.functions.jsons import parse_list
from lakepipe.functions.times import as_of as run_time
from lakepipe.functions.times import parse_date, parse_timestamp
from lakepipe.operators.dedupe import keep_latest
from lakepipe.operators.filters import lookback, on_date
from lakepipe.types import spark_type

# Columns no clean table keeps.
GLOBAL_EXCLUDE = ("_raw_json", "_temp_data", "_internal_id")

# Name parts that mark a flag column.
_FLAG_NAME = re.compile(r"(?:^|_)(is|has|flag|active|enabled|deleted)(?:_|$)", re.I)
_WORD = re.compile(r"[A-Za-z_]\w*")


@dataclass(frozen=True)
class ColumnRule:
    """How one raw column becomes a clean one."""

    transform: str = "pass"
    target: str | None = None
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class TableSpec:
    """A clean table: filters, dedupe, column rules, derived columns, exclusions.

    ``keys`` and ``order`` may be SQL expressions.  ``derived`` adds columns
    computed from the cleaned ones: SQL text, or a function returning a Column.
    With ``partition`` set and a run date given, only that date (or
    ``lookback_days`` up to it) is read.
    """

    source: str
    target: str
    keys: Sequence[str]
    order: Sequence[str]
    rules: dict[str, ColumnRule] = field(default_factory=dict)
    derived: dict[str, str | Callable[[], Column]] = field(default_factory=dict)
    exclude: Sequence[str] = ()
    filters: Sequence[str] = ()
    partition: str | None = "processing_date"
    lookback_days: int | None = None
    source_timestamp: str | None = None
    clean_strings: bool = True
    missing: str = "error"  # or "null": absent columns are added as NULL

    @staticmethod
    def from_dict(d: dict) -> "TableSpec":
        """From the mapping of a declaration file."""
        problems = [k for k in ("source", "target", "dedupe") if k not in d]
        if problems:
            raise ValueError(f"table declaration lacks {problems}")
        name = lambda part: ".".join(str(part[k]) for k in ("database", "table") if k in part)
        inc = {**d.get("incremental", {}), **d.get("task", {}).get("incremental", {})}
        days = d.get("lookback_days", inc.get("lookback_days"))
        return TableSpec(
            source=name(d["source"]),
            target=name(d["target"]),
            keys=list(d["dedupe"]["partition_by"]),
            order=list(d["dedupe"]["order_by"]),
            rules={
                c: ColumnRule(r.get("transform", "pass"), r.get("target"), dict(r.get("params", {})))
                for c, r in d.get("transforms", {}).items()
            },
            derived=dict(d.get("derived", {})),
            exclude=list(d.get("exclude", [])),
            filters=list(d.get("filters", [])),
            partition=inc.get("partition_column", "processing_date"),
            lookback_days=days if inc.get("use_date_filter", True) else None,
        )


def build_clean(raw: DataFrame, spec: TableSpec, ds: str | None = None, as_of=None) -> DataFrame:
    """Filter, keep the latest row per key, transform, drop and add system columns.

    Filters, keys and orderings see the cleaned value of a column they name, as
    a SELECT alias shadows the raw column in the warehouse; every other column
    is transformed after the dedupe, on the surviving rows only.  The date
    filter comes first: it prunes partitions, and it never removes a key whose
    newest row lies on another day.
    """
    df = raw
    if ds is not None and spec.partition and spec.partition in df.columns:
        if spec.lookback_days is None:
            df = on_date(df, spec.partition, ds)
        else:
            df = lookback(df, spec.partition, ds, spec.lookback_days)
    made = {r.target for r in spec.rules.values()} | set(spec.derived)
    df = add_missing(df, [k for k in spec.keys if k.isidentifier() and k not in made], spec.missing)
    cleaned = {f.name: _clean_column(f, spec) for f in df.schema.fields}
    named = set(_WORD.findall(" ".join([*spec.filters, *spec.keys, *spec.order])))
    derive_early = bool(named & set(spec.derived))
    early = {target: c for target, c in cleaned.values() if derive_early or target in named}
    late = {target: c for target, c in cleaned.values() if target not in early}
    df = _with(df, early)
    if derive_early:
        df = _with(df, _derived(spec))
    for rule in spec.filters:
        df = df.filter(spark_expr(rule))
    df = _with(keep_latest(df, spec.keys, spec.order), late)
    if not derive_early:
        df = _with(df, _derived(spec))
    dropped = set(spec.exclude) | set(GLOBAL_EXCLUDE)
    out = [target for name, (target, _) in cleaned.items() if name not in dropped]
    out += [name for name in spec.derived if name not in out]
    stamp = F.lit(None).cast("timestamp")
    if spec.source_timestamp:
        stamp = parse_timestamp(spec.source_timestamp)
    elif "processing_timestamp" in df.columns:
        stamp = parse_timestamp("processing_timestamp")
    elif spec.partition in df.columns:
        stamp = F.col(spec.partition).cast("timestamp")
    return df.select(
        *out,
        run_time(as_of).alias("_loaded_at"),
        F.lit(spec.source).alias("_source_table"),
        stamp.alias("_source_timestamp"),
    )


def _with(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.withColumns(cols) if cols else df


def _derived(spec: TableSpec) -> dict[str, Column]:
    return {name: spark_expr(e) if isinstance(e, str) else e() for name, e in spec.derived.items()}


def _clean_column(f: T.StructField, spec: TableSpec) -> tuple[str, Column]:
    """(target name, expression) of one raw column."""
    rule = spec.rules.get(f.name)
    if rule is not None:
        return rule.target or f.name, registry.transform(rule.transform, f.name, **rule.params)
    default = registry.DEFAULT_BY_TYPE.get(f.dataType.simpleString())
    if default and spec.clean_strings and f.name != spec.partition:
        return f.name, registry.transform(default, f.name)
    return f.name, F.col(f.name)


def add_missing(df: DataFrame, names: Sequence[str], missing: str = "error") -> DataFrame:
    """Fail with the list of absent columns, or add them as NULL text."""
    absent = [n for n in names if n not in df.columns]
    if absent and missing != "null":
        raise ValueError(f"columns not found: {absent}")
    return df.withColumns({n: F.lit(None).cast("string") for n in absent}) if absent else df


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame, blank_as_null: bool = True, drop_empty_rows: bool = True) -> DataFrame:
    """Trim every text column; blanks become NULL and all-NULL rows go."""
    cols = {c: F.trim(F.col(c)) for c in string_columns(df)}
    if blank_as_null:
        cols = {c: F.nullif(e, F.lit("")) for c, e in cols.items()}
    df = _with(df, cols)
    return df.na.drop("all") if drop_empty_rows else df


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    """Constants for NULLs by column, e.g. ``{"reward_value": 0.0}``."""
    return df.na.fill(values)


def blank_nulls(df: DataFrame) -> DataFrame:
    """NULL text becomes ''."""
    return df.na.fill("", subset=string_columns(df))


def rename_drop(df: DataFrame, rename: dict[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed(rename or {}).drop(*drop)


def coerce(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Type columns by contract; values that do not fit become NULL."""
    return df.withColumns({c: coerced(c, kind) for c, kind in contract.items() if c in df.columns})


def coerced(c: str, kind: str) -> Column:
    target = spark_type(kind)
    text = F.trim(F.col(c).cast("string"))
    if isinstance(target, T.StringType):
        return F.col(c).cast("string")
    if isinstance(target, T.BooleanType):
        return parse_bool(c)
    if isinstance(target, T.ArrayType):
        return parse_list(c)
    if isinstance(target, T.TimestampType):
        return parse_timestamp(c)
    if isinstance(target, T.DateType):
        return F.coalesce(parse_date(c), F.to_date(parse_timestamp(c)))
    if isinstance(target, T.IntegralType):
        # "23.0" is a whole number too
        return F.when(text.rlike(r"^[+-]?\d+(\.0*)?$"), F.substring_index(text, ".", 1).try_cast(target))
    return to_number(text, target)


def flag_columns(df: DataFrame) -> list[str]:
    """Columns whose name says they are flags."""
    return [c for c in df.columns if _FLAG_NAME.search(c) and not isinstance(df.schema[c].dataType, T.BooleanType)]


def booleanize(df: DataFrame) -> DataFrame:
    """Flag-named columns as text: 'true', 'false', or the word itself where it is neither."""
    return _with(df, {c: F.coalesce(parse_bool(c).cast("string"), F.col(f"`{c}`").cast("string")) for c in flag_columns(df)})
