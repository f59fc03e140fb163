"""Cleaning and validating a set of related tables.

Each table is read as text, trimmed, typed, filtered, reduced to one row per
key and moved to UTC; then foreign keys are repaired in dependency order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.times import to_utc
from lakepipe.operators import checks as q
from lakepipe.operators.clean import coerced, fill_nulls, trim_strings
from lakepipe.operators.dedupe import distinct_rows, keep_latest
from lakepipe.operators.filters import apply_rules, drop_missing
from lakepipe.operators.joins import keep_children, null_bad_fk, remap_key, skew_join
from lakepipe.session import materialize


@dataclass(frozen=True)
class RelatedTable:
    """Rules of one table; ``order`` decides which duplicate of a key stays (last one)."""

    types: dict[str, str]
    required: Sequence[str] = ()
    keys: Sequence[str] = ()
    order: str | None = None
    filters: Sequence[str] = ()
    zones: dict[str, str | None] = field(default_factory=dict)  # time column -> zone column
    fill: dict = field(default_factory=dict)


@dataclass(frozen=True)
class ForeignKey:
    """``on_missing``: "null" clears the key, "drop" removes the row, "check" only reports."""

    child: str
    column: str
    parent: str
    parent_key: str
    nullable: bool = True
    on_missing: str = "check"


@dataclass(frozen=True)
class Remap:
    """Replace ``column`` through a raw table's (old, new) columns before foreign keys are applied."""

    child: str
    column: str
    lookup: str
    old: str
    new: str


def clean_one(raw: DataFrame, rule: RelatedTable) -> DataFrame:
    df = trim_strings(raw, blank_as_null=True, drop_empty_rows=False)
    types = {
        c: (to_utc(c, zone) if zone and zone in df.columns else coerced(c, "datetime"))
        for c, zone in rule.zones.items()
        if c in df.columns
    }
    types |= {c: coerced(c, kind) for c, kind in rule.types.items() if c in df.columns and c not in types}
    df = drop_missing(df.withColumns(types), rule.required)
    df = apply_rules(df, rule.filters)
    if rule.keys:
        order = [F.col(rule.order).desc_nulls_last()] if rule.order else []
        df = keep_latest(df, rule.keys, order)
    return fill_nulls(df, rule.fill) if rule.fill else df


def clean_related(
    raw: dict[str, DataFrame],
    rules: dict[str, RelatedTable],
    foreign_keys: Sequence[ForeignKey] = (),
    remaps: Sequence[Remap] = (),
    stage: Callable[[DataFrame, str], DataFrame] = materialize,
) -> dict[str, DataFrame]:
    """Clean every table, then repair keys in the given order (parents before children).

    Each cleaned table is staged once: the key repairs and any checks read it
    several times, and its stored size lets Spark choose the join.
    """
    out = {name: stage(clean_one(raw[name], rule), name) for name, rule in rules.items()}
    by_key: dict[ForeignKey, Remap] = {}
    for m in remaps:
        lookup = raw[m.lookup]
        if m.old not in lookup.columns or m.new not in lookup.columns:
            continue
        k = _followed_by_drop(m, remaps, foreign_keys)
        if k is not None:
            by_key[k] = m
        else:
            out[m.child] = remap_key(out[m.child], m.column, lookup, m.old, m.new)
    for i, k in enumerate(foreign_keys):
        if k in by_key:
            m = by_key[k]
            out[k.child] = _remapped_children(out[k.child], out[k.parent], k, raw[m.lookup], m, stage)
        elif k.on_missing == "null":
            out[k.child] = null_bad_fk(out[k.child], k.column, out[k.parent], k.parent_key)
        elif k.on_missing == "drop":
            out[k.child] = keep_children(out[k.child], out[k.parent], [(k.column, k.parent_key)])
        else:
            continue
        if not any(later.child == k.child for later in foreign_keys[i + 1 :]):
            out[k.child] = stage(out[k.child], k.child)
    return out


def _followed_by_drop(m: Remap, remaps: Sequence[Remap], foreign_keys: Sequence[ForeignKey]) -> ForeignKey | None:
    """The foreign key that drops rows by a column right after its only remap, if nothing reads the column in between."""
    if sum((x.child, x.column) == (m.child, m.column) for x in remaps) > 1 or any(k.parent == m.child for k in foreign_keys):
        return None
    own = [k for k in foreign_keys if (k.child, k.column) == (m.child, m.column)]
    return own[0] if own and own[0].on_missing == "drop" and own.count(own[0]) == 1 else None


def _remapped_children(
    child: DataFrame, parent: DataFrame, k: ForeignKey, lookup: DataFrame, m: Remap, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """``remap_key``, then ``keep_children``, on the distinct keys; whole rows move once, to meet what became of their key."""
    c = k.column
    keys = stage(child.select(c).where(F.col(c).isNotNull()).distinct().withColumn("_from", F.col(c)), "keys")
    kept = keep_children(remap_key(keys, c, lookup, m.old, m.new), parent, [(c, k.parent_key)])
    kept = kept.select(F.col("_from").alias(c), F.col(c).alias("_to"))
    joined = skew_join(child, kept, [c], "inner")
    return joined.select(*[F.col("_to").alias(x) if x == c else F.col(x) for x in child.columns])


def drop_duplicates_to_utc(df: DataFrame, required: Sequence[str], times: Sequence[str]) -> DataFrame:
    """The short form: required values, exact duplicates, times as UTC."""
    df = distinct_rows(drop_missing(df, required))
    return df.withColumns({c: coerced(c, "datetime") for c in times if c in df.columns})


def related_checks(
    rules: dict[str, RelatedTable], foreign_keys: Sequence[ForeignKey], not_null: dict[str, Sequence[str]]
) -> list[q.Check]:
    """Rows present, required values, key uniqueness, references."""
    suite = []
    for name, rule in rules.items():
        suite.append(q.row_count(name))
        suite += [q.not_null(name, c) for c in not_null.get(name, rule.required)]
        if rule.keys:
            suite.append(q.unique(name, rule.keys))
    for k in foreign_keys:
        suite.append(q.references(k.child, [(k.column, k.parent_key)], k.parent, k.nullable))
    return suite
