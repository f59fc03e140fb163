"""Lookups, orphans and foreign keys.

The many side of these joins is a fact table whose keys can be very uneven (a
third of all rows may carry one key).  Counts therefore aggregate per key
before any join.  Row-returning joins let Spark broadcast a lookup that its
size statistics prove small; hot keys, found by a frequency sketch, are salted.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.operators.dedupe import row_hash
from lakepipe.operators.states import State, merge_states, partial_states

HOT_ROWS = 1_000_000  # a key with more rows than this is dealt over several tasks
MOST_HOT = 1_000  # hot keys that are dealt at most; a key outside them has less than one part in so many of all rows
_TRACKED = 1 << 14  # items that the frequency sketch holds


def _no_match(keys: Sequence[str]) -> Column:
    """Whether a row's key holds a NULL, so that it equals no other."""
    return functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[dict[int, int], int]:
    """Hash of each key with more than ``hot_rows`` rows and in how many parts it is dealt; and the rows with a NULL key.

    One scan of the key columns: a frequency sketch per task, merged, of bounded size.  Both sides of a join are dealt by
    this one answer, so they agree when a task is run again; an estimate that is off costs balance, never rows.
    """
    null = _no_match(keys)
    top = F.call_function("approx_top_k", F.when(~null, F.xxhash64(*keys)), F.lit(MOST_HOT), F.lit(_TRACKED))
    found, missing = df.agg(top, F.count_if(null)).first()
    parts = {r["item"]: -(-r["count"] // hot_rows) for r in found or () if r["item"] is not None}
    return {k: n for k, n in parts.items() if n > 1}, missing


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join of an uneven ``left`` with ``right`` (inner, left, left_semi, left_anti), by one exchange of each side.

    Hot keys are known before any row moves: rows of a key with more than ``hot_rows`` rows are dealt over as many shuffle
    keys as that many rows fit in, and the matching right rows are repeated for each; every other row goes by its key.
    A NULL key matches nothing: such rows are left out where the join drops them, go around the join where there are many,
    and else are dealt by their hash.  No side is forced into a broadcast: Spark broadcasts what turns out small.  Finding
    hot keys runs when the join is declared and reads the left keys once more: pass a stored table, not a long derivation.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    hot, missing = hot_keys(left, keys, hot_rows)
    null, around = _no_match(keys), None
    if how in ("inner", "left_semi"):
        left = left.where(~null)
    elif missing > hot_rows:
        left, around = left.where(~null), left.where(null)
    elif missing:
        null_salt = F.when(null, F.pmod(row_hash(left), F.lit(1 << 30)))
    if not hot and (around is not None or not missing or how in ("inner", "left_semi")):
        joined = left.join(right, keys, how)
    else:
        h = F.xxhash64(*keys)
        is_hot = h.isin(list(hot)) if hot else F.lit(False)
        parts = F.element_at(F.create_map(*[F.lit(x) for kv in hot.items() for x in kv]), h) if hot else F.lit(1)
        salt = F.when(is_hot, F.pmod(row_hash(left), parts)).otherwise(0)
        if around is None and missing and how in ("left", "left_anti"):
            salt = F.coalesce(null_salt, salt)
        none = F.lit(0).cast("long")
        copies = F.when(is_hot, F.sequence(none, parts.cast("long") - 1)).otherwise(F.array(none))
        dealt = right.where(~_no_match(keys)).withColumn("_salt", F.explode(copies))
        joined = left.withColumn("_salt", salt.cast("long")).join(dealt, [*keys, "_salt"], how).drop("_salt")
    if around is None:
        return joined
    return joined.unionByName(around, allowMissingColumns=True)


def _keyed(parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Distinct parent keys under the child's names."""
    return parent.select(*[F.col(p).alias(c) for c, p in on]).distinct()


def _pairs(on: Sequence) -> list[tuple[str, str]]:
    return [(c, c) if isinstance(c, str) else tuple(c) for c in on]


def orphan_rows(child: DataFrame, parent: DataFrame, on: Sequence, nullable: bool = False, **skew) -> DataFrame:
    """Child rows without a parent.  ``on`` holds names or (child, parent) pairs.

    Rows with a NULL key are orphans unless the key is ``nullable``.
    """
    on = _pairs(on)
    if nullable:
        child = child.dropna(subset=[c for c, _ in on])
    return skew_join(child, _keyed(parent, on), [c for c, _ in on], "left_anti", **skew)


def orphan_counts(child: DataFrame, parent: DataFrame, on: Sequence, nullable: bool = False) -> DataFrame:
    """One row per orphaned key with its row count; the child is counted per key before any join."""
    on = _pairs(on)
    names = [c for c, _ in on]
    if nullable:
        child = child.dropna(subset=names)
    per_key = child.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_key.join(_keyed(parent, on), names, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence, nullable: bool = False) -> DataFrame:
    """A single row: how many child rows have no parent."""
    per_key = orphan_counts(child, parent, on, nullable)
    return per_key.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("orphaned"))


def table_or_none(spark, name: str) -> DataFrame | None:
    """The table, or None when it does not exist (checks on it are skipped)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right", **skew) -> DataFrame:
    """Inner join; other right columns that clash with the left get a suffix, and rows get a stable id."""
    taken = set(left.columns) - set(keys)
    renamed = right.select(*[F.col(c).alias(c + suffix) if c in taken else F.col(c) for c in right.columns])
    joined = skew_join(left, renamed, keys, "inner", **skew)
    return joined.withColumn("row_id", row_hash(joined))


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of distinct left keys that occur on the right, in percent."""
    keys = list(keys)
    found = right.select(*keys).distinct().withColumn("_found", F.lit(1))
    joined = left.select(*keys).dropna().distinct().join(found, keys, "left")
    total, hits = F.count(F.lit(1)), F.count("_found")
    percent = F.round(hits * 100.0 / F.nullif(total, F.lit(0)), 2)
    return joined.agg(total.alias("keys"), hits.alias("covered"), percent.alias("coverage_pct"))


def key_states(df: DataFrame, key: str, by: Sequence[Column | str] = ()) -> DataFrame:
    """A mergeable sketch of the distinct keys per part of a table (such as a day), to be stored; no key is shuffled."""
    return partial_states(df, by, [State("k", "keys", key)])


def coverage_of_states(left: DataFrame, right: DataFrame) -> DataFrame:
    """As ``coverage``, from stored sketches of both sides: exact up to 2 ** THETA_LG_K keys, estimated beyond."""
    a, b = (merge_states(x, []).select(F.col("k__theta").alias(n)) for x, n in ((left, "a"), (right, "b")))
    one = a.select("a", b.select("b").scalar().alias("b"))
    both = F.theta_sketch_estimate(F.theta_intersection("a", "b"))
    total = F.theta_sketch_estimate("a")
    found = one.select(F.coalesce(total, F.lit(0)).alias("keys"), F.coalesce(both, F.lit(0)).alias("covered"))
    return found.withColumn("coverage_pct", F.round(F.col("covered") * 100.0 / F.nullif(F.col("keys"), F.lit(0)), 2))


def keep_children(child: DataFrame, parent: DataFrame, on: Sequence, **skew) -> DataFrame:
    """Child rows whose parent exists."""
    on = _pairs(on)
    return skew_join(child, _keyed(parent, on), [c for c, _ in on], "left_semi", **skew)


def null_bad_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str, **skew) -> DataFrame:
    """Foreign keys absent from the parent become NULL; rows stay."""
    known = _keyed(parent, [(fk, pk)]).dropna().withColumn("_known", F.lit(True))
    joined = skew_join(child, known, [fk], "left", **skew)
    return joined.select(*[F.when(F.col("_known"), F.col(c)).alias(c) if c == fk else F.col(c) for c in child.columns])


def remap_key(df: DataFrame, c: str, lookup: DataFrame, old: str, new: str, **skew) -> DataFrame:
    """Replace ``c`` through a lookup; unmapped values stay.  The last mapping by value wins."""
    kind = df.schema[c].dataType
    pairs = lookup.select(F.col(old).cast(kind).alias(c), F.col(new).cast(kind).alias("_to")).dropna()
    pairs = pairs.groupBy(c).agg(F.max("_to").alias("_to"))
    joined = skew_join(df, pairs, [c], "left", **skew)
    return joined.select(*[F.coalesce(F.col("_to"), F.col(x)).alias(x) if x == c else F.col(x) for x in df.columns])


def first_per_key(df: DataFrame, key: str, ts: str, until: Column | None = None) -> DataFrame:
    """Earliest time per key (up to a date): the aggregate form of a correlated minimum."""
    if until is not None:
        df = df.filter(F.to_date(ts) <= until)
    return df.groupBy(key).agg(F.min(ts).alias("first_ts"))
