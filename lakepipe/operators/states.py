"""Mergeable aggregate states.

A state column can be added up again later: sums, counts, minima, maxima and
distinct-count sketches.  Averages, rates and distinct counts are derived from
states on read, so merging partial results equals recomputing from scratch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.functions import as_col
from lakepipe.functions.times import monday

# how each kind of state column is merged
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "uniq": F.hll_union_agg}
MERGE |= {"kll": F.kll_merge_agg_double, "theta": lambda c: F.theta_union_agg(c, F.lit(THETA_LG_K))}
THETA_LG_K = 16  # a set of up to 65,536 keys is kept exactly; larger ones within about 0.4 % (one standard error)
KLL_K = 400  # size of a quantile sketch
KLL_ERROR = 0.01  # of a rank, as a share of all values; a sketch of size 400 promises 0.7 % with 99 % confidence


def aggregate_state(fn: str, c="*") -> dict[str, Column]:
    """State aggregates for ``fn``: suffix -> aggregate column."""
    if fn == "count":
        return {"count": F.count(F.lit(1) if isinstance(c, str) and c == "*" else as_col(c))}
    c = as_col(c)
    if fn == "avg":
        return {"sum": F.sum(c), "count": F.count(c)}
    if fn == "uniq":
        return {"uniq": F.hll_sketch_agg(c)}
    if fn == "keys":
        return {"theta": F.theta_sketch_agg(c, F.lit(THETA_LG_K))}
    if fn == "quantiles":
        return {"kll": F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_K))}
    if fn in ("sum", "min", "max"):
        return {fn: getattr(F, fn)(c)}
    raise ValueError(f"no state for {fn!r}")


@dataclass(frozen=True)
class State:
    """One named state, e.g. ``State("points", "avg", "points")``; ``column`` may be an expression.

    "keys" keeps a sketch of the distinct values that can be intersected with another one.  "quantiles" keeps a sketch of the values' order; on read it gives ``probs`` as an array, each within ``KLL_ERROR`` of
    its rank.
    """

    name: str
    fn: str
    column: Column | str = "*"
    probs: tuple[float, ...] = (0.5, 0.95)


def partial_states(df: DataFrame, keys: Sequence[Column | str], states: Sequence[State]) -> DataFrame:
    aggs = [
        agg.alias(f"{s.name}__{suffix}") for s in states for suffix, agg in aggregate_state(s.fn, s.column).items()
    ]
    return df.groupBy(*keys).agg(*aggs)


def _kind(column: str) -> str | None:
    kind = column.rsplit("__", 1)[-1] if "__" in column else None
    return kind if kind in MERGE else None


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def merge_states(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up partial states per key."""
    aggs = [MERGE[_kind(c)](_quoted(c)).alias(c) for c in partials.columns if _kind(c)]
    return partials.groupBy(*keys).agg(*aggs)


def finalize_states(merged: DataFrame, states: Sequence[State]) -> DataFrame:
    """State columns to plain numbers."""
    keys = [c for c in merged.columns if not _kind(c)]
    out = []
    for s in states:
        c = lambda suffix: _quoted(f"{s.name}__{suffix}")  # noqa: E731, B023
        if s.fn == "avg":
            value = c("sum").cast("double") / F.nullif(c("count"), F.lit(0))
        elif s.fn == "uniq":
            value = F.hll_sketch_estimate(c("uniq"))
        elif s.fn == "keys":
            value = F.theta_sketch_estimate(c("theta"))
        elif s.fn == "quantiles":
            some = F.when(F.kll_sketch_get_n_double(c("kll")) > 0, c("kll"))
            value = F.array(*[F.kll_sketch_get_quantile_double(some, F.lit(float(p))) for p in s.probs])
        else:
            value = c(s.fn)
        out.append(value.alias(s.name))
    return merged.select(*keys, *out)


ENGAGEMENT = (
    State("total_leads", "uniq", "id"),
    State("total_records", "count"),
    State("avg_points", "avg", "points"),
    State("max_points", "max", "points"),
    State("min_points", "min", "points"),
    State("total_points", "sum", "points"),
)


def weekly_engagement(df: DataFrame, ts: str = "date_added", states: Sequence[State] = ENGAGEMENT) -> DataFrame:
    """Partial states per Monday week."""
    return partial_states(df.filter(F.col(ts).isNotNull()), [monday(ts).alias("week_start")], states)


def summing_merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the same key are added up.

    Only counts and sums may be stored this way; an average or a distinct count
    has to be kept as a state.
    """
    rest = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])
