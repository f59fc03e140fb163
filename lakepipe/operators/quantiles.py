"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.session import materialize

CUTS = 64  # equal-depth parts of a bracket per round
RANKED = 10_000  # distinct values of a bracket that are put in order at last


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 1_000, ranked: int = RANKED
) -> DataFrame:
    """Linear-interpolated quantiles per group: ``by`` columns + ``quantiles`` array.

    Equal values are counted together first, in one pass over ``df`` that is stored.  Each wanted rank then has a bracket
    of values that holds it, at first all of its group.  While a bracket holds more than ``ranked`` distinct values, a
    sketch of the bracket itself cuts it into parts of about as many distinct values each, the parts are counted, and the
    one with the rank is the next bracket: whatever the values, it holds about a ``CUTS``-th of the last one's.  Ranks are
    counted, not estimated, so the result is exact; ``accuracy`` of the sketch only sets how even the parts are.
    The rounds run when the quantiles are declared; groups of few values need none.
    """
    by, value_col = list(by), F.col(value).cast("double")
    rows = df.select(*by, value_col.alias("_v")).filter("_v IS NOT NULL")
    counted = materialize(rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n")), "counted")
    groups = counted.groupBy(*by).agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_held")).where("_total > 0")
    state = groups.select(*by, "_total", _first_brackets(probs).alias("_brackets"))
    while True:
        state = materialize(state, "brackets")
        most = state.agg(F.max(F.array_max(F.transform("_brackets", lambda b: b["held"])))).first()[0]
        if most is None or most <= ranked:
            break
        state = _narrowed(counted, state, by, accuracy, ranked)
    placed, span = _inside(counted, state, by, lambda b: F.lit(True)), [*by, "_low", "_high"]
    upto = Window.partitionBy(*span).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("_upto", F.col("_before") + F.sum("_n").over(upto))
    wanted = _brackets(state, by, lambda b: F.lit(True)).groupBy(*span).agg(F.collect_list("_b").alias("_wanted"))
    here = lambda b: (b["rank"] < F.col("_upto")) & (b["rank"] >= F.col("_upto") - F.col("_n"))
    found = _beside(placed, wanted, span).select(*by, F.explode(F.filter("_wanted", here)).alias("_b"), F.col("_v").alias("v"))
    found = found.select(*by, "_b.i", "_b.up", "_b.share", "v")
    pick = lambda up: F.max(F.when(F.col("up") == up, F.col("v")))
    pairs = found.groupBy(*by, "i", "share").agg(pick(False).alias("lo"), pick(True).alias("hi"))
    q = F.col("lo") + F.when(F.col("share") > 0, (F.col("hi") - F.col("lo")) * F.col("share")).otherwise(0.0)
    ordered = F.sort_array(F.collect_list(F.struct("i", q.alias("q"))))
    return pairs.groupBy(*by).agg(F.transform(ordered, lambda x: x["q"]).alias("quantiles"))


def _first_brackets(probs: Sequence[float]) -> Column:
    """Per probability the ranks below and above its place, each in a bracket of all values.

    A bracket holds the values v with low < v <= high; NULL is no bound.  ``before`` rows lie below it, ``held`` distinct
    values in it.
    """
    out = []
    for i, p in enumerate(probs):
        place = F.lit(float(p)) * (F.col("_total") - 1)
        share = place - F.floor(place)
        for up in (False, True):
            rank = F.ceil(place) if up else F.floor(place)
            out.append(
                F.struct(
                    F.lit(i).alias("i"), F.lit(up).alias("up"), share.alias("share"), rank.cast("bigint").alias("rank"),
                    F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                    F.lit(0).cast("bigint").alias("before"), F.col("_held").alias("held"),
                )
            )
    return F.array(*out)


def _beside(df: DataFrame, one: DataFrame, by: Sequence[str]) -> DataFrame:
    """df with the columns of ``one``, which has one row per group (NULL is a group), or one row where there are none."""
    if not by:
        row = one.select(F.struct("*").alias("s")).scalar()
        return df.withColumn("_row", row).select("*", "_row.*").drop("_row")
    other = one.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return df.join(other, same).drop(*[f"_of_{c}" for c in by])


def _brackets(state: DataFrame, by: Sequence[str], which) -> DataFrame:
    """The brackets that ``which`` picks, a row each: ``by``, _total, _b and its range as _low, _high."""
    rows = state.select(*by, "_total", F.explode(F.filter("_brackets", which)).alias("_b"))
    return rows.select("*", F.col("_b.low").alias("_low"), F.col("_b.high").alias("_high"))


def _inside(counted: DataFrame, state: DataFrame, by: Sequence[str], which) -> DataFrame:
    """The counted values in the ranges of the brackets that ``which`` picks: ``by``, _low, _high, _before, _v, _n.

    The ranges of a group's brackets are equal or disjoint, so that a value comes once however many ranks are wanted.
    """
    ranges = F.transform(
        F.filter("_brackets", which),
        lambda b: F.struct(b["low"].alias("low"), b["high"].alias("high"), b["before"].alias("before")),
    )
    picked = state.select(*by, F.array_distinct(ranges).alias("_ranges")).where(F.size("_ranges") > 0)
    joined = _beside(counted, picked, by)
    v = F.col("_v")
    there = lambda b: (b["low"].isNull() | (v > b["low"])) & (b["high"].isNull() | (v <= b["high"]))
    rows = joined.select(*by, F.explode(F.filter("_ranges", there)).alias("_r"), "_v", "_n")
    return rows.select(*by, *[F.col(f"_r.{c}").alias(f"_{c}") for c in ("low", "high", "before")], "_v", "_n")


def _parted(df: DataFrame) -> DataFrame:
    """df with ``_part``: how many of the ordered ``_cuts`` lie below _v, found by halving (CUTS is a power of two)."""
    df, step = df.withColumn("_part", F.lit(0)), CUTS // 2
    while step:
        below = F.get("_cuts", F.col("_part") + (step - 1)) < F.col("_v")
        df = df.withColumn("_part", F.col("_part") + F.when(below, step).otherwise(0))
        step //= 2
    return df


def _narrowed(counted: DataFrame, state: DataFrame, by: Sequence[str], accuracy: int, ranked: int) -> DataFrame:
    """The state with every bracket of more than ``ranked`` values replaced by its part that holds the rank."""
    wide = lambda b: b["held"] > ranked
    inside, span = _inside(counted, state, by, wide), [*by, "_low", "_high"]
    cuts = inside.groupBy(*span).agg(F.percentile_approx("_v", [k / CUTS for k in range(1, CUTS)], accuracy).alias("_cuts"))
    # stored, so that their size is known before the values would be shuffled to meet them
    parted = _parted(_beside(inside, materialize(cuts, "cuts"), span))
    sums = parted.groupBy(*span, "_before", "_part").agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_held"), F.max("_v").alias("_top")
    )
    # at most CUTS rows per range
    order = Window.partitionBy(*span).orderBy("_part")
    upto = F.col("_before") + F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    sums = sums.withColumn("_upto", upto).withColumn("_from", F.coalesce(F.lag("_top").over(order), F.col("_low")))
    both = _beside(sums, _brackets(state, by, wide), span)
    hit = both.where((F.col("_b.rank") < F.col("_upto")) & (F.col("_b.rank") >= F.col("_upto") - F.col("_n")))
    new = F.struct(
        F.col("_b.i").alias("i"), F.col("_b.up").alias("up"), F.col("_b.share").alias("share"), F.col("_b.rank").alias("rank"),
        F.col("_from").alias("low"), F.col("_top").alias("high"), (F.col("_upto") - F.col("_n")).alias("before"),
        F.col("_held").alias("held"),
    )
    kept = _brackets(state, by, lambda b: b["held"] <= ranked).select(*by, "_total", "_b")
    moved = hit.select(*by, "_total", new.alias("_b"))
    return moved.unionByName(kept).groupBy(*by, "_total").agg(F.collect_list("_b").alias("_brackets"))


def score(c: Column, edges: Column, n: int, reverse: bool = False) -> Column:
    """1 + number of edges strictly below the value (right-closed bins)."""
    low = F.lit(1)
    for i in range(n):
        low = low + (c > edges[i]).cast("int")
    return F.lit(n + 2) - low if reverse else low
