"""Metrics as a SQL stage, a Python stage, or both."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakepipe.functions.dialect import add_functions
from lakepipe.operators import checks as q
from lakepipe.operators.checks import fill_sql
from lakepipe.operators.contract import validate_frame
from lakepipe.plans import backfill
from lakepipe.session import shared_dir


@dataclass(frozen=True)
class Metric:
    """``sql`` runs over the input tables; ``fn(frame or tables, ds, **context)`` refines it.

    With only ``sql`` this is a SQL metric, with only ``fn`` a Python metric,
    with both a hybrid one.  Frames stay distributed throughout.
    """

    name: str
    sql: str | None = None
    fn: Callable[..., DataFrame] | None = None
    required: Sequence[str] = ()
    numeric: Sequence[str] = ()
    suite: Sequence[q.Check] = ()
    ranged: bool = False  # sql and fn take a whole range, as ``start`` and ``end``

    def __post_init__(self):
        if self.sql is None and self.fn is None:
            raise ValueError(f"metric {self.name!r} needs sql, fn or both")

    def run(self, spark: SparkSession, tables: dict[str, DataFrame], ds: str, **context) -> DataFrame:
        out: DataFrame | dict = tables
        if self.sql is not None:
            for name, df in tables.items():
                df.createOrReplaceTempView(name)
            text = fill_sql(self.sql, {"ds": ds, **context})
            add_functions(spark, text)
            out = spark.sql(text)
        if self.fn is not None:
            out = self.fn(out, ds, **context)
        absent = [c for c in self.required if c not in out.columns]
        if absent:
            raise ValueError(f"metric {self.name!r} lacks columns {absent}")
        return out

    def validate(self, out: DataFrame) -> DataFrame:
        """Check results: required columns hold no NULLs, declared checks."""
        parts = validate_frame(out, self.required, self.numeric) if self.required else None
        if self.suite:
            extra = q.run_checks({self.name: out}, self.suite)
            parts = extra if parts is None else parts.unionByName(extra)
        return parts

    def backfill(self, spark, tables, start: str, end: str, path: str | None = None, **context) -> DataFrame:
        """The metric for each day of a range: one plan if it takes ranges, else one job per day, kept under ``path``."""
        if self.ranged:
            return self.run(spark, tables, end, start=start, end=end, **context)
        path = path or shared_dir(spark, f"metric-{self.name}")
        return backfill.each_day(lambda ds: self.run(spark, tables, ds, **context), start, end, path).drop("run_date")
