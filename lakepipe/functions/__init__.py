"""Column expressions: text, numbers, times, JSON, templates, registry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case(arms: Iterable[tuple[Column, Column]], otherwise) -> Column:
    """First arm whose condition holds, else ``otherwise``."""
    out = None
    for condition, value in arms:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def as_text(c: Column | str) -> Column:
    return as_col(c).cast("string")
