"""Text templates and reproducible identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions import as_col
from lakepipe.functions.dialect import spark_expr

_HOLE = re.compile(r"\{([^{}]*)\}")


def render(template: str) -> Column:
    """'{a} closed: {abs(b)}' as a concatenation; NULL values become ''."""
    parts, at = [], 0
    for hole in _HOLE.finditer(template):
        if hole.start() > at:
            parts.append(F.lit(template[at : hole.start()]))
        parts.append(F.coalesce(spark_expr(hole.group(1)).cast("string"), F.lit("")))
        at = hole.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts) if parts else F.lit("")


def stable_id(*parts) -> Column:
    """The same id for the same parts on every run."""
    return F.md5(F.concat_ws("|", *[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts]))
