"""Number and flag expressions: strict forms raise on junk, lenient forms do not."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions import as_col, as_text

# Words read as true / false.
FLAG_TRUE = ["true", "yes", "1", "y", "True", "Yes", "TRUE", "YES"]
BOOL_TRUE = ["true", "yes", "y", "1", "t"]
BOOL_FALSE = ["false", "no", "n", "0", "f"]

WHOLE = r"^[+-]?\d+$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def normalize_boolean(c) -> Column:
    """1 for a true word, else 0."""
    return F.when(as_text(c).isin(FLAG_TRUE), 1).otherwise(0)


def parse_bool(c) -> Column:
    """true / false words in any case; anything else NULL."""
    word = F.lower(F.trim(as_text(c)))
    return F.when(word.isin(BOOL_TRUE), True).when(word.isin(BOOL_FALSE), False)


def flag_to_int(c, keep_null: bool = False) -> Column:
    c = as_col(c).cast("boolean")
    return c.cast("tinyint") if keep_null else F.when(c, 1).otherwise(0).cast("tinyint")


def default_null(c, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def _strip(c, symbols: str) -> Column:
    # translate with an empty target removes the listed characters
    return F.translate(as_text(c), symbols, "")


def parse_money(c, precision: int = 15, scale: int = 2) -> Column:
    """'$1,234.56' to a decimal; junk raises, NULL is 0."""
    return _strip(F.coalesce(as_text(c), F.lit("0")), "$,").cast(T.DecimalType(precision, scale))


def parse_percentage(c, precision: int = 5, scale: int = 2) -> Column:
    """'45.5%' to a decimal; junk raises, NULL is 0."""
    return _strip(F.coalesce(as_text(c), F.lit("0")), "%,").cast(T.DecimalType(precision, scale))


def to_number(text: Column, kind) -> Column:
    """Text to a number, NULL when it is none.

    The pattern test comes first because a failing cast raises and catches an
    error per row, which is some fifty times slower than the test.
    """
    whole = isinstance(kind, T.IntegralType)
    return F.when(text.rlike(WHOLE if whole else NUMBER), text.try_cast(kind))


def decimal_or(c, scale: int = 2, otherwise=0, symbols: str = "", when_null=None) -> Column:
    """Decimal(18, scale); text that does not parse gives ``otherwise``.

    ``when_null`` replaces a NULL input (1.0 for price factors, for example).
    """
    kind = T.DecimalType(18, scale)
    text = F.trim(_strip(c, symbols) if symbols else as_text(c))
    out = F.coalesce(to_number(text, kind), F.lit(otherwise).cast(kind))
    if when_null is not None:
        out = F.when(as_col(c).isNull(), F.lit(when_null).cast(kind)).otherwise(out)
    return out


def money_or_zero(c, scale: int = 2) -> Column:
    return decimal_or(c, scale, 0, "$,")


def percent_or_zero(c, scale: int = 2) -> Column:
    return decimal_or(c, scale, 0, "%,")


def int_or_zero(c) -> Column:
    return F.coalesce(safe_int(c), F.lit(0).cast("bigint"))


def float_or_zero(c) -> Column:
    return F.coalesce(safe_float(c), F.lit(0.0))


def safe_int(c) -> Column:
    return to_number(F.trim(as_text(c)), T.LongType())


def safe_float(c) -> Column:
    return to_number(F.trim(as_text(c)), T.DoubleType())


def widen(c, kind: str) -> Column:
    return as_col(c).cast(kind)
