"""JSON held in text columns, and list-like text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions import as_col, as_text
from lakepipe.functions.numeric import int_or_zero


def _path(keys) -> str:
    return "$" + "".join(f"['{k}']" for k in keys)


def json_string(c, *keys: str) -> Column:
    """Text at a path, '' when absent."""
    return F.coalesce(F.get_json_object(as_text(c), _path(keys)), F.lit(""))


def json_int(c, *keys: str) -> Column:
    return int_or_zero(F.get_json_object(as_text(c), _path(keys)))


def is_valid_json(c) -> Column:
    """1 for valid JSON, else 0."""
    return F.try_parse_json(as_text(c)).isNotNull().cast("int")


def json_array(c) -> Column:
    """Array of the raw elements; empty for NULL, '' and anything else unreadable."""
    return F.coalesce(
        F.from_json(F.coalesce(as_text(c), F.lit("[]")), T.ArrayType(T.StringType())),
        F.array().cast("array<string>"),
    )


def json_array_size(c) -> Column:
    return F.coalesce(F.json_array_length(as_text(c)), F.lit(0))


def json_array_count(c, keep: Callable[[Column], Column]) -> Column:
    """Number of elements for which ``keep`` holds."""
    return F.size(F.filter(json_array(c), keep))


def explode_json(
    df: DataFrame,
    c: str,
    out: str = "element",
    keep: Callable[[Column], Column] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """One row per element of a JSON array column; rows without elements drop out.

    Elements are raw JSON text, or structs of ``schema`` (DDL of one element),
    which parses each array once instead of once per extracted field.
    """
    items = json_array(c) if schema is None else F.from_json(as_text(c), f"array<struct<{schema}>>")
    if keep is not None:
        items = F.filter(items, keep)
    # the pattern test skips JSON parsing for empty arrays
    filled = df.filter(as_col(c).isNotNull() & ~as_col(c).isin("", "[]"))
    return filled.withColumn(out, F.explode(items))


def map_json(items: dict[str, Column]) -> Column:
    """JSON text of a fixed set of keys, in the given order."""
    pairs = [x for k, v in items.items() for x in (F.lit(k), F.coalesce(as_text(v), F.lit("")))]
    return F.to_json(F.create_map(*pairs))


def parse_list(c) -> Column:
    """List literal (items in double or single quotes) or comma-separated text to an array; empty or NULL gives []."""
    text = F.trim(as_text(c))
    literal = F.when(text.startswith("["), F.from_json(text, T.ArrayType(T.StringType()), {"allowSingleQuotes": "true"}))
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x))
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | (text == ""), empty).otherwise(F.coalesce(literal, parts))


def interchange(df: DataFrame) -> DataFrame:
    """Every column in a form any consumer can read.

    Times become ISO text, decimals text, bytes base64, nested values JSON.
    """
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            micros = F.date_format(c, "SSSSSS")
            c = F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
        elif isinstance(t, (T.DateType, T.DecimalType)):
            c = c.cast("string")
        elif isinstance(t, T.BinaryType):
            c = F.base64(c)
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)
