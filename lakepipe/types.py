"""Declared column type names and the Spark types they stand for."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Type names accepted in declarations.
SIMPLE = {
    "String": T.StringType(),
    "FixedString": T.StringType(),
    "UUID": T.StringType(),
    "Enum8": T.StringType(),
    "Enum16": T.StringType(),
    "IPv4": T.StringType(),
    "IPv6": T.StringType(),
    "JSON": T.StringType(),
    "Object": T.StringType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.LongType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Bool": T.BooleanType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "Date32": T.DateType(),
    "DateTime": T.TimestampType(),
    "DateTime64": T.TimestampType(),
    # names used by file contracts
    "string": T.StringType(),
    "str": T.StringType(),
    "text": T.StringType(),
    "int": T.LongType(),
    "integer": T.LongType(),
    "bigint": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "number": T.DoubleType(),
    "decimal": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "text[]": T.ArrayType(T.StringType()),
    "jsonb": T.StringType(),
}

_WRAPPED = re.compile(r"^(Nullable|LowCardinality)\((.*)\)$")
_CALL = re.compile(r"^(\w+)\((.*)\)$")


def spark_type(name: str) -> T.DataType:
    """Spark type for a declared type name; unknown names raise."""
    name = name.strip()
    wrapped = _WRAPPED.match(name)
    if wrapped:
        return spark_type(wrapped.group(2))
    if name in SIMPLE:
        return SIMPLE[name]
    if name.lower() in SIMPLE:
        return SIMPLE[name.lower()]
    call = _CALL.match(name)
    if call:
        kind, args = call.group(1), [a.strip() for a in call.group(2).split(",")]
        if kind == "Array":
            return T.ArrayType(spark_type(call.group(2)))
        if kind == "Map":
            return T.MapType(spark_type(args[0]), spark_type(",".join(args[1:])))
        if kind == "Decimal":
            return T.DecimalType(int(args[0]), int(args[1]) if len(args) > 1 else 0)
        if kind in ("Decimal32", "Decimal64", "Decimal128"):
            return T.DecimalType({"Decimal32": 9, "Decimal64": 18, "Decimal128": 38}[kind], int(args[0]))
        if kind in SIMPLE:  # DateTime64(3), FixedString(16), DateTime('UTC')
            return SIMPLE[kind]
    raise ValueError(f"unknown column type {name!r}")


def spark_schema(columns: list[dict]) -> T.StructType:
    """Schema from ``[{name, type, nullable?}]`` declarations."""
    return T.StructType([T.StructField(c["name"], spark_type(c["type"]), True) for c in columns])
