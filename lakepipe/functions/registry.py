"""Named transforms used by table declarations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions import as_col, case, jsons, numeric, text, times
from lakepipe.functions.dialect import spark_expr

Transform = Callable[..., Column]

TRANSFORMS: dict[str, Transform] = {
    "clean_string": text.clean_string,
    "clean_email": text.clean_email,
    "clean_phone": text.clean_phone,
    "clean_upper": text.clean_upper,
    "extract_email_domain": text.extract_email_domain,
    "normalize": text.normalize,
    "normalize_status": text.normalize_status,
    "normalize_boolean": numeric.normalize_boolean,
    "parse_money": numeric.parse_money,
    "parse_percentage": numeric.parse_percentage,
    "money_or_zero": numeric.money_or_zero,
    "percent_or_zero": numeric.percent_or_zero,
    "int_or_zero": numeric.int_or_zero,
    "float_or_zero": numeric.float_or_zero,
    "safe_int": numeric.safe_int,
    "safe_float": numeric.safe_float,
    "flag_to_int": numeric.flag_to_int,
    "parse_bool": numeric.parse_bool,
    "parse_date": times.parse_timestamp,
    "parse_date_only": times.parse_date,
    "parse_epoch_ms": times.from_epoch_ms,
    "parse_epoch_sec": times.from_epoch_s,
    "json_string": lambda c, param: jsons.json_string(c, *param.split(".")),
    "json_int": lambda c, param: jsons.json_int(c, *param.split(".")),
    "is_valid_json": jsons.is_valid_json,
    "parse_list": jsons.parse_list,
    "id_or_blank": text.id_or_blank,
    "pass": as_col,
}

# Applied to columns of a type that have no declared transform.
DEFAULT_BY_TYPE = {"string": "clean_string"}


def register(name: str, fn: Transform) -> None:
    TRANSFORMS[name] = fn


def transform(name: str, c, **params) -> Column:
    if name not in TRANSFORMS:
        raise KeyError(f"unknown transform {name!r}; known: {sorted(TRANSFORMS)}")
    return TRANSFORMS[name](c, **params)


def _from_sql(sql: str) -> Transform:
    def build(c, **params):
        name = c if isinstance(c, str) else None
        if name is None:
            raise TypeError("SQL transforms take a column name")
        return spark_expr(sql.format(col=name, **params))

    return build


def _from_cases(mappings: list[dict], default: str, number: bool) -> Transform:
    def build(c, **params):
        arms = []
        for m in mappings:
            value = spark_expr(m["value"].format(col=c)) if m.get("is_expression") else F.lit(m["value"])
            arms.append((spark_expr(m["match"].format(col=c, **params)), value))
        out = case(arms, F.lit(default))
        return out.cast("int") if number else out

    return build


def load_transforms(declared: dict, replace: bool = False) -> list[str]:
    """Register transforms from a declaration file's mapping; returns their names.

    Each entry is ``{sql: "...{col}..."}`` or ``{type: multiIf, mappings, default}``.
    Names known already keep their built-in form unless ``replace`` is set.
    """
    names = []
    for section in declared.values():
        if not isinstance(section, dict):
            continue
        for name, entry in section.items():
            if not isinstance(entry, dict) or (name in TRANSFORMS and not replace):
                continue
            if "sql" in entry:
                register(name, _from_sql(entry["sql"]))
            elif entry.get("type") == "multiIf":
                number = "Int" in str(entry.get("output_type", ""))
                register(name, _from_cases(entry["mappings"], entry["default"], number))
            else:
                continue
            names.append(name)
    return names
