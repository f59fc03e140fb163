"""Dates, times and zones."""

from __future__ import annotations

import functools
import zoneinfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions import as_col, as_text
from lakepipe.functions.numeric import int_or_zero

_ZONED = r"\d{1,2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})$"


def best_effort_sql(t: str, day_first: bool = True) -> str:
    """SQL for the best-effort timestamp of a text: the one definition behind ``parse_timestamp`` and declared SQL.

    The shape of the text picks one format: ISO with -, / or . (with or without zone), yyyyMMddHHmmss, yyyyMMdd, epoch
    seconds or milliseconds, day.month.year, and day and month name in either order, each with an optional time and
    AM / PM, which shifts an hour that the text names.  Ambiguous numbers are day first or month first; unambiguous ones
    are read either way.
    """
    text = rf"regexp_replace(trim({t}), r'(?i)(\d)\s*[ap]m$', '$1')"
    slashed = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
    orders = ("$3-$2-$1", "$3-$1-$2") if day_first else ("$3-$1-$2", "$3-$2-$1")
    usual, other = (f"try_cast(regexp_replace({text}, r'{slashed}', '{o}') AS TIMESTAMP)" for o in orders)
    big = r"(1[3-9]|[23]\d)"  # can only be a day
    certain = rf"^\d{{1,2}}[/.-]{big}[/.-]\d{{4}}" if day_first else rf"^{big}[/.-]\d{{1,2}}[/.-]\d{{4}}"
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"

    def named(shape: str, day: int, month: int) -> str:
        part = lambda i: f"regexp_extract({text}, r'{shape}', {i})"
        at = f"instr('janfebmaraprmayjunjulaugsepoctnovdec', lower(left({part(month)}, 3)))"
        number = f"CASE WHEN {at} % 3 = 1 THEN CAST(({at} + 2) DIV 3 AS STRING) END"
        return f"WHEN {text} RLIKE r'{shape}' THEN try_cast(concat({part(3)}, '-', {number}, '-', {part(day)}, {part(4)}) AS TIMESTAMP)"

    day_month = r"^(?:[A-Za-z]{3,9},? )?(\d{1,2})[ -]([A-Za-z]{3,9})[ ,-]+(\d{4})(.*)$"
    month_day = r"^([A-Za-z]{3,9}) +(\d{1,2}),? +(\d{4})(.*)$"
    found = rf"""CASE
      WHEN {text} RLIKE r'{iso}' THEN try_cast(regexp_replace({text}, r'{iso}', '$1-$2-$3') AS TIMESTAMP)
      WHEN {text} RLIKE r'^\d{{14}}$' THEN try_to_timestamp({text}, 'yyyyMMddHHmmss')
      WHEN {text} RLIKE r'^\d{{13}}$' THEN timestamp_millis(try_cast({text} AS BIGINT))
      WHEN {text} RLIKE r'^\d{{9,10}}$' THEN timestamp_seconds(try_cast({text} AS BIGINT))
      WHEN {text} RLIKE r'^\d{{8}}$' THEN try_to_timestamp({text}, 'yyyyMMdd')
      WHEN {text} RLIKE r'{certain}' THEN {other}
      WHEN {text} RLIKE r'{slashed}' THEN {usual}
      {named(day_month, 1, 2)}
      {named(month_day, 2, 1)} END"""
    # the shift is read off the text's own hour, so the parse itself stands in the expression once
    hour = rf"""coalesce(try_cast(regexp_extract({text}, r'^(?:.*?\D)?(\d{{1,2}}):\d', 1) AS INT),
      try_cast(regexp_extract({text}, r'^\d{{8}}(\d{{2}})\d{{4}}$', 1) AS INT))"""
    shift = rf"""CASE
      WHEN NOT trim({t}) RLIKE r'(?i)\d\s*[ap]m$' THEN 0
      WHEN lower(left(right(trim({t}), 2), 1)) = 'p' AND {hour} < 12 THEN 12
      WHEN lower(left(right(trim({t}), 2), 1)) = 'a' AND {hour} = 12 THEN -12
      ELSE 0 END"""
    return f"({found}) + make_dt_interval(0, {shift}, 0, 0)"


@functools.lru_cache(maxsize=64)
def _defined(spark: SparkSession, name: str, day_first: bool) -> str:
    body = best_effort_sql("t", day_first)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS TIMESTAMP RETURN {body}")
    return name


def parse_timestamp(c, day_first: bool = True) -> Column:
    """Best-effort timestamp; NULL when nothing fits, see ``best_effort_sql``."""
    name = "best_effort_time" if day_first else "best_effort_time_month_first"
    return F.call_function(_defined(SparkSession.active(), name, day_first), as_text(c))


def parse_date(c) -> Column:
    """Date from ISO text or yyyyMMdd text / integers; NULL when neither fits."""
    text = F.trim(as_text(c))
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")).otherwise(
        text.try_cast("date")
    )


def timestamp_date(c) -> Column:
    return F.to_date(parse_timestamp(c))


def from_epoch_ms(c) -> Column:
    """Epoch milliseconds to a timestamp in whole seconds; junk is the epoch."""
    millis = int_or_zero(c)
    return F.timestamp_seconds(F.floor(millis / 1000))


def from_epoch_s(c) -> Column:
    return F.timestamp_seconds(int_or_zero(c))


def day_diff(start, end) -> Column:
    """Number of midnights crossed."""
    return F.datediff(F.to_date(as_col(end)), F.to_date(as_col(start)))


def minute_diff(start, end) -> Column:
    """Number of minute boundaries crossed (00:00:59 to 00:01:00 is 1)."""
    return (_boundary(end, 60) - _boundary(start, 60)).cast("bigint")


def second_diff(start, end) -> Column:
    """Number of second boundaries crossed."""
    return (_boundary(end, 1) - _boundary(start, 1)).cast("bigint")


def _boundary(c, unit: int) -> Column:
    return F.floor(F.unix_timestamp(as_col(c).cast("timestamp")) / unit)


def monday(c) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", as_col(c)))


@functools.cache
def _zones() -> tuple[str, ...]:
    spark = SparkSession.getActiveSession()
    try:  # the names the JVM itself accepts
        return tuple(sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds()))
    except AttributeError:
        return tuple(sorted(zoneinfo.available_timezones()))


def to_utc(c, zone) -> Column:
    """Local time plus zone column to UTC.

    Text that already carries an offset is converted by that offset.  An
    unknown or missing zone is read as UTC, since the built-in would raise.
    """
    text = F.trim(as_text(c))
    if isinstance(zone, str):  # as SQL text: building some 600 literals one by one takes a second
        names = ", ".join(f"'{z}'" for z in _zones())
        known, zone = F.expr(f"trim(CAST(`{zone}` AS STRING)) IN ({names})"), F.trim(as_text(zone))
    else:
        zone = F.trim(as_text(zone))
        known = zone.isin(list(_zones()))
    from_zone = ~text.rlike(_ZONED) & known
    return F.to_utc_timestamp(parse_timestamp(text), F.when(from_zone, zone).otherwise("UTC"))


def as_of(value=None) -> Column:
    """A fixed run time, or the clock when none is given."""
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")
