"""Time parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tried in order after Spark's own ISO-like parsing.
DEFAULT_TIME_FORMATS = (
    "yyyy/M/d H:mm:ss",
    "yyyy/M/d H:mm",
    "yyyy/M/d",
    "yyyy-M-d H:mm:ss",
    "yyyy-M-d H:mm",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "d MMM yyyy H:mm:ss",
    "d MMM yyyy",
    "MMM d, yyyy H:mm:ss",
    "MMM d, yyyy",
    "yyyy年M月d日 H:mm:ss",
    "yyyy年M月d日",
)

MICROS_PER_DAY = 86400 * 1_000_000
ONE_HOUR_IN_DAYS = 1 / 24


def parse_time(text: Column, formats: tuple[str, ...] | None = None) -> Column:
    """Timestamp of a text in any of the given formats, null if none fits."""
    clean = F.trim(text)
    # A bare year or digit string would be read as a year by the ISO parser.
    iso = F.when(~clean.rlike(r"^\d+$"), F.try_to_timestamp(clean))
    tries = [F.try_to_timestamp(clean, F.lit(f)) for f in (formats or DEFAULT_TIME_FORMATS)]
    return F.coalesce(iso, *tries)


def parse_time_strict(text: Column, formats: tuple[str, ...] | None = None) -> Column:
    """Like :func:`parse_time`, but text that fits no format fails the query."""
    parsed = parse_time(text, formats)
    message = F.concat(F.lit("not a time: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def hour(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def is_weekend(ts: Column) -> Column:
    return _flag(F.weekday(ts) >= 5)


def is_work_time(ts: Column) -> Column:
    """From 9:00 up to 17:59, on any day."""
    return _flag(F.hour(ts).between(9, 17))


def is_night(ts: Column) -> Column:
    return _flag((F.hour(ts) >= 22) | (F.hour(ts) < 6))


def days_between(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``; exactly zero becomes one hour."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.when(micros == 0, F.lit(ONE_HOUR_IN_DAYS)).otherwise(micros / F.lit(float(MICROS_PER_DAY)))
