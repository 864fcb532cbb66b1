"""Dates and times. Timestamps are without zone; differences count boundaries that are crossed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"days": "DAY", "hours": "HOUR", "minutes": "MINUTE", "seconds": "SECOND", "milliseconds": "MILLISECOND", "microseconds": "MICROSECOND", "nanoseconds": "NANOSECOND"}


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def part(x: Column, name: str) -> Column:
    """year, month, day, hour, minute, second, dayofyear."""
    return getattr(F, name if name != "day" else "dayofmonth")(x).cast("int")


def millisecond(x: Column) -> Column:
    """The milliseconds within the second."""
    return (F.floor(F.unix_micros(x.cast("timestamp")) / 1000) % 1000).cast("int")


def millisecond_in_minute(x: Column) -> Column:
    """Seconds and milliseconds together, as the engine's own function has it."""
    return F.pmod(F.floor(F.unix_micros(x.cast("timestamp")) / 1000), F.lit(60_000)).cast("int")


def midnight(x: Column) -> Column:
    return x.cast("date").cast("timestamp_ntz")


def day_of_week(x: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(x) - 1


def day_number(x: Column) -> Column:
    """Days since 0001-01-01."""
    return F.datediff(x, F.lit("0001-01-01").cast("date"))


def add_years(x: Column, n) -> Column:
    return x + F.make_ym_interval(_c(n), F.lit(0))


def add_months(x: Column, n) -> Column:
    return x + F.make_ym_interval(F.lit(0), _c(n))


def add_days(x: Column, n, whole: bool = False) -> Column:
    """Fractions of days count for timestamps; dates take whole days and stay dates."""
    return F.date_add(x, _c(n)) if whole else x + _c(n) * F.expr("INTERVAL '1' DAY")


def diff(unit: str, a: Column, b: Column) -> Column:
    """a - b in whole boundaries of the unit, as a double."""
    u = _UNITS[unit]
    if u in ("MILLISECOND", "MICROSECOND", "NANOSECOND"):
        scale = 1000 if u == "MILLISECOND" else 1
        x, y = (F.floor(F.unix_micros(z.cast("timestamp")) / scale) for z in (a, b))
        return ((x - y) * (1000 if u == "NANOSECOND" else 1)).cast("double")
    x, y = (F.date_trunc(u, z.cast("timestamp")) for z in (a, b))
    return F.timestamp_diff(u, y, x).cast("double")


def bucket(x: Column, granularity: str) -> Column:
    """The first day of the year or month, or the day, as a date."""
    day = x.cast("date")
    return day if granularity == "day" else F.trunc(day, {"year": "YYYY", "month": "MM"}[granularity])


def time_micros(x: Column) -> Column:
    """Microseconds since midnight: how times of day are kept."""
    return F.pmod(F.unix_micros(x.cast("timestamp")), F.lit(86_400_000_000))


def span_part(micros: Column, name: str) -> Column:
    """hours (within the day), minutes, seconds, milliseconds or microseconds (within the next larger unit) of a span kept in microseconds."""
    size, within = {"hours": (3_600_000_000, 24), "minutes": (60_000_000, 60), "seconds": (1_000_000, 60), "milliseconds": (1000, 1000), "microseconds": (1, 1000)}[name]
    return (F.floor(micros / size) % within).cast("int")


# -- instants with an offset --------------------------------------------------------------------------------------------
def instant(local: Column, offset_minutes) -> Column:
    """The instant (a timestamp) of a local time without zone at an offset from UTC."""
    utc = local - F.make_dt_interval(F.lit(0), F.lit(0), _c(offset_minutes).cast("int"))
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")


def utc(x: Column) -> Column:
    """The local time in UTC of an instant, whatever the session's zone."""
    seconds = F.unix_micros(x).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def offset_part(x: Column, name: str) -> Column:
    """year, month, day, hour, minute, second or dayofyear of an instant, in UTC as instants are stored."""
    return part(utc(x), name)
