"""Epochs, local time, day keys and minute differences.

All results are zone-less timestamps, so they do not depend on the session's
time zone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOCAL_ZONE = "America/Lima"
MAX_EPOCH_SECONDS = 4102444800
MILLIS_FROM = 100_000_000_000

_ORIGIN = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(c: Column, unit: str = "s") -> Column:
    """Whole seconds from an epoch given in ``s``, ``ms`` or ``auto``."""
    whole = c.cast("bigint")
    if unit == "s":
        return whole
    if unit == "ms":
        return F.floor(whole / 1000)
    if unit == "auto":
        return F.when(F.abs(whole) >= MILLIS_FROM, F.floor(whole / 1000)).otherwise(whole)
    raise ValueError(f"unknown epoch unit: {unit}")


def epoch_to_utc(c: Column, unit: str = "s") -> Column:
    return F.timestamp_add("SECOND", epoch_seconds(c, unit), F.expr(_ORIGIN))


def epoch_to_local(c: Column, unit: str = "s", zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), epoch_to_utc(c, unit))


def epoch_in_range(c: Column) -> Column:
    return c.isNull() | c.between(0, MAX_EPOCH_SECONDS)


def to_epoch(c: Column) -> Column:
    """Seconds since 1970 of a zone-less time, rounded down.

    Built from the parts of the time: a difference of timestamps would go
    through the session's zone and shift around changes of daylight time.
    """
    wall = c.cast("timestamp_ntz")
    days = F.unix_date(wall.cast("date")).cast("bigint")
    return days * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def to_micros(c: Column) -> Column:
    """Microseconds since 1970 of a zone-less time."""
    wall = c.cast("timestamp_ntz")
    fraction = F.date_part(F.lit("SECOND"), wall) - F.second(wall)
    return to_epoch(c) * 1_000_000 + (fraction * 1_000_000).cast("bigint")


def utc_instant(c: Column) -> Column:
    """The instant at which a UTC clock showed the zone-less time ``c``, in whole seconds."""
    return F.timestamp_seconds(to_epoch(c))


def utc_now() -> Column:
    """Arrival time as a UTC clock shows it. Only the stream landing asks for it; other jobs are given their time."""
    wall = F.current_timestamp().cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall)


def local_bounds(day_from: str, day_to: str, zone_offset_hours: int = -5) -> tuple[int, int]:
    """Epoch bounds ``[lo, hi)`` of whole local days.

    Comparing the raw epoch column with these numbers lets the scan prune by
    statistics, which comparing formatted local days would prevent.
    """
    from datetime import date, timedelta

    base = date(1970, 1, 1)
    shift = -zone_offset_hours * 3600
    lo = (date.fromisoformat(day_from) - base).days * 86400 + shift
    hi = (date.fromisoformat(day_to) + timedelta(days=1) - base).days * 86400 + shift
    return lo, hi


def day_key(c: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_key(c: Column) -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def closed_months(as_of: date, months: int) -> tuple[date, date]:
    """First day of the closed months before the one of ``as_of``, and the first day after them."""
    end = as_of.replace(day=1)
    year, month = divmod(end.year * 12 + end.month - 1 - months, 12)
    return date(year, month + 1, 1), end


def clock_label(c: Column) -> Column:
    return F.date_format(c, "HH:mm")


def minute_boundaries(start: Column, end: Column) -> Column:
    """How many minute marks lie between two times, signed."""
    return (F.floor(to_epoch(end) / 60) - F.floor(to_epoch(start) / 60)).cast("bigint")


def hours_dot_minutes(minutes: Column) -> Column:
    """Display form ``H.MM`` of a number of minutes."""
    whole = F.abs(minutes.cast("bigint"))
    return F.concat(F.floor(whole / 60).cast("string"), F.lit("."), F.lpad((whole % 60).cast("string"), 2, "0"))


def iso_to_utc(c: Column) -> Column:
    """ISO text with or without an offset to ISO text in UTC; bad text is null."""
    text = F.regexp_replace(F.trim(c), "Z$", "+00:00")
    offset = F.regexp_extract(text, "([+-])(\\d{2}):?(\\d{2})$", 0)
    sign = F.when(offset.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    hours = F.regexp_extract(text, "([+-])(\\d{2}):?(\\d{2})$", 2).try_cast("int")
    minutes = F.regexp_extract(text, "([+-])(\\d{2}):?(\\d{2})$", 3).try_cast("int")
    has_offset = text.rlike("T?\\d{2}:\\d{2}(:\\d{2}(\\.\\d+)?)?[+-]\\d{2}:?\\d{2}$")
    naive = F.when(has_offset, F.regexp_replace(text, "[+-]\\d{2}:?\\d{2}$", "")).otherwise(text)
    shift = F.when(has_offset, sign * (hours * 60 + minutes)).otherwise(F.lit(0))
    utc = F.timestamp_add("MINUTE", -shift, naive.try_cast("timestamp_ntz"))
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
