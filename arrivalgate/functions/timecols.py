"""Column functions on dates, clock times and evaluation-time windows.

All timestamps are TIMESTAMP_NTZ: the reference mixes UTC and local clocks,
so the engine never depends on the session zone. ``now`` is always a Column
(literal or per row), never ``current_timestamp()``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value) -> Column:
    """A zone-less timestamp literal from text or a datetime."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    return F.lit(str(value)).cast("date")


def at_clock(day, clock) -> Column:
    """date + 'HH:mm:ss' text -> TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(F.concat_ws(" ", _c(day).cast("string"), _c(clock)))


def clock_plus_minutes(clock, minutes) -> Column:
    """add minutes to a clock time, keep only the clock (wraps at midnight)."""
    base = F.to_timestamp_ntz(F.concat(F.lit("1900-01-01 "), _c(clock)))
    return F.date_format(base + F.make_dt_interval(F.lit(0), F.lit(0), _c(minutes).cast("int")), "HH:mm:ss")


def window_end(day, clock, minutes, wrap: bool = True) -> Column:
    """End of an expected window. ``wrap=True`` keeps the reference's clock-only
    end on the same date (R1); ``wrap=False`` gives the true end."""
    if wrap:
        return at_clock(day, clock_plus_minutes(clock, minutes))
    return at_clock(day, clock) + F.make_dt_interval(F.lit(0), F.lit(0), _c(minutes).cast("int"))


def first_token(text) -> Column:
    """F16: first whitespace-separated token of a text."""
    return F.split(F.trim(_c(text)), r"\s+").getItem(0)


def minute_of_day(ts) -> Column:
    t = _c(ts)
    return F.hour(t) * 60 + F.minute(t)


def in_window(now, start_hour: int, start_min: int, end_hour: int, end_min: int,
              form: str = "clock") -> Column:
    """Is ``now`` inside a daily window?

    ``clock`` (P16, P18): (hour, minute) between start and end inclusive.
    ``fields`` (P17): hour >= sh AND minute >= sm AND hour <= eh; the end minute
    is ignored, so 07:50-08:10 fails at 08:05 (R8).
    ``fields_strict_end`` (P19): as ``fields`` plus minute < em.
    """
    n = _c(now)
    h, m = F.hour(n), F.minute(n)
    if form == "clock":
        mod = minute_of_day(n)
        return mod.between(start_hour * 60 + start_min, end_hour * 60 + end_min)
    base = (h >= start_hour) & (m >= start_min) & (h <= end_hour)
    if form == "fields":
        return base
    if form == "fields_strict_end":
        return base & (m < end_min)
    raise ValueError(f"unknown window form {form!r}")


def after_cutoff_plus(now, start_hour: int, start_min: int, extra_hour: int, extra_min: int) -> Column:
    """P20: forced start after cutoff + extra time, field form."""
    n = _c(now)
    return (F.hour(n) >= start_hour + extra_hour) & (F.minute(n) >= start_min + extra_min)
