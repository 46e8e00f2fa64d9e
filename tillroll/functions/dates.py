"""Date/time helpers (F1-F9) on TIMESTAMP_NTZ and DATE values.

Only zone-free operations are used: field extraction, casts between NTZ,
DATE and STRING, and NTZ interval arithmetic.  ``date_format`` and
``timestampdiff`` are avoided because they pass through the session time
zone (a wall time inside a daylight-saving gap would move by an hour).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_key(ts) -> Column:
    """``yyyy-MM`` month key."""
    return F.substring(_c(ts).cast("string"), 1, 7)


def day(ts) -> Column:
    """truncate to the calendar day."""
    return F.to_date(_c(ts))


def next_midnight(ts) -> Column:
    """SQL form ``DATE(ts, '+1 day')`` as a midnight timestamp."""
    return F.date_add(F.to_date(_c(ts)), 1).cast("timestamp_ntz")


def plus_one_day(ts) -> Column:
    """pipeline form, time of day kept."""
    return _c(ts) + F.expr("INTERVAL 1 DAY")


def elapsed_days(start, end) -> Column:
    """whole elapsed 24-hour periods from ``start`` to ``end`` (end >= start).

    Calendar-day difference, minus one when the end's time of day is earlier
    than the start's.  Everything stays in TIMESTAMP_NTZ/DATE arithmetic, so
    no session time zone (and no daylight-saving shift) is involved.
    """
    s, e = _c(start), _c(end)
    return (F.datediff(F.to_date(e), F.to_date(s)).cast("bigint")
            - F.when(time_of_day(e) < time_of_day(s), 1).otherwise(0))


def time_of_day(ts) -> Column:
    """Interval since midnight of an NTZ timestamp (exact, zone-free)."""
    c = _c(ts)
    return c - F.to_date(c).cast("timestamp_ntz")


def weekday(d) -> Column:
    """day of week with Monday = 0."""
    return F.weekday(_c(d))


def ts_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp (fraction dropped)."""
    return F.substring(_c(ts).cast("timestamp_ntz").cast("string"), 1, 19)


def date_text(d) -> Column:
    """``yyyy-MM-dd`` text of a date."""
    return _c(d).cast("date").cast("string")
