"""Calendar and interval expressions.

Intervals are cut on the wall clock of the session zone, so a day always has the same
interval starts, also on the days the clock is changed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def _check(hours: int) -> None:
    if hours < 1 or 24 % hours:
        raise ValueError(f"an interval of {hours} hours does not divide the day")


def _floor_hour(ts: Column, hours: int) -> Column:
    return F.hour(ts) - F.hour(ts) % hours


def interval_start(ts: Column, hours: int = 6, *, zoneless: bool = False) -> Column:
    """Start of the interval a time falls in; TIMESTAMP_NTZ if ``ts`` is ``zoneless``.

    A window of whole hours that divide the day, cut on the clock reading, starts at these
    hours of every day.  This is plain arithmetic on the stored number; taking the time
    apart and putting it together again costs several times as much.  A window drops rows
    without a time, so those are given one and lose it again.
    """
    _check(hours)
    clock = ts if zoneless else ts.cast("timestamp_ntz")
    some_time = F.lit("1970-01-01").cast("timestamp_ntz")
    start = F.window(F.coalesce(clock, some_time), f"{hours} hours").start
    kept = F.when(ts.isNotNull(), start)
    return kept if zoneless else kept.cast("timestamp")


def interval_index(ts: Column, hours: int = 6) -> Column:
    """0 for the first interval of the day, 1 for the next, and so on."""
    _check(hours)
    return (_floor_hour(ts, hours) / hours).cast("int")


def interval_labels(hours: int = 6) -> list[str]:
    """Names of the intervals of a day, such as ``6:00-11:59``."""
    _check(hours)
    return [f"{first}:00-{first + hours - 1}:59" for first in range(0, 24, hours)]


def interval_label(ts: Column, hours: int = 6) -> Column:
    """Name of the interval a time falls in; null for a null time."""
    names = F.array(*[F.lit(name) for name in interval_labels(hours)])
    return F.get(names, interval_index(ts, hours))


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}


def local_wall_clock(ts: Column, zone: str) -> Column:
    """Clock reading in ``zone`` as a timestamp, for sessions that run in UTC.

    Windows are cut at multiples of their length from the epoch; cutting them on this
    column gives local intervals and local days.
    """
    return F.from_utc_timestamp(ts, zone)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microsecond precision."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(float(MICROS))
