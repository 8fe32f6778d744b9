"""Irregular readings to one row per key and interval.

Every operator is a plain grouped aggregate: readings are combined on the map side
before the shuffle, so a key that owns a third of the readings sends one partial row
per interval and task, not its readings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar_parts, interval_label, interval_start


def interval_of(df: DataFrame, ts: str, hours: int = 6) -> Column:
    """Interval start of a time column, of the same timestamp type as the column."""
    zoneless = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    return interval_start(F.col(ts), hours, zoneless=zoneless)


def interval_sum(
    readings: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    value: str,
    total: str,
    start: str = "interval_start",
    hours: int = 6,
) -> DataFrame:
    """Total of the readings per key and interval."""
    start_col = interval_of(readings, ts, hours).alias(start)
    return readings.groupBy(*keys, start_col).agg(F.sum(value).alias(total))


def _mean_columns(values: Sequence[str], angles: Sequence[str]) -> list[Column]:
    means = []
    for name in values:
        if name in angles:
            radians = F.radians(name)
            turned = F.degrees(F.atan2(F.avg(F.sin(radians)), F.avg(F.cos(radians))))
            means.append(F.pmod(turned, F.lit(360.0)).alias(name))
        else:
            means.append(F.avg(name).alias(name))
    return means


def interval_mean(
    readings: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    angles: Sequence[str] = (),
    start: str = "interval_start",
    hours: int = 6,
) -> DataFrame:
    """Mean of each value column per key and interval.

    Columns named in ``angles`` are degrees and are averaged on the circle, so 350 and
    10 give 0; otherwise the mean is arithmetic for all.
    """
    start_col = interval_of(readings, ts, hours).alias(start)
    return readings.groupBy(*keys, start_col).agg(*_mean_columns(values, angles))


def _calendar_keys(ts: str, hours: int) -> list[Column]:
    parts: Mapping[str, Column] = calendar_parts(F.col(ts))
    named = [part.alias(name) for name, part in parts.items()]
    return [*named, interval_label(F.col(ts), hours).alias("time_interval")]


def calendar_sum(
    readings: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    value: str,
    total: str,
    hours: int = 6,
) -> DataFrame:
    """``interval_sum`` with year, month, day and a named interval as the time key."""
    return readings.groupBy(*keys, *_calendar_keys(ts, hours)).agg(F.sum(value).alias(total))


def calendar_mean(
    readings: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    angles: Sequence[str] = (),
    hours: int = 6,
) -> DataFrame:
    """``interval_mean`` with year, month, day and a named interval as the time key."""
    grouped = readings.groupBy(*keys, *_calendar_keys(ts, hours))
    return grouped.agg(*_mean_columns(values, angles))
