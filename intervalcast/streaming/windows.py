"""Event time and tumbling totals.

``window_totals`` is written once for both kinds of input: on a batch it is a grouped
aggregate, on a watermarked stream a stateful one whose state is a row per open window
and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import local_wall_clock


def with_event_time(
    df: DataFrame, ts: str, delay: str | None = None, *, zone: str | None = None
) -> DataFrame:
    """Make ``ts`` the event time, with a watermark that trails it by ``delay``.

    Watermarks need TIMESTAMP; a column without zone is read in the session's.  With
    ``zone`` the clock time there is added as ``local_time`` and carries the watermark, so
    that windows on it are local intervals and days.
    """
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if zone:
        df = df.withColumn("local_time", local_wall_clock(F.col(ts), zone))
    return df.withWatermark("local_time" if zone else ts, delay) if delay else df


def window_totals(
    scored: DataFrame,
    *,
    ts: str,
    length: str,
    keys: Sequence[str],
    value: str,
    total: str,
    how: str = "sum",
) -> DataFrame:
    """Total (or ``avg``) of ``value`` per tumbling window and key.

    The sum adds up forecasts that may each cover a whole window already, one per event;
    ``avg`` gives their mean in that case.  Rows without a time belong to no window.
    """
    combine = {"sum": F.sum, "avg": F.avg}[how]
    return scored.groupBy(F.window(ts, length), *keys).agg(combine(value).alias(total))


def window_means(
    conditions: DataFrame, *, ts: str, length: str, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Mean conditions per window, named by the window start as ``ts`` again.

    Scoring these gives one forecast per window and entity instead of one per event.
    """
    means = [F.avg(name).alias(name) for name in values]
    grouped = conditions.groupBy(F.window(ts, length), *keys).agg(*means)
    return grouped.withColumn(ts, F.col("window.start")).drop("window")


def flat_window(totals: DataFrame) -> DataFrame:
    """The window struct as two columns without zone, window_start and window_end."""
    rest = [name for name in totals.columns if name != "window"]
    return totals.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )
