"""Derived feature columns, the same for training and serving.

Each function adds columns that depend on their own row only, so it may be applied to a
batch or a stream and gives the same values on both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cyclic, decade, interval_index, log_size


def add_interval_features(df: DataFrame, ts: str, hours: int = 6) -> DataFrame:
    """Month, interval number and their positions on the year's and the day's circle."""
    index = interval_index(F.col(ts), hours)
    month = F.month(ts)
    time_sin, time_cos = cyclic(index, 24 // hours)
    month_sin, month_cos = cyclic(month, 12)
    return df.withColumns(
        {
            "month": month,
            "time_interval_num": index,
            "time_sin": time_sin,
            "time_cos": time_cos,
            "month_sin": month_sin,
            "month_cos": month_cos,
        }
    )


def add_size_features(
    df: DataFrame,
    *,
    size: str,
    year: str,
    log_name: str = "log_square_feet",
    decade_name: str = "decade",
) -> DataFrame:
    """Log of the size and decade of the year."""
    return df.withColumns({log_name: log_size(F.col(size)), decade_name: decade(F.col(year))})


def add_angle_features(df: DataFrame, angle: str, prefix: str) -> DataFrame:
    """Sine and cosine of an angle in degrees."""
    sine, cosine = cyclic(F.col(angle), 360)
    return df.withColumns({f"{prefix}_sin": sine, f"{prefix}_cos": cosine})
