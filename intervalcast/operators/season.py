"""Peak and off-peak months by mean value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import month_means, ranked

PEAK, OFF_PEAK = "peak", "off-peak"


def peak_months(df: DataFrame, *, ts: str, value: str, k: int = 3) -> DataFrame:
    """The k months with the highest and the k with the lowest mean: at most 2k rows.

    A month without any value is neither.
    """
    means = month_means(df, ts=ts, value=value).filter(
        F.col("month").isNotNull() & F.col("month_mean").isNotNull()
    )
    highest = ranked(means, "month_mean", k, tie="month")
    lowest = ranked(means, "month_mean", k, descending=False, tie="month")
    return highest.union(lowest).select("month").distinct()


def label_season(
    df: DataFrame, peaks: DataFrame, *, ts: str, name: str = "season"
) -> DataFrame:
    """Adds ``peak`` or ``off-peak`` by the month of ``ts``.

    ``peaks`` holds distinct months, so it never has more than twelve rows and can be
    broadcast.
    """
    months = peaks.select(F.col("month").alias("_peak_month"))
    label = F.when(F.col("_peak_month").isNotNull(), F.lit(PEAK)).otherwise(F.lit(OFF_PEAK))
    joined = df.join(F.broadcast(months), F.month(ts) == F.col("_peak_month"), "left")
    return joined.withColumn(name, label).drop("_peak_month")
