"""Bounds at n standard deviations, and the range filter that applies them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sigma_bounds(df: DataFrame, label: str, sigma: float = 3.0) -> DataFrame:
    """One row (lo, hi): mean -/+ ``sigma`` sample standard deviations.

    Both are null where the deviation is undefined, that is for fewer than two labels.
    """
    mean, spread = F.avg(label), F.stddev_samp(label)
    return df.agg(
        (mean - F.lit(sigma) * spread).alias("lo"), (mean + F.lit(sigma) * spread).alias("hi")
    )


def bounds_on_driver(bounds: DataFrame) -> tuple[float | None, float | None]:
    """The two numbers of ``sigma_bounds``."""
    row = bounds.first()
    return row["lo"], row["hi"]


def range_filter(df: DataFrame, label: str, lo: float | None, hi: float | None) -> DataFrame:
    """Rows with lo <= label <= hi; everything if a bound is missing."""
    if lo is None or hi is None:
        return df
    return df.filter(F.col(label).between(lo, hi))


def bounds_filter(df: DataFrame, label: str, bounds: DataFrame) -> DataFrame:
    """``range_filter`` with bounds still in a DataFrame, in one lazy plan.

    ``bounds`` is one row by construction, so it is safe to broadcast.
    """
    undefined = F.col("lo").isNull() | F.col("hi").isNull()
    kept = df.crossJoin(F.broadcast(bounds)).filter(
        undefined | F.col(label).between(F.col("lo"), F.col("hi"))
    )
    return kept.drop("lo", "hi")


def sigma_filter(df: DataFrame, label: str, sigma: float = 3.0) -> DataFrame:
    """Drop labels further than ``sigma`` standard deviations from the mean."""
    return bounds_filter(df, label, sigma_bounds(df, label, sigma))
