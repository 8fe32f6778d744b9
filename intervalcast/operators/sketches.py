"""Quantiles of any range of days from small sketches, kept once per period.

A sketch (KLL) holds about three times ``k`` numbers however many it has seen, and sketches
of periods, keys or stream batches merge into that of their union.  So a year of readings is
sketched once, and any quantile of any of its ranges is a merge of stored rows.  A quantile
errs by ``rank_error(k)`` in rank, with 99 percent certainty.  Nulls and NaN are not seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seconds_between

K = 4096


def rank_error(k: int = K) -> float:
    """The error of one quantile as the sketch's authors have fitted it."""
    return 2.296 / k**0.9021


def sketches(
    df: DataFrame,
    columns: Sequence[str],
    *,
    ts: str | None = None,
    period: str = "1 day",
    by: Sequence[str] = (),
    k: int = K,
) -> DataFrame:
    """(period_start, ``by``, column_name, n, sketch): a row per period, key and column.

    One grouped aggregate, all columns at once, on a table or, with state of a row per open
    period and key, on a stream.  Without ``ts`` there is one period and no period_start.
    """
    keys = [F.window(ts, period).alias("_period")] if ts else []
    each = [F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"_{i}") for i, c in enumerate(columns)]
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("sketch")) for i, c in enumerate(columns)]
    start = [F.col("_period.start").alias("period_start")] if ts else []
    rows = df.groupBy(*keys, *by).agg(*each).select(*start, *by, F.inline(F.array(*cells)))
    return rows.withColumn("n", F.kll_sketch_get_n_double("sketch"))


def merged(rows: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One sketch per column and key of all the rows."""
    whole = rows.groupBy(*by, "column_name").agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return whole.withColumn("n", F.kll_sketch_get_n_double("sketch"))


def quantile_at(sketch: Column | str, n: Column | str, probability: Column) -> Column:
    """Null for an empty sketch."""
    n = F.col(n) if isinstance(n, str) else n
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, probability))


def quantiles(rows: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """A row per sketch and probability: p and value in place of the sketch."""
    points = [
        F.struct(F.lit(float(p)).alias("p"), quantile_at("sketch", "n", F.lit(float(p))).alias("value"))
        for p in probabilities
    ]
    rest = [name for name in rows.columns if name != "sketch"]
    return rows.select(*rest, F.inline(F.array(*points)))


def lag_sketches(
    records: DataFrame,
    *,
    event_time: str,
    arrival: str,
    period: str = "1 day",
    by: Sequence[str] = (),
    k: int = K,
) -> DataFrame:
    """Sketches of the seconds from observation to arrival, per period of observation."""
    lagged = records.withColumn("lag_seconds", seconds_between(F.col(arrival), F.col(event_time)))
    return sketches(lagged, ["lag_seconds"], ts=event_time, period=period, by=by, k=k)
