"""Describing a table: missing values, summaries, counts and means per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import decade, nan_to_null
from .quantiles import SKETCH, around, exact_quantiles, numbers
from .quantiles import clamped as values_of
from .sketches import quantile_at

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns or df.columns])


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column.

    The table is scanned once for the moments and a sketch, once to count around the
    sketch's quartiles, and then only as often as many rows are left there; what reaches the
    driver is one row per column and the quartiles' buckets.  NaN is missing; infinities are
    numbers, and deviations from an infinite mean are not.
    """
    values = numbers(df, columns)
    probabilities = list(QUARTILES.values())
    measures = []
    for name in columns:
        number = nan_to_null(F.col(name).cast("double"))
        clamped = values_of(name)
        sketch = F.kll_sketch_agg_double(clamped, SKETCH)
        measures.append(
            F.struct(
                F.count(number).alias("count"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("stddev"),
                F.min(number).alias("min"),
                F.max(number).alias("max"),
                F.min(clamped).alias("least"),
                F.max(clamped).alias("most"),
                sketch.alias("sketch"),
            ).alias(name)
        )
    cuts = [
        F.array(
            *(
                quantile_at(F.col(f"{name}.sketch"), F.col(f"{name}.count"), F.lit(p))
                for p in around(probabilities)
            )
        )
        for name in columns
    ]
    whole = df.agg(*measures)
    moments = whole.select(
        *(F.col(name).dropFields("sketch").withField("cuts", cut).alias(name) for name, cut in zip(columns, cuts))
    ).first()
    extent = {n: (moments[n]["count"], moments[n]["least"], moments[n]["most"]) for n in columns}
    brackets = {n: moments[n]["cuts"] for n in columns}
    quartiles = exact_quantiles(values, extent, probabilities, brackets)
    rows = []
    for name in columns:
        m = moments[name]
        rows.append(
            (name, m["count"], m["mean"], m["stddev"], m["min"], *quartiles[name], m["max"])
        )
    schema = (
        "column_name STRING, count BIGINT, mean DOUBLE, stddev DOUBLE, min DOUBLE, "
        "p25 DOUBLE, p50 DOUBLE, p75 DOUBLE, max DOUBLE"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per distinct value."""
    return df.groupBy(column).agg(F.count("*").alias("count"))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The k most frequent values of each column, all columns in one pass.

    Ties go to the smaller value.  The rank filter is applied per task before the last
    shuffle, so a column with very many values does not end up whole in one task.
    """
    cells = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))
        for name in columns
    ]
    counted = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell.column_name", "cell.value")
        .agg(F.count("*").alias("count"))
    )
    order = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def filter_counts(df: DataFrame, condition: Column) -> DataFrame:
    """Rows before and after a filter, in one pass."""
    return df.agg(F.count("*").alias("rows_before"), F.count_if(condition).alias("rows_after"))


def group_means(
    df: DataFrame, keys: Sequence[str | Column], means: Mapping[str, str]
) -> DataFrame:
    """Mean per group of each column of ``means`` (result name -> column)."""
    return df.groupBy(*keys).agg(*[F.avg(name).alias(out) for out, name in means.items()])


def decade_profile(df: DataFrame, *, year: str, use: str, value: str, size: str) -> DataFrame:
    """Mean value, mean size and rows per decade and use."""
    return df.groupBy(decade(F.col(year)).alias("decade"), use).agg(
        F.avg(value).alias("mean_value"),
        F.avg(size).alias("mean_size"),
        F.count("*").alias("rows"),
    )


def month_means(df: DataFrame, *, ts: str, value: str, mean: str = "month_mean") -> DataFrame:
    """Mean value per calendar month, at most twelve rows and one for missing times."""
    return df.groupBy(F.month(ts).alias("month")).agg(F.avg(value).alias(mean))


def ranked(df: DataFrame, by: str, k: int, *, descending: bool = True, tie: str) -> DataFrame:
    """The k rows with the largest (or smallest) ``by``; ``tie`` settles equal ones."""
    first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return df.orderBy(first, F.asc(tie)).limit(k)


def preview(df: DataFrame, k: int = 20) -> DataFrame:
    """Any k rows."""
    return df.limit(k)
