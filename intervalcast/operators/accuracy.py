"""Regression metrics in one pass over the predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ["rmse", "mae", "r2", "rmsle"]


def _log_positive(value: Column) -> Column:
    return F.log1p(F.greatest(value, F.lit(0.0)))


def regression_metrics(
    predictions: DataFrame,
    label: str,
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """rmse, mae, r2 and rmsle, for all rows or per group, in a single aggregate.

    A row without label or prediction has no error and is left out of the scores;
    ``skipped`` counts such rows.  Negative values count as zero in rmsle.
    """
    usable = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    y = F.when(usable, F.col(label))
    error = F.when(usable, F.col(prediction) - F.col(label))
    log_error = F.when(
        usable, _log_positive(F.col(prediction)) - _log_positive(F.col(label))
    )
    rows = F.count_if(usable)
    spread = F.var_pop(y) * rows
    return predictions.groupBy(*by).agg(
        rows.alias("rows"),
        F.count_if(~usable).alias("skipped"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("r2"),
        F.sqrt(F.avg(log_error * log_error)).alias("rmsle"),
    )


def rmsle(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    return float(regression_metrics(predictions, label, prediction).first()["rmsle"])


def scores(predictions: DataFrame, label: str, prediction: str = "prediction") -> dict[str, float]:
    """The four scores as numbers."""
    row = regression_metrics(predictions, label, prediction).first()
    return {name: None if row[name] is None else float(row[name]) for name in METRICS}


def evaluator_scores(
    predictions: DataFrame, label: str, prediction: str = "prediction"
) -> dict[str, float]:
    """rmse, mae and r2 by Spark ML's evaluator: a pass each, as a cross-check."""
    evaluator = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    return {
        name: float(evaluator.setMetricName(name).evaluate(predictions))
        for name in ("rmse", "mae", "r2")
    }
