"""Metrics of a prediction: each event is predicted by the mean of its type."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.accuracy import METRICS, regression_metrics
from ..operators.enrich import attach
from .registry import query, rounded, table


def predictions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    means = events.groupBy("event_type").agg(F.avg("value").alias("prediction"))
    return attach(events, means, ["event_type"])


def _metrics_sql(by: str) -> str:
    head = f"{by}, " if by else ""
    return f"""
      WITH p AS (SELECT *, avg(value) OVER (PARTITION BY event_type) AS p FROM events)
      SELECT {head}count(*) AS rows, CAST(0 AS BIGINT) AS skipped,
             round(sqrt(avg((p - value) ** 2)), 6) + 0.0 AS rmse,
             round(avg(abs(p - value)), 6) + 0.0 AS mae,
             round(1 - sum((p - value) ** 2) / nullif(var_pop(value) * count(*), 0), 6) + 0.0 AS r2,
             round(sqrt(avg((ln(1 + greatest(p, 0)) - ln(1 + greatest(value, 0))) ** 2)), 6) + 0.0 AS rmsle
      FROM p {f"GROUP BY {by}" if by else ""}"""


@query(_metrics_sql(""))
def accuracy(spark, sf_dir):
    scores = regression_metrics(predictions(spark, sf_dir), "value")
    return rounded(scores, **dict.fromkeys(METRICS, 6))


@query(_metrics_sql("user_id"))
def accuracy_by_entity(spark, sf_dir):
    """One pass for the scores of every entity."""
    scores = regression_metrics(predictions(spark, sf_dir), "value", by=["user_id"])
    return rounded(scores, **dict.fromkeys(METRICS, 6))
