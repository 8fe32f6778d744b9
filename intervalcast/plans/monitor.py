"""Monitoring: usable records of the predictions topic, the quarantine, and the metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.monitor import merge_snapshots, screen, snapshot
from ..sources.sinks import paced


KEPT = 8  # versions of the metrics


def usable(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col("reject").isNull()).drop("reject")


def rejected(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col("reject").isNotNull()).select("key", "value", "reject")


def start_snapshots(
    messages: DataFrame,
    *,
    quarantine: str,
    metrics: str,
    checkpoint: str,
    every: str | None = None,
    now: Column | None = None,
) -> StreamingQuery:
    """Keep the metrics of everything received so far, one version per batch.

    A version is the one before it merged with the batch's own metrics, so the work grows
    with the batch, not with the past.  Rejects are written under the batch number, the last
    KEPT versions under the batch number's remainder: a repeated batch replaces its own.
    Gauges take the record with the largest ``arrival``, as ``Bus.subscribe`` gives it;
    messages must have that column.  ``now`` is what lags are measured against.
    """

    def fold(batch: DataFrame, number: int) -> None:
        screened = screen(batch).persist()
        try:
            rejected(screened).write.mode("overwrite").parquet(version(quarantine, number))
            current = snapshot(usable(screened), now=now)
            if number > 0:
                before = batch.sparkSession.read.parquet(version(metrics, (number - 1) % KEPT))
                current = merge_snapshots(before.drop("version"), current)
            numbered = current.withColumn("version", F.lit(number).cast("bigint"))
            numbered.write.mode("overwrite").parquet(version(metrics, number % KEPT))
        finally:
            screened.unpersist()

    writer = messages.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return paced(writer, every).start()


def version(path: str, number: int) -> str:
    return f"{path}/batch={number}"


def latest_version(spark: SparkSession, metrics: str, number: int | None = None) -> DataFrame:
    """The newest metrics table; with the batch ``number`` known, without looking for it."""
    if number is not None:
        return spark.read.parquet(version(metrics, number % KEPT)).drop("version")
    versions = spark.read.parquet(metrics).drop("batch")
    newest = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == newest).drop("version")
