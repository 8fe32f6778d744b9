"""Window totals that keep what came too late.

A row is late when its window has closed: when the window's end is at or before the
watermark, which trails the newest time of all batches before by the delay.  Late rows go to
a side output with the window they missed, and into a table of corrections; the totals of
closed windows never change.  Totals plus corrections are the totals of all rows.

Everything lies below one folder: ``totals`` and ``corrections`` (see ``sources.upsert``),
``late`` with a folder per batch, ``marks`` with the newest time of each batch.  A batch that
is run again writes the same: all parts go by its number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import paced
from ..sources.tables import ensure_folder
from ..sources.upsert import read_upserted, upsert

MARK = "newest TIMESTAMP, batch BIGINT"


def watermark_before(spark: SparkSession, path: str, number: int, delay: str):
    """Newest time of the batches before ``number``, less the delay; None without any."""
    try:
        marks = spark.read.schema(MARK).parquet(f"{path}/marks")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    before = marks.filter(F.col("batch") < number).agg(F.max("newest").alias("newest"))
    return before.select(F.col("newest") - F.expr(f"INTERVAL {delay}")).first()[0]


def _summed(rows: DataFrame, keys: Sequence[str], value: str, total: str) -> DataFrame:
    return rows.groupBy("window", *keys).agg(F.sum(value).alias(total), F.count("*").alias("records"))


def start_corrected_totals(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    ts: str,
    delay: str,
    length: str,
    keys: Sequence[str],
    value: str,
    total: str,
    buckets: int = 64,
    every: str | None = None,
) -> StreamingQuery:
    """Totals per window and key of a stream of rows, and what missed its window.

    Rows without a time belong to no window.  ``stream`` needs no watermark of its own, and
    no state is held: a batch adds its sums to the stored ones.
    """

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = watermark_before(spark, path, number, delay)
        timed = batch.withColumn(ts, F.col(ts).cast("timestamp")).filter(F.col(ts).isNotNull())
        placed = timed.withColumn("window", F.window(ts, length)).persist()
        try:
            is_late = F.lit(False) if mark is None else F.col("window.end") <= F.lit(mark)
            late = placed.filter(is_late).withColumn("watermark", F.lit(mark).cast("timestamp"))
            late.write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            for name, rows in (("totals", placed.filter(~is_late)), ("corrections", late)):
                sums = _summed(rows, keys, value, total)
                upsert(
                    sums,
                    f"{path}/{name}",
                    number,
                    keys=["window", *keys],
                    buckets=buckets,
                    add=[total, "records"],
                )
            newest = placed.agg(F.max(ts).alias("newest")).withColumn("batch", F.lit(number).cast("bigint"))
            newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/number={number}")
        finally:
            placed.unpersist()

    ensure_folder(stream.sparkSession, path)
    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return paced(writer, every).start()


def total_schema(stream: DataFrame, ts: str, keys: Sequence[str], total: str) -> T.StructType:
    window = T.StructType().add("start", T.TimestampType()).add("end", T.TimestampType())
    schema = T.StructType().add("window", window)
    for name in keys:
        schema = schema.add(stream.schema[name])
    return schema.add(total, T.DoubleType()).add("records", T.LongType())


def corrected(
    spark: SparkSession, path: str, schema: T.StructType, *, keys: Sequence[str], total: str
) -> DataFrame:
    """Totals with their corrections added; ``late_`` columns say how much of them that is."""
    parts = []
    for name, share in (("totals", 0), ("corrections", 1)):
        rows = read_upserted(spark, f"{path}/{name}", schema)
        late = {f"late_{c}": F.col(c) * share for c in (total, "records")}
        parts.append(rows.withColumns(late))
    names = [c for name in (total, "records") for c in (name, f"late_{name}")]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("window", *keys).agg(*[F.sum(name).alias(name) for name in names])


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that missed their window, with it and the watermark they were behind."""
    return spark.read.option("mergeSchema", True).parquet(f"{path}/late")
