"""Stream sinks.  Each needs a checkpoint folder of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def paced(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Work off what is there and stop, or run on at the given pace."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def append_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Final rows to Parquet, exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return paced(writer, every).start()


def overwrite_parquet(
    stream: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """The whole result of a complete-mode aggregate, replaced at every trigger."""

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = (
        stream.writeStream.foreachBatch(replace)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
    )
    return paced(writer, every).start()


def memory_table(
    stream: DataFrame,
    name: str,
    *,
    mode: str = "append",
    checkpoint: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """A table of this session to look at results, queried with ``spark.sql``.

    Its rows are kept on the driver: use it for totals with a known number of rows.
    """
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return paced(writer, every).start()
