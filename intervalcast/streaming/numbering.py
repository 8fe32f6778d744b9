"""Numbers handed out to the rows of a stream, without gaps and without repeats.

Inside a micro-batch rows are numbered in the order asked for, by ranges (see
``operators.messages.with_position``); a batch begins where the ones before have ended.
That high-water mark is not a counter but a table of sizes, one row per batch: a batch that
is run again finds the same batches before it, writes over its own rows, and hands out the
same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.messages import ROWS_PER_MESSAGE, to_messages, with_position
from ..sources.bus import Bus
from ..sources.sinks import paced
from ..sources.tables import ensure_folder

SIZE = "batch BIGINT, size BIGINT"


def high_water(spark: SparkSession, path: str, number: int) -> int:
    """How many numbers the batches before ``number`` have taken."""
    try:
        sizes = spark.read.schema(SIZE).parquet(f"{path}/sizes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return sizes.filter(F.col("batch") < number).agg(F.sum("size")).first()[0] or 0


def _note(rows: DataFrame, path: str, number: int) -> None:
    size = rows.agg(F.lit(number).cast("bigint").alias("batch"), F.count("*").alias("size"))
    size.coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes/number={number}")


def start_numbering(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    order_by: Sequence[str],
    name: str = "position",
    every: str | None = None,
) -> StreamingQuery:
    """The rows with their number, in a folder per batch below ``rows``.

    ``order_by`` should end in a column that is unique inside a batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        begin = high_water(spark, path, number)
        numbered = with_position(batch, order_by, name).withColumn(name, F.col(name) + begin)
        numbered.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        _note(spark.read.parquet(f"{path}/rows/batch={number}"), path, number)

    ensure_folder(stream.sparkSession, path)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return paced(writer, every).start()


def numbered_rows(spark: SparkSession, path: str, schema: T.StructType, name: str = "position") -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(name, T.LongType())])
    return spark.read.schema(whole).parquet(f"{path}/rows").select(*whole.names)


def start_messages(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    order_by: Sequence[str],
    fields: Sequence[str],
    rows_per_message: int = ROWS_PER_MESSAGE,
    every: str | None = None,
) -> StreamingQuery:
    """The stream as batched messages, numbered on from batch to batch.

    Messages are cut per micro-batch: the last one of a batch may be shorter.  Read them with
    ``messages_of``, or send them on with ``Bus.send``.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        begin = high_water(spark, path, number)
        made = to_messages(batch, order_by=order_by, fields=fields, rows_per_message=rows_per_message)
        made = made.withColumn("message_no", F.col("message_no") + begin)
        made.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        _note(spark.read.parquet(f"{path}/rows/batch={number}"), path, number)

    ensure_folder(stream.sparkSession, path)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return paced(writer, every).start()


def messages_of(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("message_no BIGINT, value STRING").parquet(f"{path}/rows")
    return rows.select("message_no", "value")


def send_messages(spark: SparkSession, path: str, bus: Bus, topic: str) -> None:
    """All messages to a topic, keyed by their number."""
    rows = messages_of(spark, path)
    bus.send(rows.select(F.col("message_no").cast("string").alias("key"), "value"), topic)
