"""A table as a sequence of batched JSON messages, and back.

A message is ``{"batch_ts": ..., "rows": [...]}`` with a fixed number of rows that follow
each other in time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null, parse_row, row_json
from ..sources.scratch import materialise

ROWS_PER_MESSAGE = 120

# monotonically_increasing_id keeps the row number of a partition in the low bits.
_ROW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """Adds the row's place (from 0) in the total order of ``order_by``.

    The rows are range-partitioned and sorted, not brought together: a row's place is its
    place in the partition plus the sizes of the partitions before it.  ``order_by`` should
    end in a unique column, which also lets the ranges split a time that owns very many
    rows.  The sorted rows are written to shared storage, since the sizes and the rows must
    come from the same ranges even if an executor is lost in between.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
            }
        )
    )
    placed = materialise(placed, "position")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_offset") + F.col("_row")).drop(
        "_part", "_row", "_offset"
    )


def _typed(df: DataFrame, name: str) -> Column:
    """A field as it is sent: numbers that are not numbers become null."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.col(name)).alias(name)
    return F.col(name)


def to_messages(
    df: DataFrame,
    *,
    order_by: Sequence[str],
    fields: Sequence[str],
    rows_per_message: int = ROWS_PER_MESSAGE,
    batch_ts: Column | None = None,
) -> DataFrame:
    """Messages (message_no, value) of ``rows_per_message`` rows each, in time order.

    The times in the rows are those of the observations; ``batch_ts`` is when the message
    was made.
    """
    stamp = F.current_timestamp() if batch_ts is None else batch_ts
    row = F.struct(F.col("position"), F.struct(*[_typed(df, name) for name in fields]).alias("row"))
    number = F.floor(F.col("position") / rows_per_message).alias("message_no")
    grouped = (
        with_position(df, order_by)
        .groupBy(number)
        .agg(F.sort_array(F.collect_list(row)).alias("cells"))
    )
    return grouped.select(
        "message_no",
        row_json(stamp.alias("batch_ts"), F.col("cells.row").alias("rows")).alias("value"),
    )


def from_messages(messages: DataFrame, schema: T.StructType, *, extra: Sequence[str] = ()) -> DataFrame:
    """One row per element of the messages' ``rows``; works on a stream as well."""
    parsed = messages.select(*extra, parse_row(F.col("value").cast("string"), schema).alias("message"))
    return parsed.select(*extra, F.explode("message.rows").alias("row")).select(*extra, "row.*")
