"""Running and watching streaming queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "query STRING, batch BIGINT, input_rows BIGINT, dropped_rows BIGINT, state_rows BIGINT, "
    "watermark STRING, active BOOLEAN"
)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()
    return query


def supervise(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Block until all queries have ended; when one fails, stop the others and raise.

    Failures of other queries of the session are not this call's business.
    """
    running = list(queries)
    try:
        while True:
            spark.streams.resetTerminated()
            for query in running:
                if query.exception() is not None:
                    raise query.exception()
            if not any(query.isActive for query in running):
                return
            try:
                spark.streams.awaitAnyTermination()
            except StreamingQueryException:
                pass  # whose it was is seen above
    except BaseException:
        stop_all(running)
        raise


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def progress_table(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """What each recent micro-batch did: rows read, rows too late, rows of state.

    A glance at this session's queries: Spark keeps the last hundred reports of each.
    ``progress.ProgressLog`` keeps all, as a table.
    """
    rows = []
    for query in queries:
        for step in query.recentProgress:
            state = step["stateOperators"]
            rows.append(
                (
                    query.name or str(query.id),
                    step["batchId"],
                    step["numInputRows"],
                    sum(op["numRowsDroppedByWatermark"] for op in state),
                    sum(op["numRowsTotal"] for op in state),
                    dict(step["eventTime"] or {}).get("watermark"),
                    query.isActive,
                )
            )
    return spark.createDataFrame(rows, PROGRESS)
