"""A table of everything streaming queries report, kept beyond the session.

Spark itself remembers the last hundred reports of a query.  ``ProgressLog`` is told of every
start, progress and end and appends them to a Parquet table, so that a query can be looked
at after many batches, after its end, and from another session.

    with ProgressLog(spark, path) as log:
        ... start queries, wait for them ...
    runs(spark, path).show()
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = (
    "event STRING, query STRING, query_id STRING, run_id STRING, at TIMESTAMP, batch BIGINT, "
    "input_rows BIGINT, processed_per_second DOUBLE, batch_ms BIGINT, dropped_rows BIGINT, "
    "state_rows BIGINT, watermark TIMESTAMP, error STRING"
)
_TIMES = ("at", "watermark")
_TEXT = EVENTS.replace("TIMESTAMP", "STRING")


class ProgressLog(StreamingQueryListener):
    """Listens to all queries of the session, or those of the given names.

    Reports are handed to a thread of their own, which writes what has come in since its
    last write as one file: queries do not wait for it.  A report is dropped from memory only
    when it is written.
    """

    def __init__(
        self, spark: SparkSession, path: str, *, names: set[str] | None = None, pause: float = 0.5
    ) -> None:
        self._spark, self._path, self._names, self._pause = spark, path, names, pause
        self._waiting: list[tuple] = []
        self._running: dict[str, str] = {}
        self._changed = threading.Condition()
        self._closed = False
        self._failure: Exception | None = None
        self._writer = threading.Thread(target=self._write, daemon=True)

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        self._writer.start()
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    # What Spark calls.

    def onQueryStarted(self, event) -> None:
        self._report("started", event, name=event.name, at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        self._report(
            "progress",
            p,
            name=p.name,
            at=p.timestamp,
            batch=p.batchId,
            input_rows=p.numInputRows,
            processed_per_second=float(p.processedRowsPerSecond),
            batch_ms=p.durationMs.get("triggerExecution"),
            dropped_rows=sum(op.numRowsDroppedByWatermark for op in state),
            state_rows=sum(op.numRowsTotal for op in state),
            watermark=(p.eventTime or {}).get("watermark"),
        )

    def onQueryIdle(self, event) -> None:
        """Nothing was done."""

    def onQueryTerminated(self, event) -> None:
        now = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        self._report("ended", event, at=now, error=event.exception)

    def _report(self, kind: str, event, *, name: str | None = None, **fields: object) -> None:
        with self._changed:
            run = str(event.runId)
            if kind == "started":
                if self._names is not None and name not in self._names:
                    return
                self._running[run] = name or str(event.id)
            elif run not in self._running:
                return
            row = {"event": kind, "query": self._running[run], "query_id": str(event.id), "run_id": run}
            row |= fields
            self._waiting.append(tuple(row.get(part.split()[0]) for part in _TEXT.split(", ")))
            if kind == "ended":
                del self._running[run]
            self._changed.notify_all()

    # What the writer does.

    def _write(self) -> None:
        failures = 0
        while True:
            with self._changed:
                self._changed.wait_for(lambda: self._waiting or self._closed)
                rows = list(self._waiting)
                if not rows:
                    return
            try:
                table = self._spark.createDataFrame(rows, _TEXT)
                times = {name: F.to_timestamp(name) for name in _TIMES}
                table.withColumns(times).coalesce(1).write.mode("append").parquet(self._path)
            except Exception as failure:  # noqa: BLE001  tried again, and raised to the owner
                failures += 1
                if failures < 3:
                    time.sleep(self._pause)
                    continue
                with self._changed:
                    self._failure = failure
                    self._changed.notify_all()
                return
            failures = 0
            with self._changed:
                del self._waiting[: len(rows)]
                self._changed.notify_all()
                self._changed.wait_for(lambda: self._closed, self._pause)

    def settle(self, timeout: float = 60.0) -> bool:
        """Wait until all queries listened to have ended and are written; False if not in time."""
        with self._changed:
            done = lambda: self._failure or not (self._running or self._waiting)
            settled = self._changed.wait_for(done, timeout)
            if self._failure:
                raise self._failure
            return bool(settled)

    def close(self, timeout: float = 60.0) -> None:
        """Stop listening; what has come in is written first."""
        self._spark.streams.removeListener(self)
        with self._changed:
            self._closed = True
            self._changed.notify_all()
        self._writer.join(timeout)
        if self._failure:
            raise self._failure
        if self._writer.is_alive():
            raise TimeoutError("reports of queries could not be written in time")


def events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(path)


def steps(spark: SparkSession, path: str) -> DataFrame:
    """A row per run and micro-batch.  A batch that waited for rows is reported more than once."""
    last = F.max_by(F.struct(*_MEASURES), F.struct("input_rows", "at")).alias("last")
    done = events(spark, path).filter(F.col("event") == "progress")
    return done.groupBy("query", "run_id", "batch").agg(last).select("query", "run_id", "batch", "last.*")


_MEASURES = (
    "at", "input_rows", "processed_per_second", "batch_ms", "dropped_rows", "state_rows", "watermark"
)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """A row per run: batches, rows, late rows, the newest watermark, whether and how it ended."""
    ended = F.col("event") == "ended"
    all_runs = events(spark, path).groupBy("query", "run_id").agg(
        F.min(F.when(F.col("event") == "started", F.col("at"))).alias("started_at"),
        F.max(F.when(ended, F.col("at"))).alias("ended_at"),
        F.max("error").alias("error"),
        (~F.max(ended)).alias("active"),
    )
    done = steps(spark, path).groupBy("query", "run_id").agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_rows").alias("dropped_rows"),
        F.max("watermark").alias("watermark"),
        F.max_by("state_rows", "batch").alias("state_rows"),
    )
    return all_runs.join(done, ["query", "run_id"], "left")
