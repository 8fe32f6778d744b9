"""Message buses: records with a text key and a text value.

``Bus("kafka", ...)`` needs the Kafka connector on the class path.  ``Bus("files", ...)``
keeps each topic as a folder of Parquet files with the same two columns and the time and
number of sending, for systems without a broker and for replays.  A reader of a files topic
may have a name; its starting position is then stored beside the topics.

Kafka delivers at least once.  A files topic takes a batch that was sent whole once: a
restarted writer finds its folder finished and leaves it.  A writer that is lost while the
files of a batch are moved into place sends the batch again.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import row_json
from ..schemas import BUS_RECORD, STORED_RECORD
from .tables import exists

POSITIONS = "_positions"  # beside the topics of a files bus
BEFORE_ALL = "1970-01-01 00:00:00"


@dataclass(frozen=True)
class Bus:
    """``address``: bootstrap servers for Kafka, root folder for files."""

    kind: Literal["kafka", "files"]
    address: str

    def _topic_folder(self, topic: str) -> str:
        return f"{self.address.rstrip('/')}/{topic}"

    def subscribe(
        self,
        spark: SparkSession,
        topic: str,
        *,
        starting: str = "latest",
        reader: str | None = None,
        files_per_trigger: int | None = None,
        arrival: bool = False,
    ) -> DataFrame:
        """The topic as a stream of (key, value) text, on request with ``arrival``.

        ``arrival`` is a number that orders the records as the bus received them.
        ``starting`` (``latest``, ``earliest``, or on files a time of sending after which to
        begin) applies to the first start.  On files that is the first start of ``reader``:
        where it began is kept, so that a restart with the same checkpoint goes on, and one
        with a new checkpoint begins there again.  Without a name a folder is read from its
        beginning.
        """
        if self.kind == "kafka":
            raw = (
                spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", self.address)
                .option("subscribe", topic)
                .option("startingOffsets", starting)
                .load()
            )
            return decode(raw, arrival=arrival)
        source = spark.readStream.schema(STORED_RECORD).option("recursiveFileLookup", True)
        if files_per_trigger:
            source = source.option("maxFilesPerTrigger", files_per_trigger)
        raw = source.parquet(self._topic_folder(topic))
        if reader is not None:
            since = self.position(spark, topic, reader)
            if since is None:
                since = self.reposition(spark, topic, reader, starting)
            # Pushed down to the files: those sent before are not decoded.
            raw = raw.filter(F.col("sent_at") > F.lit(since))
        order = [arrival_of(F.col("sent_at"), F.col("sent_no")).alias("arrival")] if arrival else []
        return raw.select("key", "value", *order)

    def _position_folder(self, topic: str, reader: str) -> str:
        return f"{self.address.rstrip('/')}/{POSITIONS}/{topic}/{reader}"

    def position(self, spark: SparkSession, topic: str, reader: str) -> datetime.datetime | None:
        """The time of sending after which a reader of a files topic began."""
        folder = self._position_folder(topic, reader)
        if not exists(spark, f"{folder}/_SUCCESS"):
            return None
        return spark.read.schema("since TIMESTAMP").parquet(folder).first().since

    def reposition(
        self, spark: SparkSession, topic: str, reader: str, starting: str = "latest"
    ) -> datetime.datetime:
        """Let a reader of a files topic begin elsewhere; its query needs a new checkpoint."""
        if starting == "latest":
            sent = spark.read.schema(STORED_RECORD).option("recursiveFileLookup", True)
            since = sent.parquet(self._topic_folder(topic)).agg(F.max("sent_at").alias("since"))
        else:
            text = BEFORE_ALL if starting == "earliest" else starting
            since = spark.range(1).select(F.lit(text).cast("timestamp").alias("since"))
        since = since.select(F.coalesce("since", F.lit(BEFORE_ALL).cast("timestamp")).alias("since"))
        folder = self._position_folder(topic, reader)
        since.coalesce(1).write.mode("overwrite").parquet(folder)
        return self.position(spark, topic, reader)

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        """Everything in the topic so far, as a table."""
        if self.kind == "kafka":
            raw = (
                spark.read.format("kafka")
                .option("kafka.bootstrap.servers", self.address)
                .option("subscribe", topic)
                .load()
            )
            return decode(raw)
        reader = spark.read.schema(BUS_RECORD).option("recursiveFileLookup", True)
        return reader.parquet(self._topic_folder(topic))

    def send(self, records: DataFrame, topic: str) -> None:
        """Append a table of records to the topic."""
        if self.kind == "kafka":
            (
                records.write.format("kafka")
                .option("kafka.bootstrap.servers", self.address)
                .option("topic", topic)
                .save()
            )
        else:
            stamped(records).write.parquet(f"{self._topic_folder(topic)}/{uuid.uuid4().hex}")

    def publish(
        self,
        records: DataFrame,
        topic: str,
        *,
        checkpoint: str,
        every: str | None = None,
        available_now: bool = False,
    ) -> StreamingQuery:
        """Append a stream of records to the topic; as fast as possible without ``every``."""
        writer = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif every:
            writer = writer.trigger(processingTime=every)
        if self.kind == "kafka":
            writer = (
                writer.format("kafka")
                .option("kafka.bootstrap.servers", self.address)
                .option("topic", topic)
            )
        else:
            # A folder per batch, so that several writers can share a topic.
            sender = checkpoint.rstrip("/").rpartition("/")[2]
            folder = f"{self._topic_folder(topic)}/{sender}"

            def send(batch: DataFrame, number: int) -> None:
                # A batch that is run again after it was sent whole is there already.
                if not exists(batch.sparkSession, f"{folder}-{number}/_SUCCESS"):
                    stamped(batch).write.mode("overwrite").parquet(f"{folder}-{number}")

            writer = writer.foreachBatch(send)
        return writer.start()


def decode(raw: DataFrame, *, arrival: bool = False) -> DataFrame:
    """Key and value bytes of Kafka records as text, on request with their arrival."""
    # A topic has fewer than 100,000 partitions.
    number = F.col("offset") * 100_000 + F.col("partition") if arrival else None
    order = [arrival_of(F.col("timestamp"), number).alias("arrival")] if arrival else []
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), *order)


def arrival_of(time: Column, number: Column) -> Column:
    """Time of receipt and, within it, a number, as one decimal that orders by both."""
    micros = F.unix_micros(time).cast("decimal(18,0)") * F.lit(10**18).cast("decimal(19,0)")
    return (micros + number.cast("decimal(18,0)")).cast("decimal(38,0)")


def stamped(records: DataFrame) -> DataFrame:
    """Records for a file: with the time they were sent and their number in the sending."""
    return records.select(
        "key",
        "value",
        F.current_timestamp().alias("sent_at"),
        F.monotonically_increasing_id().alias("sent_no"),
    )


def encode(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON records, keyed by a column or with a null key."""
    key_col = F.lit(None) if key is None else F.col(key)
    return rows.select(key_col.cast("string").alias("key"), row_json().alias("value"))
