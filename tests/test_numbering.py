"""Numbers across the batches of a stream."""

import pytest
from pyspark.sql import functions as F

from intervalcast.operators.messages import from_messages
from intervalcast.schemas import table as schema
from intervalcast.sources.bus import Bus
from intervalcast.sources.tables import stream_parquet
from intervalcast.streaming import numbering
from intervalcast.streaming.runner import finish
from pyspark.sql import types as T


@pytest.fixture
def landing(spark, tmp_path):
    for i in range(4):
        rows = spark.range(i * 50, i * 50 + 50 - i).select(
            "id", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("id") % 7).alias("ts")
        )
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return lambda: stream_parquet(spark, f"{tmp_path}/in", rows.schema, files_per_trigger=1)


def test_no_gap_and_no_repeat_after_a_failed_batch(spark, tmp_path, landing, monkeypatch):
    """The third batch fails after its rows are written and before their number is noted."""
    path, own, calls = f"{tmp_path}/out", numbering._note, []

    def failing(rows, place, number):
        calls.append(number)
        if len(calls) == 3:
            raise RuntimeError("lost")
        own(rows, place, number)

    monkeypatch.setattr(numbering, "_note", failing)
    options = {"order_by": ["ts", "id"]}
    with pytest.raises(Exception, match="lost"):
        finish(numbering.start_numbering(landing(), path, f"{tmp_path}/c", **options))
    finish(numbering.start_numbering(landing(), path, f"{tmp_path}/c", **options))
    assert calls == [0, 1, 2, 2, 3]
    rows = numbering.numbered_rows(spark, path, landing().schema).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(50 + 49 + 48 + 47))
    expected = []
    for i in range(4):
        expected += sorted(range(i * 50, i * 50 + 50 - i), key=lambda k: (-(k % 7), k))
    assert [r.id for r in rows] == expected


def test_messages_go_on_from_batch_to_batch(spark, tmp_path, landing):
    path = f"{tmp_path}/out"
    options = {"order_by": ["ts", "id"], "fields": ["id"], "rows_per_message": 20}
    finish(numbering.start_messages(landing(), path, f"{tmp_path}/c", **options))
    messages = numbering.messages_of(spark, path)
    assert sorted(r.message_no for r in messages.collect()) == list(range(4 * 3))
    bus = Bus("files", f"{tmp_path}/bus")
    numbering.send_messages(spark, path, bus, "t")
    shape = schema(batch_ts=T.TimestampType(), rows=T.ArrayType(schema(id=T.LongType())))
    back = from_messages(bus.read(spark, "t"), shape, extra=["key"])
    assert back.select("id").distinct().count() == back.count() == 194
    first = [r.id for r in back.filter("key = 0").collect()]
    assert first == sorted(range(50), key=lambda k: (-(k % 7), k))[:20]
