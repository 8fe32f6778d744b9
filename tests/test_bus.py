"""Positions of readers and repeated batches on a files bus."""

import pytest
from pyspark.sql import functions as F

from intervalcast.sources.bus import Bus, encode
from intervalcast.sources.sinks import append_parquet
from intervalcast.sources.tables import read_parquet, stream_parquet
from intervalcast.streaming.runner import finish


def numbers(spark, start, end):
    return encode(spark.range(start, end))


def run(spark, bus, tmp_path, name, **options):
    stream = bus.subscribe(spark, "t", reader=name, **options)
    finish(append_parquet(stream, f"{tmp_path}/rows-{name}", f"{tmp_path}/c-{name}"))
    rows = read_parquet(spark, f"{tmp_path}/rows-{name}", stream.schema)
    return sorted(r[0] for r in rows.select(F.get_json_object("value", "$.id").cast("int")).collect())


def test_latest_restart_and_replay(spark, tmp_path):
    bus = Bus("files", f"{tmp_path}/bus")
    bus.send(numbers(spark, 0, 5), "t")
    assert run(spark, bus, tmp_path, "new", starting="latest") == []
    between = bus.position(spark, "t", "new")
    bus.send(numbers(spark, 5, 8), "t")
    assert run(spark, bus, tmp_path, "new", starting="latest") == [5, 6, 7]
    bus.send(numbers(spark, 8, 9), "t")
    # A restart goes on, whatever it is told to start with; its position stays.
    assert run(spark, bus, tmp_path, "new", starting="earliest") == [5, 6, 7, 8]
    assert bus.position(spark, "t", "new") == between
    assert run(spark, bus, tmp_path, "all", starting="earliest") == list(range(9))
    assert run(spark, bus, tmp_path, "given", starting=str(between)) == [5, 6, 7, 8]
    # A replay: the reader is set back, and begins anew with a new checkpoint.
    bus.reposition(spark, "t", "new", "earliest")
    stream = bus.subscribe(spark, "t", reader="new")
    finish(append_parquet(stream, f"{tmp_path}/again", f"{tmp_path}/c-again"))
    assert read_parquet(spark, f"{tmp_path}/again", stream.schema).count() == 9
    assert bus.position(spark, "u", "new") is None


def test_a_batch_sent_whole_is_not_sent_again(spark, tmp_path):
    """The writer is stopped after it has sent a batch and before it has noted that."""
    bus = Bus("files", f"{tmp_path}/bus")
    numbers(spark, 0, 6).write.parquet(f"{tmp_path}/in")
    records = stream_parquet(spark, f"{tmp_path}/in", numbers(spark, 0, 1).schema)
    options = {"checkpoint": f"{tmp_path}/sender", "available_now": True}
    finish(bus.publish(records, "t", **options))
    before = sorted(p.name for p in (tmp_path / "bus" / "t").rglob("*.parquet"))
    for note in (tmp_path / "sender" / "commits").iterdir():
        note.unlink()
    finish(bus.publish(records, "t", **options))
    assert sorted(p.name for p in (tmp_path / "bus" / "t").rglob("*.parquet")) == before
    assert bus.read(spark, "t").count() == 6


def test_times_that_are_none(spark, tmp_path):
    bus = Bus("files", f"{tmp_path}/bus")
    bus.send(numbers(spark, 0, 1), "t")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bus.subscribe(spark, "t", reader="r", starting="whenever")
    assert bus.position(spark, "t", "r") is None
