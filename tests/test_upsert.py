"""Keyed results updated in place."""

import threading

import pytest
from pyspark.sql import functions as F

from intervalcast.sources.tables import stream_parquet
from intervalcast.sources.upsert import (
    bucket_of,
    manifest,
    read_upserted,
    upsert,
    upsert_parquet,
    vacuum,
)
from intervalcast.streaming.runner import finish
from intervalcast.streaming.windows import window_totals, with_event_time

SCHEMA = "k STRING, s STRUCT<a: INT>, n BIGINT, note STRING"


def rows_of(df):
    return sorted((r.k or "", r.s.a, r.n, r.note) for r in df.collect())


def test_rows_replace_those_of_their_key(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    schema = frame([]).schema
    put = lambda rows, number: upsert(frame(rows), path, number, keys=["k", "s"], buckets=16)
    assert manifest(spark, path) == (-1, {}) and rows_of(read_upserted(spark, path, schema)) == []
    put([("a", (1,), 1, "x"), ("a", (2,), 2, "x"), (None, (1,), 3, "x")], 0)
    put([("a", (1,), 10, "y"), (None, (1,), 30, "y"), ("b", (1,), 4, "y")], 1)
    expected = [("", 1, 30, "y"), ("a", 1, 10, "y"), ("a", 2, 2, "x"), ("b", 1, 4, "y")]
    assert rows_of(read_upserted(spark, path, schema)) == expected
    # A batch that is repeated, and one without rows.
    assert put([("a", (1,), 99, "z")], 1) == 0
    assert put([], 2) == 0
    assert rows_of(read_upserted(spark, path, schema)) == expected and manifest(spark, path)[0] == 2


def test_sums_are_added(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k STRING, n BIGINT, x DOUBLE, note STRING"
    for number, rows in enumerate(([("a", 1, 0.5, "p"), ("a", 2, 1.0, "p"), ("b", 5, 1.0, "p")], [("a", 4, 1.0, "q")])):
        batch = spark.createDataFrame(rows, schema)
        upsert(batch, path, number, keys=["k"], buckets=4, add=["n", "x"])
    found = read_upserted(spark, path, batch.schema).collect()
    assert sorted(map(tuple, found)) == [("a", 7, 2.5, "q"), ("b", 5, 1.0, "p")]


def test_work_follows_the_changed_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    start = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    assert upsert(start, path, 0, keys=["k"], buckets=32) == 32
    before = manifest(spark, path)[1]
    few = spark.createDataFrame([(3, 1), (700, 1)], "k BIGINT, v INT")
    touched = {r[0] for r in few.select(bucket_of(["k"], 32)).collect()}
    assert upsert(few, path, 1, keys=["k"], buckets=32) == len(touched)
    after = manifest(spark, path)[1]
    assert {b for b in after if after[b] != before[b]} == touched
    table = read_upserted(spark, path, few.schema)
    assert table.count() == 1000 and table.agg(F.sum("v")).first()[0] == 2


def test_old_folders_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(6):
        upsert(spark.range(20).select("id", F.lit(number).alias("v")), path, number, keys=["id"], buckets=2)
    assert vacuum(spark, path, keep=2) == 4
    schema = spark.range(1).select("id", F.lit(1).alias("v")).schema
    assert [r.v for r in read_upserted(spark, path, schema).collect()] == [5] * 20
    assert len(list((tmp_path / "t" / "manifest").glob("version=*"))) == 2
    assert vacuum(spark, path, keep=2) == 0


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_readers_never_see_a_gap(spark, tmp_path, delay):
    """A reader in a loop, while a stream of many batches updates its totals."""
    path, landing = str(tmp_path / "t"), str(tmp_path / "in")
    for i in range(12):
        hours = spark.range(40).select(
            F.timestamp_seconds(F.lit(1_700_000_000) + (i * 40 + F.col("id")) * 900).alias("ts"),
            (F.col("id") % 3).alias("k"),
            F.lit(1.0).alias("v"),
        )
        hours.coalesce(1).write.mode("append").parquet(landing)
    stream = with_event_time(stream_parquet(spark, landing, hours.schema, files_per_trigger=1), "ts", delay)
    totals = window_totals(stream, ts="ts", length="6 hours", keys=["k"], value="v", total="total")
    seen, failures, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(read_upserted(spark, path, totals.schema).agg(F.sum("total")).first()[0] or 0.0)
            except Exception as error:  # noqa: BLE001
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        query = finish(upsert_parquet(totals, path, f"{tmp_path}/c", keys=["window", "k"], buckets=4))
    finally:
        stop.set()
        reader.join()
    assert failures == [] and seen == sorted(seen)
    final = read_upserted(spark, path, totals.schema)
    assert final.agg(F.sum("total")).first()[0] == 480.0
    state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert (state < final.count()) if delay else (state == final.count()), (state, final.count(), query.lastProgress["batchId"])
