"""Joins in place, and totals with corrections."""

import pathlib

import pytest
from pyspark.sql import functions as F

import check
from intervalcast.queries import REGISTRY
from intervalcast.queries.registry import conditions, entities, readings
from intervalcast.sources import colocated
from intervalcast.sources.tables import stream_parquet
from intervalcast.streaming import late
from intervalcast.streaming.runner import finish

TABLES = "/root/testdata/sf0.001"
COLUMNS = {"entity": "user_id", "category": "event_type", "site": "site_id", "value": "value", "total": "total"}


def explained(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_the_frame_has_no_exchange(spark, capsys):
    """Neither shuffled nor broadcast, with and without small sides being broadcast."""
    stored, feed = colocated.by_site_and_interval(
        readings(spark, TABLES),
        entities(spark, TABLES),
        conditions(spark, TABLES).drop("angle"),
        entity="user_id",
        site="site_id",
        ts="ts",
        buckets=8,
    )
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        frame = colocated.frame_in_place(stored, feed, attributes=["segment", "area"], means=["condition"], **COLUMNS)
        plan = explained(frame, capsys)
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        query = REGISTRY["frame_colocated"]
        assert check.differences(query.build(spark, TABLES), check.connect(TABLES), query.sql) == []
    finally:
        spark.conf.set(key, before)


def test_a_hot_site_is_dealt_over_its_intervals(spark):
    """One entity with nearly all readings, and readings of unknown entities."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(100).alias("user_id"),
        F.lit("e").alias("event_type"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600).alias("ts"),
        F.lit(1.0).alias("value"),
    )
    owners = spark.createDataFrame([(100, 1), (1, 2), (2, 2)], "user_id BIGINT, site_id INT")
    feed = rows.select(F.lit(1).alias("site_id"), "ts", F.lit(5.0).alias("condition"))
    stored, kept = colocated.by_site_and_interval(
        rows, owners, feed, entity="user_id", site="site_id", ts="ts", buckets=8
    )
    files = [r[0] for r in stored.filter("site_id = 1").groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(files) == 8 and max(files) < 4000 / 4
    frame = colocated.frame_in_place(stored, kept, attributes=[], means=["condition"], **COLUMNS)
    assert frame.agg(F.sum("total")).first()[0] == 4000
    known = frame.filter("site_id IS NOT NULL")
    assert frame.filter("site_id IS NULL AND condition IS NULL").count() > 0
    assert known.filter("site_id = 1 AND condition <> 5").count() == 0


@pytest.fixture
def landing(spark, tmp_path):
    """Six files; rows of the later ones reach back up to a day."""
    for i in range(6):
        rows = spark.range(200).select(
            F.timestamp_seconds(
                F.lit(1_700_000_000) + i * 40_000 + F.col("id") * 200
                - F.when(F.col("id") % 9 == 0, 30_000 * (F.col("id") % 4)).otherwise(0)
            ).alias("ts"),
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 31 == 0, None).otherwise("k").alias("k"),
            (F.col("id") * 0.5 + i).alias("v"),
        )
        rows = rows.withColumn("ts", F.when(F.col("v") != 7.0, F.col("ts")))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return f"{tmp_path}/in", rows.schema


def start(spark, landing, path, **more):
    source, schema = landing
    stream = stream_parquet(spark, source, schema, files_per_trigger=1)
    options = {"ts": "ts", "delay": "1 hour", "length": "6 hours", "keys": ["k"], "value": "v", "total": "sum"}
    return late.start_corrected_totals(stream, path, f"{path}-c", buckets=3, **options | more)


def test_totals_and_corrections_are_the_whole(spark, landing, tmp_path):
    """Nothing is lost, and what is late is told apart by the batches before."""
    path = f"{tmp_path}/t"
    finish(start(spark, landing, path))
    source, schema = landing
    rows = spark.read.schema(schema).parquet(source)
    shape = late.total_schema(rows, "ts", ["k"], "sum")
    found = late.corrected(spark, path, shape, keys=["k"], total="sum")
    whole = rows.groupBy(F.window("ts", "6 hours"), "k").agg(F.sum("v").alias("sum"), F.count("*").alias("records"))
    pick = ["window", "k", "sum", "records"]
    assert sorted(map(str, found.select(*pick).collect())) == sorted(map(str, whole.select(*pick).collect()))

    # The same by hand: files are batches, in the order they were written.
    newest, missed = None, []
    for path_of in sorted(pathlib.Path(source).glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns):
        own = [r for r in spark.read.schema(schema).parquet(str(path_of)).collect() if r.ts is not None]
        for r in own:
            seconds = int(r.ts.timestamp())
            if newest is not None and (seconds // 21_600 + 1) * 21_600 <= newest - 3600:
                missed.append((r.ts, r.k or "", r.v))
        newest = max([newest or 0, *(int(r.ts.timestamp()) for r in own)])
    kept = late.late_rows(spark, path)
    assert sorted((r.ts, r.k or "", r.v) for r in kept.collect()) == sorted(missed) and missed
    assert kept.filter(F.col("window.end") > F.col("watermark")).count() == 0
    assert found.agg(F.sum("late_records")).first()[0] == len(missed)


def test_a_failed_batch_is_written_once(spark, landing, tmp_path, monkeypatch):
    """The third batch fails between its totals and its corrections, then all goes on."""
    path, calls = f"{tmp_path}/t", []
    own = late.upsert

    def failing(rows, place, number, **options):
        calls.append(place)
        if len(calls) == 6:
            raise RuntimeError("lost")
        return own(rows, place, number, **options)

    monkeypatch.setattr(late, "upsert", failing)
    with pytest.raises(Exception, match="lost"):
        finish(start(spark, landing, path))
    finish(start(spark, landing, path))
    source, schema = landing
    rows = spark.read.schema(schema).parquet(source).filter("ts IS NOT NULL")
    shape = late.total_schema(rows, "ts", ["k"], "sum")
    found = late.corrected(spark, path, shape, keys=["k"], total="sum")
    assert found.agg(F.sum("records")).first()[0] == rows.count()
    assert late.late_rows(spark, path).count() == found.agg(F.sum("late_records")).first()[0]
