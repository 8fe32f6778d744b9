"""The domain jobs end to end: CSV files, training, a file bus, serving, monitoring."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from intervalcast.operators import monitor
from intervalcast.operators.messages import to_messages
from intervalcast.plans import domain, serve
from intervalcast.plans import monitor as monitoring
from intervalcast.plans.train import train_on
from intervalcast.schemas import (
    BUILDINGS,
    CONDITION_COLS,
    DAILY_TOTAL,
    HOURLY_TOTAL,
    PREDICTION,
    WEATHER_EVENT,
)
from intervalcast.settings import ModelSettings, Paths, Settings, StreamSettings
from intervalcast.sources.bus import Bus
from intervalcast.sources.sinks import append_parquet, memory_table
from intervalcast.sources.tables import literal_table, stream_parquet
from intervalcast.streaming.runner import finish, progress_table, stop_all, supervise
from intervalcast.streaming.scoring import events_from_bus, loose_events
from intervalcast.streaming.windows import window_totals, with_event_time

SITES, DAYS = 2, 6
START = 1640995200  # 2022-01-01 in UTC


def write_inputs(spark, root):
    """Three buildings, the third without weather at its site; hourly readings."""
    buildings = spark.createDataFrame(
        [
            (0, 100, "Education", 10000, 3, 1, 1995, 0.1, 0.2, 0.3),
            (1, 101, "Office", 5000, None, 2, None, 0.4, 0.5, 0.6),
            (9, 102, "Retail", 700, 1, 3, 2001, 0.7, 0.8, 0.9),
        ],
        BUILDINGS,
    )
    hours = spark.range(24 * DAYS).select(
        F.col("id"), F.timestamp_seconds(START + F.col("id") * 3600).alias("at")
    )
    meters = hours.crossJoin(buildings.select("building_id")).crossJoin(
        literal_table(spark, "meter_type", ["e", "c"])
    )
    meters = meters.select(
        "building_id",
        "meter_type",
        F.col("at").alias("ts"),
        (F.col("building_id") - 99 + F.hour("at") + F.col("id") % 3).cast("double").alias("value"),
        F.col("id").cast("int").alias("row_id"),
    )
    weather = hours.crossJoin(spark.range(SITES).select(F.col("id").cast("int").alias("site_id")))
    weather = weather.select(
        "site_id",
        F.col("at").alias("timestamp"),
        *[F.when(hours["id"] % 10 != i, hours["id"] * 1.5 + i).alias(c) for i, c in enumerate(CONDITION_COLS)],
    )
    settings = Settings(
        paths=Paths(data_root=f"{root}/data", artifact_root=f"{root}/artifacts"),
        model=ModelSettings(cv_folds=2),
    )
    for df, path in (
        (meters, settings.paths.meters),
        (buildings, settings.paths.buildings),
        (buildings, settings.paths.buildings_stream),
        (weather, settings.paths.weather),
    ):
        df.write.option("header", True).csv(path)
    return settings


@pytest.fixture(scope="module")
def settings(spark, tmp_path_factory):
    return write_inputs(spark, tmp_path_factory.mktemp("job"))


@pytest.fixture(scope="module")
def training(spark, settings):
    frame = domain.build_training_frame(spark, settings)
    return train_on(frame, settings, grid={"maxDepth": [2], "maxIter": [2, 4], "stepSize": [0.1]})


def test_training_frame_has_one_row_per_grain(spark, settings):
    frame = domain.build_training_frame(spark, settings).cache()
    assert frame.count() == frame.select(domain.GRAIN).distinct().count() == 3 * 2 * 4 * DAYS
    total = frame.agg(F.sum("energy_consumption")).first()[0]
    assert total == domain.load_meters(spark, settings).agg(F.sum("value")).first()[0]
    assert frame.filter("building_id = 102 AND air_temperature IS NOT NULL").count() == 0
    assert {"time_sin", "month_cos", "log_square_feet", "decade"} <= set(frame.columns)


def test_training_leaves_a_model_and_scores(spark, settings, training):
    assert set(training.scores) == {"rmse", "mae", "r2", "rmsle"}
    assert {r["model"] for r in training.benchmark.collect()} == {"random_forest", "gbt"}
    vector = training.model.transform(domain.build_training_frame(spark, settings)).first()["features"]
    # 17 single inputs, then one-hot places: 3 uses and 2 meter types, one more each.
    assert len(vector) == 17 + 4 + 3


def publish_weather(spark, settings, bus):
    weather = domain.load_weather(spark, settings).withColumnRenamed("timestamp", "event_time")
    unknown = weather.filter("site_id = 0").limit(1).withColumn("site_id", F.lit(77))
    timeless = weather.filter("site_id = 1").limit(1).withColumn("event_time", F.lit(None).cast("timestamp"))
    feed = weather.unionByName(unknown).unionByName(timeless)
    sent = to_messages(feed, order_by=["event_time", "site_id"], fields=WEATHER_EVENT.fieldNames())
    records = sent.select(F.col("message_no").cast("string").alias("key"), "value")
    bus.send(records, settings.bus.weather_topic)
    return feed


def test_serving(spark, settings, training, tmp_path):
    bus = Bus("files", str(tmp_path / "bus"))
    feed = publish_weather(spark, settings, bus)
    queries = serve.catch_up(spark, settings, bus)
    paths = settings.paths

    scored = spark.read.parquet(paths.output(serve.PREDICTIONS)).select(PREDICTION.fieldNames())
    events = 24 * DAYS * SITES
    # One building per site and four meter types; unknown sites and missing times stay.
    assert scored.count() == (events + 2) * 4 == feed.count() * 4
    assert scored.filter("prediction IS NULL").count() == 0
    assert scored.filter("building_id IS NULL").count() == 4
    assert scored.filter("event_time IS NULL").count() == 4

    # The stream gives what the same features and model give in batch.
    buildings = domain.load_serving_buildings(spark, settings)
    batch = serve.predictions_of(
        serve.feature_stream(bus.read(spark, settings.bus.weather_topic), buildings, settings),
        training.model,
    )
    batch = batch.select(scored.columns)
    assert batch.exceptAll(scored).count() == scored.exceptAll(batch).count() == 0

    # Windows are the closed ones, and add up to the records in them.
    hourly = spark.read.schema(HOURLY_TOTAL).parquet(paths.output(serve.HOURLY))
    daily = spark.read.schema(DAILY_TOTAL).parquet(paths.output(serve.DAILY))
    assert hourly.select("window").distinct().count() == 4 * DAYS - 1
    assert daily.select("window").distinct().count() == DAYS - 1
    closed = scored.filter("event_time < '2022-01-06'").agg(F.sum("prediction")).first()[0]
    assert daily.agg(F.sum("daily_total_energy")).first()[0] == pytest.approx(closed)
    assert hourly.filter("building_id IS NULL").count() == 1

    published = bus.read(spark, settings.bus.predictions_topic)
    assert published.count() == scored.count()
    assert {r["key"] for r in published.select("key").distinct().collect()} == {"100", "101", None}
    assert all(not query.isActive for query in queries)

    # A second run over the same bus finds nothing new.
    serve.catch_up(spark, settings, bus)
    assert spark.read.parquet(paths.output(serve.PREDICTIONS)).count() == scored.count()

    # Totals went on to their topics with their own columns, once.
    assert bus.read(spark, settings.bus.hourly_topic).count() == hourly.count()
    sent = bus.read(spark, settings.bus.daily_topic)
    again = sent.select(F.from_json("value", DAILY_TOTAL).alias("r")).select("r.*")
    assert again.exceptAll(daily).count() == 0 and again.count() == daily.count()
    assert sent.filter("key IS NOT NULL").count() == 0

    # Monitoring follows the predictions topic over two batches, one with faulty records.
    for bad in ([], ["{broken", '{"prediction": "x"}']):
        if bad:
            bus.send(spark.createDataFrame([(None, t) for t in bad], "key STRING, value STRING"), settings.bus.predictions_topic)
        finish(
            monitoring.start_snapshots(
                bus.subscribe(spark, settings.bus.predictions_topic, arrival=True),
                quarantine=str(tmp_path / "q"),
                metrics=str(tmp_path / "m"),
                checkpoint=str(tmp_path / "mc"),
            )
        )
    latest = {(r["metric"], r["labels"]): r["value"] for r in monitoring.latest_version(spark, str(tmp_path / "m")).collect()}
    assert latest[monitor.PROCESSED, ""] == scored.count()
    assert latest[f"{monitor.DISTRIBUTION}_bucket", 'le="+Inf"'] == scored.count()
    assert sum(k[0] == monitor.LATEST for k in latest) == 4 * 3
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2


def test_the_record_sent_last_is_the_latest(spark, tmp_path):
    """Two sendings and several partitions in one batch: arrival counts, not size or place."""
    bus = Bus("files", str(tmp_path / "bus"))
    text = '{"event_time": "2022-06-01T12:00:00Z", "site_id": "1", "meter_type": "e", "prediction": %s}'
    first = [(None, text % 100.0)]
    later = [(None, text % x) for x in range(1000, 1400)] + [(None, text % 200.0)]
    for rows, parts in ((first, 1), (later, 4)):
        df = spark.createDataFrame(rows, "key STRING, value STRING").coalesce(parts)
        bus.send(df, "p")
    finish(
        monitoring.start_snapshots(
            bus.subscribe(spark, "p", arrival=True),
            quarantine=str(tmp_path / "q"),
            metrics=str(tmp_path / "m"),
            checkpoint=str(tmp_path / "c"),
        )
    )
    rows = monitoring.latest_version(spark, str(tmp_path / "m")).collect()
    latest = {r["labels"]: r["value"] for r in rows if r["metric"] == monitor.LATEST}
    assert latest == {'meter_type="e",site_id="1"': 200.0}


def test_serving_options(spark, settings, training, tmp_path):
    """One forecast per window from averaged conditions, on local days, known sites only."""
    bus = Bus("files", str(tmp_path / "bus"))
    publish_weather(spark, settings, bus)
    settings = replace(
        settings, paths=replace(settings.paths, artifact_root=str(tmp_path / "artifacts"))
    )
    training.model.write().save(settings.paths.model)
    options = serve.Options(how="avg", pre_average=True, zone="Australia/Melbourne", matched_only=True)
    serve.catch_up(spark, settings, bus, options=options)
    scored = spark.read.schema(PREDICTION).parquet(settings.paths.output(serve.PREDICTIONS))
    known = scored.filter("building_id IS NOT NULL")
    assert known.count() == (4 * DAYS - 1) * SITES * 4
    hourly = spark.read.schema(HOURLY_TOTAL).parquet(settings.paths.output(serve.HOURLY))
    assert hourly.filter("building_id IS NULL").count() == 0
    # 11 hours ahead: a local day starts at 13:00 UTC.
    first = hourly.agg(F.min("window.start")).first()[0]
    assert str(first) == "2022-01-01 06:00:00"


def test_paced_queries_run_until_stopped(spark, settings, training, tmp_path):
    bus = Bus("files", str(tmp_path / "bus"))
    publish_weather(spark, settings, bus)
    settings = replace(
        settings,
        paths=replace(settings.paths, artifact_root=str(tmp_path / "artifacts")),
        stream=StreamSettings(trigger_predictions="1 second", trigger_hourly="1 second", trigger_daily="1 second"),
    )
    training.model.write().save(settings.paths.model)
    queries = serve.start_queries(spark, settings, bus)
    try:
        for query in queries:
            query.processAllAvailable()
        assert len(queries) == 6 and all(query.isActive for query in queries)
        steps = progress_table(spark, queries).groupBy("query").agg(F.sum("input_rows").alias("n")).collect()
        assert {r["query"]: r["n"] for r in steps}["predictions"] > 0
    finally:
        stop_all(queries)
    supervise(spark, queries)
    assert all(not query.isActive for query in queries)


def test_supervision_passes_a_failure_on_and_stops_the_rest(spark, tmp_path):
    good = spark.readStream.format("rate").load().writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "a")
    ).start()
    failing = (
        spark.readStream.format("rate")
        .load()
        .select(F.raise_error(F.lit("on purpose")).alias("x"))
        .writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "b"))
        .start()
    )
    with pytest.raises(Exception, match="on purpose"):
        supervise(spark, [good, failing])
    assert not good.isActive and not failing.isActive


def test_hourly_feed_needs_closed_windows(spark, tmp_path):
    """Rows behind the watermark are dropped from windows, but not in the batch after it moved."""
    shape = "t TIMESTAMP, v DOUBLE"
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))

    def step(*rows):
        df = spark.createDataFrame([(t, float(v)) for t, v in rows], "t STRING, v DOUBLE")
        df.withColumn("t", F.col("t").cast("timestamp")).write.mode("append").parquet(landing)
        stream = with_event_time(stream_parquet(spark, landing, spark.createDataFrame([], shape).schema), "t", "10 minutes")
        totals = window_totals(stream, ts="t", length="6 hours", keys=[], value="v", total="total")
        return finish(append_parquet(totals, out, checkpoint))

    step(("2022-01-01 00:30:00", 1), ("2022-01-01 06:05:00", 10))
    # The watermark is 05:55: the first window is still open.
    late = step(("2022-01-01 01:00:00", 2), ("2022-01-01 06:30:00", 20))
    # Now it is 06:20 and the window has been written.
    dropped = step(("2022-01-01 02:00:00", 4), ("2022-01-01 07:00:00", 40), (None, 80))
    rows = spark.read.parquet(out).collect()
    assert [(str(r["window"]["start"]), r["total"]) for r in rows] == [("2022-01-01 00:00:00", 3.0)]
    count = lambda query: sum(r["dropped_rows"] for r in progress_table(spark, [query]).collect())
    assert count(late) == 0 and count(dropped) == 1


def test_loose_feed(spark):
    text = (
        '{"ts": "1", "rows": [{"site_id": "3", "air_temperature": "", "wind_speed": "abc", '
        '"dew_temperature": "1.5", "weather_ts": "1654084800"}, {"site_id": "", "weather_ts": ""}]}'
    )
    df = spark.createDataFrame([("k", text), ("k", '{"rows": []}'), ("k", "{broken"), ("k", None)], "key STRING, value STRING")
    rows = loose_events(df).collect()
    assert len(rows) == 2
    assert (rows[0]["site_id"], rows[0]["air_temperature"], rows[0]["wind_speed"], rows[0]["dew_temperature"]) == (3, None, None, 1.5)
    assert str(rows[0]["event_time"]) == "2022-06-01 12:00:00"
    assert rows[1]["site_id"] is None and rows[1]["event_time"] is None


def test_bad_fields_of_a_typed_message(spark):
    from intervalcast.schemas import WEATHER_BATCH

    text = '{"batch_ts": "2022-06-01T00:00:00", "rows": [{"site_id": 1, "event_time": "soon", "wind_speed": 2}, {"site_id": 2, "event_time": "2022-06-01T12:00:00Z"}]}'
    df = spark.createDataFrame([("k", text)], "key STRING, value STRING")
    rows = events_from_bus(df, WEATHER_BATCH, ts="event_time", delay=None).collect()
    assert [r["site_id"] for r in rows] == [1, 2]
    assert rows[0]["event_time"] is None and str(rows[1]["event_time"]) == "2022-06-01 12:00:00"


def test_memory_table(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = stream_parquet(spark, str(tmp_path / "in"), spark.range(1).schema)
    finish(memory_table(stream, "kept_rows", checkpoint=str(tmp_path / "c")))
    assert spark.sql("SELECT count(*) AS n FROM kept_rows").first()["n"] == 5
