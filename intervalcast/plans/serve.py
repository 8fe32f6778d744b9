"""Serving: score the feed once, derive everything else from the scored table.

    bus -> events -> features -> model -> predictions (Parquet, by date)
                                              |-> 6-hour totals per building
                                              |-> daily totals per site
                                              '-> predictions topic
    totals -> their topics

The scored table is itself a stream source, so the model runs once per event however many
results are derived, and each derived query can fail and restart on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import CONDITION_COLS, DAILY_TOTAL, HOURLY_TOTAL, PREDICTION, WEATHER_BATCH
from ..settings import METER_TYPES, Settings
from ..sources.bus import Bus, encode
from ..sources.models import load_model
from ..sources.sinks import append_parquet
from ..sources.tables import ensure_folder, stream_parquet
from ..streaming.runner import finish, supervise
from ..streaming.scoring import events_from_bus, expand, score
from ..streaming.windows import window_means, window_totals, with_event_time
from . import domain

PREDICTIONS, HOURLY, DAILY = "predictions", "hourly_aggregations", "daily_aggregations"
DATE = "event_date"
FILES = 8  # of a day in a batch


@dataclass(frozen=True)
class Options:
    """How forecasts are made and added up.

    ``how``: ``sum`` adds every event's forecast, ``avg`` takes their mean per window.
    ``pre_average``: average the conditions per window first, so there is one forecast
    per window.  ``zone``: cut windows on the local clock of that zone.  ``matched_only``:
    leave events of unknown sites out of the totals.  ``spread``: tasks for the events of
    one site, where the plan has state and the buildings are too many to broadcast.
    """

    how: str = "sum"
    pre_average: bool = False
    zone: str | None = None
    matched_only: bool = False
    spread: int = 1


def feature_stream(
    messages: DataFrame,
    buildings: DataFrame,
    settings: Settings,
    *,
    options: Options = Options(),
    owned: DataFrame | None = None,
) -> DataFrame:
    """Model-ready rows from the bus records: event x building of its site x meter type."""
    events = events_from_bus(
        messages, WEATHER_BATCH, ts="event_time", delay=settings.stream.watermark
    )
    if options.pre_average:
        events = window_means(
            events,
            ts="event_time",
            length=settings.stream.hourly_window,
            keys=["site_id"],
            values=CONDITION_COLS,
        )
    expanded = expand(
        events,
        buildings,
        ["site_id"],
        category="meter_type",
        categories=METER_TYPES,
        owned=owned,
        entity="building_id",
        spread=options.spread,
    )
    return domain.engineer_features(expanded, "event_time")


def build_feature_stream(spark: SparkSession, settings: Settings, bus: Bus, **kwargs) -> DataFrame:
    messages = bus.subscribe(spark, settings.bus.weather_topic)
    return feature_stream(
        messages, domain.load_serving_buildings(spark, settings), settings, **kwargs
    )


def predictions_of(features: DataFrame, model: PipelineModel) -> DataFrame:
    return score(features, model, ["event_time", "site_id", "building_id", "meter_type"])


def start_scoring(
    predictions: DataFrame, settings: Settings, *, every: str | None
) -> StreamingQuery:
    """Predictions to Parquet, in folders by event date so that readers can skip days.

    Rows are brought together by date first, in FILES parts: a batch adds that many files to
    a day, not one for each task.
    """
    dated = predictions.withColumn(DATE, F.to_date("event_time"))
    part = F.pmod(F.xxhash64("building_id", "meter_type"), F.lit(FILES))
    return append_parquet(
        dated.repartition(DATE, part),
        settings.paths.output(PREDICTIONS),
        settings.paths.checkpoint(PREDICTIONS),
        every=every,
        partition_by=[DATE],
        name=PREDICTIONS,
    )


def scored_stream(
    spark: SparkSession, settings: Settings, options: Options = Options()
) -> tuple[DataFrame, str]:
    """The predictions table as a watermarked stream, and its time column for windows."""
    dated = T.StructType([*PREDICTION.fields, T.StructField(DATE, T.DateType())])
    path = settings.paths.output(PREDICTIONS)
    ensure_folder(spark, path)
    files = settings.stream.files_per_trigger
    stored = stream_parquet(spark, path, dated, files_per_trigger=files).drop(DATE)
    timed = with_event_time(stored, "event_time", settings.stream.watermark, zone=options.zone)
    return timed, "local_time" if options.zone else "event_time"


def start_totals(
    spark: SparkSession, settings: Settings, options: Options, *, paced: bool
) -> list[StreamingQuery]:
    """Totals per building and per site, appended once their window has closed."""
    stream = settings.stream
    queries = []
    for name, length, key, total, every in (
        (HOURLY, stream.hourly_window, "building_id", "total_energy", stream.trigger_hourly),
        (DAILY, stream.daily_window, "site_id", "daily_total_energy", stream.trigger_daily),
    ):
        scored, ts = scored_stream(spark, settings, options)
        if options.matched_only:
            scored = scored.filter(F.col("building_id").isNotNull())
        totals = window_totals(
            scored,
            ts=ts,
            length=length,
            keys=[key],
            value="prediction",
            total=total,
            how=options.how,
        )
        queries.append(
            append_parquet(
                totals,
                settings.paths.output(name),
                settings.paths.checkpoint(name),
                every=every if paced else None,
                name=name,
            )
        )
    return queries


def start_publishing(
    spark: SparkSession, settings: Settings, bus: Bus, *, paced: bool
) -> StreamingQuery:
    """Predictions to their topic, keyed by building."""
    stored, _ = scored_stream(spark, settings)
    return bus.publish(
        encode(stored, key="building_id"),
        settings.bus.predictions_topic,
        checkpoint=settings.paths.checkpoint("bus_predictions"),
        available_now=not paced,
    )


def republish(
    spark: SparkSession,
    bus: Bus,
    *,
    path: str,
    schema: T.StructType,
    topic: str,
    checkpoint: str,
    files_per_trigger: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Any stored result to a topic, with the columns of its own schema and a null key."""
    ensure_folder(spark, path)
    stored = stream_parquet(spark, path, schema, files_per_trigger=files_per_trigger)
    return bus.publish(
        encode(stored), topic, checkpoint=checkpoint, available_now=available_now
    )


def start_publishing_totals(
    spark: SparkSession, settings: Settings, bus: Bus, *, paced: bool
) -> list[StreamingQuery]:
    """The stored totals to their topics."""
    topics = settings.bus
    return [
        republish(
            spark,
            bus,
            path=settings.paths.output(name),
            schema=schema,
            topic=topic,
            checkpoint=settings.paths.checkpoint(f"bus_{name}"),
            files_per_trigger=settings.stream.files_per_trigger,
            available_now=not paced,
        )
        for name, schema, topic in (
            (HOURLY, HOURLY_TOTAL, topics.hourly_topic),
            (DAILY, DAILY_TOTAL, topics.daily_topic),
        )
    ]


def start_queries(
    spark: SparkSession, settings: Settings, bus: Bus, *, options: Options = Options()
) -> list[StreamingQuery]:
    """All queries at their configured pace."""
    model = load_model(settings.paths.model)
    features = build_feature_stream(spark, settings, bus, options=options)
    scoring = start_scoring(
        predictions_of(features, model), settings, every=settings.stream.trigger_predictions
    )
    return [
        scoring,
        *start_totals(spark, settings, options, paced=True),
        start_publishing(spark, settings, bus, paced=True),
        *start_publishing_totals(spark, settings, bus, paced=True),
    ]


def run(spark: SparkSession, settings: Settings, bus: Bus, **kwargs) -> None:
    supervise(spark, start_queries(spark, settings, bus, **kwargs))


def catch_up(
    spark: SparkSession, settings: Settings, bus: Bus, *, options: Options = Options()
) -> list[StreamingQuery]:
    """Work off what is on the bus and stop: scoring first, then what derives from it."""
    model = load_model(settings.paths.model)
    features = build_feature_stream(spark, settings, bus, options=options)
    scoring = finish(start_scoring(predictions_of(features, model), settings, every=None))
    derived = [
        *start_totals(spark, settings, options, paced=False),
        start_publishing(spark, settings, bus, paced=False),
    ]
    totals = [finish(query) for query in derived]
    return [scoring, *totals, *map(finish, start_publishing_totals(spark, settings, bus, paced=False))]
