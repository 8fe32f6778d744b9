"""From messages to scored records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import loose_double, loose_int, unix_timestamp
from ..operators.enrich import attach, fan_out, fan_out_by
from ..operators.messages import from_messages
from ..schemas import CONDITION_COLS, LOOSE_BATCH
from .windows import with_event_time


def events_from_bus(
    messages: DataFrame, schema: T.StructType, *, ts: str, delay: str | None
) -> DataFrame:
    """One row per event of the messages, with event time and watermark."""
    return with_event_time(from_messages(messages, schema), ts, delay)


def loose_events(messages: DataFrame, *, delay: str | None = None) -> DataFrame:
    """Events of the all-text feed with types: blanks and garbage become null."""
    rows = from_messages(messages, LOOSE_BATCH)
    typed = rows.select(
        loose_int(F.col("site_id")).alias("site_id"),
        unix_timestamp(F.col("weather_ts")).alias("event_time"),
        *[loose_double(F.col(name)).alias(name) for name in CONDITION_COLS],
    )
    return typed.withWatermark("event_time", delay) if delay else typed


def expand(
    events: DataFrame,
    entities: DataFrame,
    on: Sequence[str],
    *,
    category: str,
    categories: Sequence[str],
    owned: DataFrame | None = None,
    entity: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """Each event once per entity of its site and category.

    Events of unknown sites stay, with null entity columns and ``is_matched`` false.  All
    categories are taken unless ``owned`` lists those each entity has.  ``spread`` deals a
    busy site's events to that many tasks.
    """
    matched = attach(events, entities, on, matched="is_matched", spread=spread)
    if owned is None:
        return fan_out(matched, category, categories)
    return fan_out_by(matched, owned, [entity], category=category)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """Predictions next to the columns in ``keep``; for tables and streams."""
    return model.transform(df).select(*keep, "prediction")
