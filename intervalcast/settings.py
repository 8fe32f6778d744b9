"""Run settings.

Each field names the environment variable that overrides it.  The environment is
read when ``load_settings`` is called, so a test or a job can pass its own mapping
and nothing has to be reloaded.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields


def _setting(default, env: str):
    return field(default=default, metadata={"env": env})


class _FromEnv:
    """Builds a dataclass from a mapping, converting text to the field's type."""

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None):
        env = os.environ if env is None else env
        given = {}
        for item in fields(cls):
            text = env.get(item.metadata.get("env", ""))
            if text is not None:
                given[item.name] = type(item.default)(text)
        return cls(**given)


# Variable names, defaults, file and topic names below are the formats
# and defaults a deployment already relies on.
@dataclass(frozen=True)
class Paths(_FromEnv):
    data_root: str = _setting("data", "DATA_ROOT")
    artifact_root: str = _setting("artifacts", "ARTIFACT_ROOT")

    def data(self, name: str) -> str:
        return f"{self.data_root}/{name}"

    def output(self, name: str) -> str:
        return f"{self.artifact_root}/output/{name}"

    def checkpoint(self, query: str) -> str:
        """Each sink has a checkpoint of its own."""
        return f"{self.artifact_root}/checkpoint/{query}"

    @property
    def meters(self) -> str:
        return self.data("meters.csv")

    @property
    def buildings(self) -> str:
        return self.data("building_information.csv")

    @property
    def buildings_stream(self) -> str:
        return self.data("new_building_information.csv")

    @property
    def weather(self) -> str:
        return self.data("weather.csv")

    @property
    def model(self) -> str:
        return f"{self.artifact_root}/model"


@dataclass(frozen=True)
class BusSettings(_FromEnv):
    bootstrap_servers: str = _setting("localhost:9092", "KAFKA_BOOTSTRAP_SERVERS")
    weather_topic: str = _setting("weather-stream", "KAFKA_WEATHER_TOPIC")
    predictions_topic: str = _setting("predictions-stream", "KAFKA_PREDICTIONS_TOPIC")
    hourly_topic: str = _setting("hourly-stream", "KAFKA_HOURLY_TOPIC")
    daily_topic: str = _setting("daily-stream", "KAFKA_DAILY_TOPIC")
    spark_kafka_package: str = _setting(
        "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2", "SPARK_KAFKA_PACKAGE"
    )


@dataclass(frozen=True)
class SparkSettings(_FromEnv):
    app_name: str = _setting("intervalcast", "SPARK_APP_NAME")
    master: str = _setting("", "SPARK_MASTER")  # empty: the launcher decides
    timezone: str = _setting("UTC", "SPARK_TIMEZONE")
    max_partition_bytes: str = _setting("128m", "SPARK_MAX_PARTITION_BYTES")
    shuffle_partitions: int = _setting(0, "SPARK_SHUFFLE_PARTITIONS")  # 0: leave as set


@dataclass(frozen=True)
class ModelSettings(_FromEnv):
    label_col: str = _setting("energy_consumption", "MODEL_LABEL_COL")
    seed: int = _setting(2025, "MODEL_SEED")
    sample_fraction: float = _setting(1.0, "MODEL_SAMPLE_FRACTION")
    train_ratio: float = _setting(0.8, "MODEL_TRAIN_RATIO")
    outlier_sigma: float = _setting(3.0, "MODEL_OUTLIER_SIGMA")
    cv_folds: int = _setting(3, "MODEL_CV_FOLDS")


@dataclass(frozen=True)
class StreamSettings(_FromEnv):
    watermark: str = _setting("10 minutes", "STREAM_WATERMARK")
    trigger_predictions: str = _setting("5 seconds", "STREAM_TRIGGER_PRED")
    trigger_hourly: str = _setting("1 minute", "STREAM_TRIGGER_HOURLY")
    trigger_daily: str = _setting("5 minutes", "STREAM_TRIGGER_DAILY")
    hourly_window: str = _setting("6 hours", "STREAM_HOURLY_WINDOW")
    daily_window: str = _setting("1 day", "STREAM_DAILY_WINDOW")
    files_per_trigger: int = _setting(1000, "STREAM_FILES_PER_TRIGGER")


@dataclass(frozen=True)
class Settings:
    paths: Paths = field(default_factory=Paths)
    bus: BusSettings = field(default_factory=BusSettings)
    spark: SparkSettings = field(default_factory=SparkSettings)
    model: ModelSettings = field(default_factory=ModelSettings)
    stream: StreamSettings = field(default_factory=StreamSettings)

    def as_dict(self) -> dict:
        return asdict(self)


# Chilled water, electricity, hot water, steam.
METER_TYPES = ["c", "e", "h", "s"]


def load_settings(env: Mapping[str, str] | None = None) -> Settings:
    return Settings(
        paths=Paths.from_env(env),
        bus=BusSettings.from_env(env),
        spark=SparkSettings.from_env(env),
        model=ModelSettings.from_env(env),
        stream=StreamSettings.from_env(env),
    )
