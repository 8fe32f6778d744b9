"""The operators bound to the building-energy tables of ``schemas``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import attach
from ..operators.features import add_interval_features, add_size_features
from ..operators.preprocess import FeatureSpec
from ..operators.resample import interval_mean, interval_sum
from ..schemas import BUILDINGS, CONDITION_COLS, METERS, WEATHER
from ..settings import Settings
from ..sources.tables import read_csv, rejected_lines, screened_csv

# The names and the order of the model's inputs.
FEATURES = FeatureSpec(
    numeric=(
        "log_square_feet",
        "floor_count",
        "decade",
        "air_temperature",
        "dew_temperature",
        "sea_level_pressure",
        "wind_speed",
        "cloud_coverage",
        "latent_y",
        "latent_s",
        "latent_r",
    ),
    angles=(("wind_dir", "wind_direction"),),
    categorical=("primary_use", "meter_type"),
    order=(
        "log_square_feet",
        "floor_count",
        "decade",
        "air_temperature",
        "dew_temperature",
        "sea_level_pressure",
        "wind_speed",
        "cloud_coverage",
        "wind_dir_sin",
        "wind_dir_cos",
        "time_sin",
        "time_cos",
        "month_sin",
        "month_cos",
        "primary_use",
        "meter_type",
        "latent_y",
        "latent_s",
        "latent_r",
    ),
)

# One row of the training frame per combination of these.
GRAIN = ["building_id", "meter_type", "interval_start"]


def load_meters(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_csv(spark, settings.paths.meters, METERS)


def load_buildings(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_csv(spark, settings.paths.buildings, BUILDINGS)


def load_serving_buildings(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_csv(spark, settings.paths.buildings_stream, BUILDINGS)


def load_weather(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_csv(spark, settings.paths.weather, WEATHER)


def screen_inputs(spark: SparkSession, settings: Settings, quarantine: str) -> DataFrame:
    """Rows per input file that were accepted and rejected; the lines of the latter are kept.

    The loads above take what can be read of a line; this says what could not.
    """
    paths = settings.paths
    counts = []
    for name, path, schema in (
        ("meters", paths.meters, METERS),
        ("buildings", paths.buildings, BUILDINGS),
        ("weather", paths.weather, WEATHER),
    ):
        screened = screened_csv(spark, path, schema)
        rejected_lines(screened).write.mode("overwrite").parquet(f"{quarantine}/input={name}")
        counts.append(
            screened.agg(
                F.lit(name).alias("input"),
                F.count_if(F.col("reject").isNull()).alias("accepted"),
                F.count_if(F.col("reject").isNotNull()).alias("rejected"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


def aggregate_meters(meters: DataFrame) -> DataFrame:
    return interval_sum(
        meters,
        keys=["building_id", "meter_type"],
        ts="ts",
        value="value",
        total="energy_consumption",
    )


def aggregate_weather(weather: DataFrame, *, circular: bool = False) -> DataFrame:
    """Interval means per site; ``circular`` averages the wind direction on the circle."""
    return interval_mean(
        weather,
        keys=["site_id"],
        ts="timestamp",
        values=CONDITION_COLS,
        angles=["wind_direction"] if circular else [],
    )


def engineer_features(df: DataFrame, ts: str) -> DataFrame:
    """All derived columns; the one definition for training and serving."""
    return add_size_features(
        add_interval_features(df, ts), size="square_feet", year="year_built"
    )


def training_frame(meters: DataFrame, buildings: DataFrame, weather: DataFrame) -> DataFrame:
    """Labelled rows: interval totals with building attributes and interval weather."""
    described = attach(aggregate_meters(meters), buildings, ["building_id"])
    complete = attach(described, aggregate_weather(weather), ["site_id", "interval_start"])
    return engineer_features(complete, "interval_start")


def build_training_frame(spark: SparkSession, settings: Settings) -> DataFrame:
    return training_frame(
        load_meters(spark, settings), load_buildings(spark, settings), load_weather(spark, settings)
    )
