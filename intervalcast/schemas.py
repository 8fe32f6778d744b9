"""Declared schemas of the domain tables and messages; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

INT, DOUBLE, STRING, TIME = T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType()


def table(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns in the given order."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names, order and types are the file and message formats.
METERS = table(building_id=INT, meter_type=STRING, ts=TIME, value=DOUBLE, row_id=INT)

BUILDINGS = table(
    site_id=INT,
    building_id=INT,
    primary_use=STRING,
    square_feet=INT,
    floor_count=INT,
    row_id=INT,
    year_built=INT,
    latent_y=DOUBLE,
    latent_s=DOUBLE,
    latent_r=DOUBLE,
)

CONDITION_COLS = [
    "air_temperature",
    "cloud_coverage",
    "dew_temperature",
    "sea_level_pressure",
    "wind_direction",
    "wind_speed",
]


def _conditions(time_col: str) -> T.StructType:
    """Site, time and the condition columns, in file order."""
    return table(**{"site_id": INT, time_col: TIME}, **dict.fromkeys(CONDITION_COLS, DOUBLE))


WEATHER = _conditions("timestamp")

# One element of a message, and the message itself.
WEATHER_EVENT = _conditions("event_time")
WEATHER_BATCH = table(batch_ts=TIME, rows=T.ArrayType(WEATHER_EVENT))

# The older feed: every field is text, an empty string stands for a missing value,
# and the time is Unix seconds.
LOOSE_EVENT = table(
    **dict.fromkeys(["site_id", "timestamp", *CONDITION_COLS, "weather_ts"], STRING)
)
LOOSE_BATCH = table(ts=STRING, rows=T.ArrayType(LOOSE_EVENT))

PREDICTION = table(
    event_time=TIME, site_id=INT, building_id=INT, meter_type=STRING, prediction=DOUBLE
)

# A bus record as it is stored and sent: key and value are text once decoded.
BUS_RECORD = table(key=STRING, value=STRING)
STORED_RECORD = table(key=STRING, value=STRING, sent_at=TIME, sent_no=T.LongType())

WINDOW = table(start=TIME, end=TIME)
HOURLY_TOTAL = table(window=WINDOW, building_id=INT, total_energy=DOUBLE)
DAILY_TOTAL = table(window=WINDOW, site_id=INT, daily_total_energy=DOUBLE)
