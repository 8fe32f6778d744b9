"""Parsing, JSON, CSV, ordering and messages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    iso_timestamp,
    loose_double,
    loose_int,
    parse_row,
    row_json,
    seconds_between,
    unix_timestamp,
)
from ..operators.messages import from_messages, to_messages, with_position
from ..operators.resample import interval_mean, interval_sum
from ..schemas import DOUBLE, METERS, STRING, TIME, WEATHER, table as schema
from ..sources.bus import Bus, decode, encode
from ..sources.scratch import new_folder
from ..sources.sinks import append_parquet
from ..sources.tables import (
    accepted_rows,
    csv_to_parquet,
    read_csv,
    read_parquet,
    rejected_lines,
    screened_csv,
)
from ..streaming.runner import finish
from ..streaming.scoring import events_from_bus
from .registry import entities, floor_sql, query, rounded, table


@query(
    """SELECT event_id,
              CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE value END AS number,
              CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE CAST(user_id AS INTEGER) END AS whole
       FROM events"""
)
def clean_cast(spark, sf_dir):
    """Text fields of which every fourth is blank and every fourth is no number."""
    broken = F.when(F.col("event_id") % 4 == 0, "").when(F.col("event_id") % 4 == 1, "abc")
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(broken, F.col("value").cast("string")).alias("number"),
        F.coalesce(broken, F.col("user_id").cast("string")).alias("whole"),
    )
    return text.select(
        "event_id",
        loose_double(F.col("number")).alias("number"),
        loose_int(F.col("whole")).alias("whole"),
    )


@query("SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
def unix_ts(spark, sf_dir):
    text = table(spark, sf_dir, "events").select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("seconds")
    )
    return text.select("event_id", unix_timestamp(F.col("seconds")).alias("event_time"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS event_time FROM events")
def iso_ts(spark, sf_dir):
    """ISO text with offsets; every fifth is no time."""
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    text = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 5 == 0, "yesterday").otherwise(iso).alias("iso")
    )
    return text.select("event_id", iso_timestamp(F.col("iso")).alias("event_time"))


@query(
    """SELECT event_id,
              (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 1e6 AS age
       FROM events"""
)
def seconds_old(spark, sf_dir):
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    events = table(spark, sf_dir, "events")
    return events.select("event_id", seconds_between(now, F.col("ts")).alias("age"))


@query(
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type
              || '","user_id":' || user_id || '}' AS value
       FROM events"""
)
def json_out(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", row_json("event_id", "event_type", "user_id").alias("value"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def json_in(spark, sf_dir):
    parsed = parse_row(F.col("props"), schema(k=DOUBLE))
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS key, l_partkey AS part
       FROM lineitem"""
)
def bytes_in(spark, sf_dir):
    """Keys and values that arrive as bytes."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    raw = table(spark, sf_dir, "lineitem").select(
        F.encode(key, "UTF-8").alias("key"),
        F.encode(F.col("l_partkey").cast("string"), "UTF-8").alias("value"),
    )
    return decode(raw).select("key", F.col("value").cast("bigint").alias("part"))


@query("SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events")
def time_order(spark, sf_dir):
    """Place of every event in time order, without a global sort in one task."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_position(events, ["ts", "event_id"]).select("event_id", "position")


EVENT = schema(
    event_id=T.LongType(), event_time=TIME, user_id=T.LongType(), event_type=STRING, value=DOUBLE
)
BATCH = schema(batch_ts=TIME, rows=T.ArrayType(EVENT))


def event_messages(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "event_time", F.col("ts").cast("timestamp")
    )
    return to_messages(
        events,
        order_by=["event_time", "event_id"],
        fields=EVENT.fieldNames(),
        batch_ts=F.lit("2024-02-01").cast("timestamp"),
    )


@query(
    """SELECT message_no, count(*) AS rows, min(ts) AS first_time, max(ts) AS last_time
       FROM (SELECT ts, (row_number() OVER (ORDER BY ts, event_id) - 1) // 120 AS message_no
             FROM events) GROUP BY 1"""
)
def messages(spark, sf_dir):
    """Rows and time range of each published message."""
    opened = from_messages(event_messages(spark, sf_dir), BATCH, extra=["message_no"])
    return opened.groupBy("message_no").agg(
        F.count("*").alias("rows"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
    )


@query("SELECT event_id, ts AS event_time, user_id, event_type, value FROM events")
def envelope_round_trip(spark, sf_dir):
    """Published as messages and read back: nothing is lost, times to the microsecond."""
    return from_messages(event_messages(spark, sf_dir), BATCH)


@query("SELECT event_id, ts AS event_time, user_id, event_type, value FROM events")
def bus_round_trip(spark, sf_dir):
    """The same through a bus: sent as records, subscribed as a stream, stored."""
    folder = new_folder(spark, "bus")
    bus = Bus("files", folder)
    sent = event_messages(spark, sf_dir).select(
        F.col("message_no").cast("string").alias("key"), "value"
    )
    bus.send(sent, "feed")
    events = events_from_bus(bus.subscribe(spark, "feed"), BATCH, ts="event_time", delay="10 minutes")
    finish(append_parquet(events, f"{folder}/events", f"{folder}/checkpoint"))
    return read_parquet(spark, f"{folder}/events", EVENT)


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS segment FROM customer")
def keyed_records(spark, sf_dir):
    """Rows as keyed JSON records."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    parsed = parse_row(F.col("value"), schema(c_mktsegment=STRING))
    return encode(customers, key="c_custkey").select(
        "key", parsed["c_mktsegment"].alias("segment")
    )


def _csv(df, spark, name):
    folder = new_folder(spark, name)
    df.write.option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(folder)
    return folder


@query(
    """SELECT event_id % 10 NOT IN (2, 3, 7) AS accepted,
              CASE WHEN event_id % 10 NOT IN (2, 3, 7) THEN event_id END AS row_id,
              CASE WHEN event_id % 10 NOT IN (2, 3, 5, 7) THEN event_type END AS meter_type,
              CASE event_id % 10 WHEN 2 THEN concat_ws(',', event_id, event_type, 'abc')
                   WHEN 3 THEN concat_ws(',', event_id, event_type, '1.5', 'more')
                   WHEN 7 THEN event_id::VARCHAR END AS line,
              CASE event_id % 10 WHEN 2 THEN 'value' WHEN 3 THEN '' WHEN 7 THEN 'meter_type,value' END
                AS empty
       FROM events"""
)
def csv_rejects(spark, sf_dir):
    """All lines of a file: rows of the schema, and lines with a bad, a missing or one more cell.

    Of every ten lines three are damaged and one has an empty cell, which is none of these.
    """
    kind = F.col("event_id") % 10
    line = (
        F.when(kind == 2, F.concat_ws(",", "event_id", "event_type", F.lit("abc")))
        .when(kind == 3, F.concat_ws(",", "event_id", "event_type", F.lit("1.5"), F.lit("more")))
        .when(kind == 7, F.col("event_id").cast("string"))
        .when(kind == 5, F.concat_ws(",", "event_id", F.lit(""), "value"))
        .otherwise(F.concat_ws(",", "event_id", "event_type", "value"))
    )
    folder = new_folder(spark, "damaged")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(folder)
    shape = schema(row_id=T.LongType(), meter_type=STRING, value=DOUBLE)
    rows = screened_csv(spark, folder, shape, header=False)
    sound = accepted_rows(rows).select(
        F.lit(True).alias("accepted"), "row_id", "meter_type", *[F.lit(None).cast("string").alias(c) for c in ("line", "empty")]
    )
    bad = rejected_lines(rows).select(
        F.lit(False).alias("accepted"),
        F.lit(None).cast("bigint").alias("row_id"),
        F.lit(None).cast("string").alias("meter_type"),
        "line",
        F.array_join("empty", ",").alias("empty"),
    )
    return sound.unionByName(bad)


@query(
    f"""SELECT CAST(user_id AS INTEGER) AS building_id, event_type AS meter_type,
               {floor_sql()} AS interval_start, round(sum(value), 4) + 0.0 AS total
        FROM events GROUP BY ALL"""
)
def csv_meters(spark, sf_dir):
    """Events as a meters file, scanned with its schema, converted and resampled."""
    source = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("building_id"),
        F.col("event_type").alias("meter_type"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        F.col("event_id").alias("row_id"),
    )
    meters = csv_to_parquet(
        spark, _csv(source, spark, "meters"), METERS, new_folder(spark, "meters-parquet")
    )
    summed = interval_sum(
        meters, keys=["building_id", "meter_type"], ts="ts", value="value", total="total"
    )
    return rounded(summed, total=4)


@query(
    """SELECT CAST(c_nationkey AS INTEGER) AS site_id, CAST(c_custkey AS INTEGER) AS building_id,
              c_mktsegment AS primary_use, greatest(c_acctbal, 0.0) AS latent_y
       FROM customer"""
)
def csv_buildings(spark, sf_dir):
    """Entities as a file with gaps in it."""
    shape = schema(
        site_id=T.IntegerType(), building_id=T.IntegerType(), primary_use=STRING, latent_y=DOUBLE
    )
    source = entities(spark, sf_dir).select("site_id", "user_id", "segment", "area")
    return read_csv(spark, _csv(source.toDF(*shape.fieldNames()), spark, "buildings"), shape)


@query(
    f"""SELECT c_nationkey AS site_id, {floor_sql()} AS interval_start,
               round(avg(value), 7) + 0.0 AS air_temperature
        FROM events JOIN customer ON c_custkey = user_id GROUP BY ALL"""
)
def csv_weather(spark, sf_dir):
    """Events as a weather file with one measured column, the others empty."""
    sites = entities(spark, sf_dir).select("user_id", "site_id")
    source = (
        table(spark, sf_dir, "events")
        .join(sites, "user_id")
        .select(
            "site_id",
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("value").alias("air_temperature"),
            *[F.lit(None).cast("double").alias(name) for name in WEATHER.fieldNames()[3:]],
        )
    )
    weather = read_csv(spark, _csv(source, spark, "weather"), WEATHER)
    means = interval_mean(
        weather, keys=["site_id"], ts="timestamp", values=["air_temperature"]
    )
    return rounded(means, air_temperature=7)
