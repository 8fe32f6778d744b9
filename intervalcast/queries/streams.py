"""Streams over the files of a table.  Each query works off all of it and stops."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.enrich import attach, fan_out
from ..operators.monitor import BOUNDS, bound_name, bucket_rate, trailing_rate
from ..operators.resample import interval_sum
from ..operators.sketches import lag_sketches, merged, quantiles
from ..plans.serve import republish as republish_plan
from ..schemas import table as schema
from ..settings import METER_TYPES
from ..sources.bus import Bus, encode
from ..sources.scratch import new_folder
from ..sources.sinks import append_parquet, memory_table, overwrite_parquet
from ..sources.tables import read_parquet, stream_parquet
from ..sources.upsert import read_upserted, upsert_parquet
from ..streaming.late import corrected, start_corrected_totals, total_schema
from ..streaming.numbering import numbered_rows, start_numbering
from ..streaming.progress import ProgressLog, runs
from ..streaming.runner import finish
from ..streaming.windows import flat_window, window_means, window_totals, with_event_time
from .profile import EXACT_K
from .registry import ENTITIES_SQL, entities, floor_sql, query, readings, rounded, stream_of, table

DELAY = "10 minutes"
CLOSED_SQL = "(SELECT max(ts) - INTERVAL '10 minutes' FROM events)"


def events_stream(spark, sf_dir, *, zone=None):
    return with_event_time(stream_of(spark, sf_dir, "events"), "ts", DELAY, zone=zone)


def stored(spark, stream, name):
    """Run an append query to its end and read what it wrote."""
    folder = new_folder(spark, name)
    finish(append_parquet(stream, f"{folder}/rows", f"{folder}/checkpoint"))
    return read_parquet(spark, f"{folder}/rows", stream.schema)


@query(
    f"""SELECT event_id, ts, e.user_id, value, site_id, segment, area,
               site_id IS NOT NULL AS is_matched
        FROM events e LEFT JOIN ({ENTITIES_SQL}) c USING (user_id)"""
)
def stream_enriched(spark, sf_dir):
    events = events_stream(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    joined = attach(events, entities(spark, sf_dir), ["user_id"], matched="is_matched")
    return stored(spark, joined, "enriched")


@query(
    """SELECT event_id, m.meter_type
       FROM events CROSS JOIN (VALUES ('c'), ('e'), ('h'), ('s')) m(meter_type)"""
)
def stream_fan_out(spark, sf_dir):
    events = events_stream(spark, sf_dir).select("event_id")
    return stored(spark, fan_out(events, "meter_type", METER_TYPES), "fan-out")


@query(
    f"""SELECT w AS window_start, w + INTERVAL '6 hours' AS window_end, user_id,
               round(sum(value), 4) + 0.0 AS total
        FROM (SELECT *, {floor_sql()} AS w FROM events)
        GROUP BY w, user_id HAVING w + INTERVAL '6 hours' <= {CLOSED_SQL}"""
)
def stream_window_6h(spark, sf_dir):
    """Append mode: only windows the watermark has passed are there."""
    totals = window_totals(
        events_stream(spark, sf_dir),
        ts="ts",
        length="6 hours",
        keys=["user_id"],
        value="value",
        total="total",
    )
    return rounded(flat_window(stored(spark, totals, "six-hours")), total=4)


@query(
    f"""SELECT w AS window_start, w + INTERVAL '1 day' AS window_end, site_id,
               round(sum(value), 4) + 0.0 AS total
        FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS w FROM events)
        LEFT JOIN ({ENTITIES_SQL}) USING (user_id)
        GROUP BY w, site_id HAVING w + INTERVAL '1 day' <= {CLOSED_SQL}"""
)
def stream_window_1d(spark, sf_dir):
    """Daily totals per site of the enriched stream."""
    sites = entities(spark, sf_dir).select("user_id", "site_id")
    totals = window_totals(
        attach(events_stream(spark, sf_dir), sites, ["user_id"], spread=8),
        ts="ts",
        length="1 day",
        keys=["site_id"],
        value="value",
        total="total",
    )
    return rounded(flat_window(stored(spark, totals, "days")), total=4)


@query(
    f"""SELECT w AS window_start, w + INTERVAL '1 day' AS window_end, event_type,
               round(avg(value), 6) + 0.0 AS mean
        FROM (SELECT *, date_trunc('day', ts + INTERVAL '11 hours')::TIMESTAMP AS w FROM events)
        GROUP BY w, event_type
        HAVING w + INTERVAL '1 day' <= {CLOSED_SQL} + INTERVAL '11 hours'"""
)
def stream_window_local(spark, sf_dir):
    """Mean per local day in Melbourne, eleven hours ahead in January."""
    means = window_totals(
        events_stream(spark, sf_dir, zone="Australia/Melbourne"),
        ts="local_time",
        length="1 day",
        keys=["event_type"],
        value="value",
        total="mean",
        how="avg",
    )
    return rounded(flat_window(stored(spark, means, "local-days")), mean=6)


@query(
    f"""SELECT w AS ts, event_type, round(avg(value), 7) + 0.0 AS value
        FROM (SELECT event_type, value, {floor_sql()} AS w FROM events)
        GROUP BY w, event_type HAVING w + INTERVAL '6 hours' <= {CLOSED_SQL}"""
)
def stream_window_means(spark, sf_dir):
    """Conditions averaged per window before anything else is done with them."""
    means = window_means(
        events_stream(spark, sf_dir),
        ts="ts",
        length="6 hours",
        keys=["event_type"],
        values=["value"],
    )
    return rounded(stored(spark, means, "window-means"), value=7)


@query(
    f"""SELECT w AS window_start, w + INTERVAL '6 hours' AS window_end, user_id,
               round(sum(value), 4) + 0.0 AS total
        FROM (SELECT *, {floor_sql()} AS w FROM events) GROUP BY w, user_id"""
)
def stream_window_complete(spark, sf_dir):
    """Complete mode, the result replaced at each trigger: open windows are there too."""
    folder = new_folder(spark, "complete")
    totals = window_totals(
        with_event_time(stream_of(spark, sf_dir, "events"), "ts"),
        ts="ts",
        length="6 hours",
        keys=["user_id"],
        value="value",
        total="total",
    )
    finish(overwrite_parquet(totals, f"{folder}/rows", f"{folder}/checkpoint"))
    return rounded(flat_window(read_parquet(spark, f"{folder}/rows", totals.schema)), total=4)


@query(
    f"""SELECT w AS window_start, w + INTERVAL '6 hours' AS window_end, user_id,
               round(sum(value), 4) + 0.0 AS total
        FROM (SELECT *, {floor_sql()} AS w FROM events) GROUP BY w, user_id"""
)
def stream_window_upserted(spark, sf_dir):
    """All windows, open and closed, of a stream that arrives in two halves.

    State holds the open windows only; the table is updated where totals have changed.
    """
    folder = new_folder(spark, "upserted")
    events = table(spark, sf_dir, "events").select("ts", "user_id", "value")
    first = F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    totals = None
    for part in (events.filter(first), events.filter(~first)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_parquet(spark, f"{folder}/landing", events.schema)
        totals = window_totals(
            with_event_time(stream, "ts", DELAY),
            ts="ts",
            length="6 hours",
            keys=["user_id"],
            value="value",
            total="total",
        )
        keys = ["window", "user_id"]
        finish(upsert_parquet(totals, f"{folder}/rows", f"{folder}/checkpoint", keys=keys, buckets=8))
    return rounded(flat_window(read_upserted(spark, f"{folder}/rows", totals.schema)), total=4)


@query(
    """SELECT date_trunc('day', ts)::TIMESTAMP AS window_start,
              date_trunc('day', ts)::TIMESTAMP + INTERVAL '1 day' AS window_end, event_type,
              round(sum(value), 4) + 0.0 AS total
       FROM events GROUP BY ALL"""
)
def stream_memory(spark, sf_dir):
    """Daily totals per event type in a session table, read with SQL."""
    totals = window_totals(
        with_event_time(stream_of(spark, sf_dir, "events"), "ts"),
        ts="ts",
        length="1 day",
        keys=["event_type"],
        value="value",
        total="total",
    )
    name = "daily_" + new_folder(spark, "t").rpartition("-")[2]
    finish(memory_table(totals, name, mode="complete"))
    return rounded(flat_window(spark.sql(f"SELECT * FROM {name}")), total=4)


SPLIT_AT = "2024-01-16"


@query(
    f"""WITH e AS (SELECT *, {floor_sql()} AS w,
                          ts < TIMESTAMP '{SPLIT_AT}' AND event_id % 10 <> 0 AS in_time FROM events),
             m AS (SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM e WHERE in_time)
        SELECT w AS window_start, w + INTERVAL '6 hours' AS window_end, event_type,
               round(sum(value), 4) + 0.0 AS total
        FROM e, m WHERE in_time OR w + INTERVAL '6 hours' > mark
        GROUP BY w, event_type HAVING w + INTERVAL '6 hours' <= {CLOSED_SQL}"""
)
def stream_late(spark, sf_dir):
    """The first half of the events arrives with every tenth held back; those come with the
    second half, when most of their windows have closed, and are dropped there.

    Two runs over a growing folder with one checkpoint: the second is a restart.
    """
    folder = new_folder(spark, "late")
    events = table(spark, sf_dir, "events")
    in_time = (F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")) & (F.col("event_id") % 10 != 0)
    totals = None
    for part in (events.filter(in_time), events.filter(~in_time)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_parquet(spark, f"{folder}/landing", events.schema)
        totals = window_totals(
            with_event_time(stream, "ts", DELAY),
            ts="ts",
            length="6 hours",
            keys=["event_type"],
            value="value",
            total="total",
        )
        finish(append_parquet(totals, f"{folder}/rows", f"{folder}/checkpoint"))
    rows = read_parquet(spark, f"{folder}/rows", totals.schema)
    return rounded(flat_window(rows), total=4)


@query(
    f"""WITH e AS (SELECT *, {floor_sql()} AS w,
                          ts < TIMESTAMP '{SPLIT_AT}' AND event_id % 10 <> 0 AS in_time FROM events),
             m AS (SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM e WHERE in_time),
             l AS (SELECT *, NOT in_time AND w + INTERVAL '6 hours' <= mark AS late FROM e, m)
        SELECT w AS window_start, w + INTERVAL '6 hours' AS window_end, event_type,
               round(sum(value), 4) + 0.0 AS total,
               round(coalesce(sum(value) FILTER (late), 0), 4) + 0.0 AS late_total,
               count(*) AS records, count(*) FILTER (late) AS late_records
        FROM l GROUP BY w, event_type"""
)
def stream_corrected(spark, sf_dir):
    """The arrivals of ``stream_late``, with what missed its window kept and added up."""
    folder = new_folder(spark, "corrected")
    events = table(spark, sf_dir, "events")
    in_time = (F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")) & (F.col("event_id") % 10 != 0)
    names = {"keys": ["event_type"], "total": "total"}
    for part in (events.filter(in_time), events.filter(~in_time)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_parquet(spark, f"{folder}/landing", events.schema)
        finish(
            start_corrected_totals(
                stream,
                f"{folder}/totals",
                f"{folder}/checkpoint",
                ts="ts",
                delay=DELAY,
                length="6 hours",
                value="value",
                buckets=4,
                **names,
            )
        )
    shape = total_schema(events, "ts", **names)
    found = flat_window(corrected(spark, f"{folder}/totals", shape, **names))
    return rounded(found, total=4, late_total=4)


TOTAL = schema(
    user_id=T.LongType(),
    event_type=T.StringType(),
    interval_start=T.TimestampType(),
    total=T.DoubleType(),
)


@query(
    f"""SELECT user_id, event_type, {floor_sql()} AS interval_start,
               round(sum(value), 4) + 0.0 AS total
        FROM events GROUP BY ALL"""
)
def republish(spark, sf_dir):
    """Stored totals to a topic with the columns of their own schema, and back."""
    folder = new_folder(spark, "republish")
    zoned = readings(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    totals = interval_sum(
        zoned, keys=["user_id", "event_type"], ts="ts", value="value", total="total"
    )
    totals.write.parquet(f"{folder}/totals")
    bus = Bus("files", folder)
    finish(
        republish_plan(
            spark,
            bus,
            path=f"{folder}/totals",
            schema=TOTAL,
            topic="totals-stream",
            checkpoint=f"{folder}/checkpoint",
            available_now=True,
        )
    )
    parsed = F.from_json("value", TOTAL).alias("row")
    return rounded(bus.read(spark, "totals-stream").select(parsed).select("row.*"), total=4)


@query(
    f"""SELECT part, user_id, event_type, value
        FROM (SELECT *, 'latest' AS part FROM events WHERE ts >= TIMESTAMP '{SPLIT_AT}'
              UNION ALL SELECT *, 'earliest' FROM events
              UNION ALL SELECT *, 'restarted' FROM events WHERE ts >= TIMESTAMP '{SPLIT_AT}')"""
)
def bus_positions(spark, sf_dir):
    """Readers of a files topic that begin at its start, at its end, and go on where they began.

    The topic is sent in two halves.  One reader begins between them and is run twice.
    """
    folder = new_folder(spark, "positions")
    bus = Bus("files", folder)
    events = table(spark, sf_dir, "events")
    first = F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    records = lambda rows: encode(rows.select("user_id", "event_type", "value"))
    parts = []

    def read(part, starting, reader, checkpoint):
        stream = bus.subscribe(spark, "readings", starting=starting, reader=reader)
        rows = f"{folder}/_rows/{part}"
        finish(append_parquet(stream, rows, f"{folder}/_checkpoints/{checkpoint}"))
        return read_parquet(spark, rows, stream.schema).withColumn("part", F.lit(part))

    bus.send(records(events.filter(first)), "readings")
    read("latest", "latest", "a", "a")
    bus.send(records(events.filter(~first)), "readings")
    parts.append(read("latest", "latest", "a", "a"))
    parts.append(read("earliest", "earliest", "c", "c"))
    # A new checkpoint of the same reader: it begins where it first began.
    parts.append(read("restarted", "earliest", "a", "a-again"))
    shape = "user_id BIGINT, event_type STRING, value DOUBLE"
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select("part", F.from_json("value", shape).alias("r")).select("part", "r.*")


@query(
    f"""WITH c AS (SELECT {CLOSED_SQL} AS mark)
        SELECT 'days' AS query, count(*) AS input_rows, 0 AS late, false AS is_active,
               date_trunc('milliseconds', any_value(mark)) AS watermark,
               count(DISTINCT (date_trunc('day', ts), event_type)) FILTER (
                 date_trunc('day', ts) + INTERVAL '1 day' > mark) AS open_totals
        FROM events, c"""
)
def stream_progress(spark, sf_dir):
    """What a windowed query did, from the table of its reports, after its end."""
    folder = new_folder(spark, "progress")
    totals = window_totals(
        events_stream(spark, sf_dir),
        ts="ts",
        length="1 day",
        keys=["event_type"],
        value="value",
        total="total",
    )
    with ProgressLog(spark, f"{folder}/reports", names={"days"}) as log:
        finish(append_parquet(totals, f"{folder}/rows", f"{folder}/checkpoint", name="days"))
        log.settle()
    return runs(spark, f"{folder}/reports").select(
        "query",
        "input_rows",
        F.col("dropped_rows").cast("int").alias("late"),
        F.col("active").alias("is_active"),
        "watermark",
        F.col("state_rows").alias("open_totals"),
    )


@query(
    f"""SELECT e AS window_end, event_type, count(*) AS records, round(count(*) / 300.0, 6) AS rate
        FROM (SELECT event_type, unnest(generate_series(0, 4)) AS i,
                     time_bucket(INTERVAL '1 minute', ts, TIMESTAMP '1970-01-01')
                       + INTERVAL '1 minute' + i * INTERVAL '1 minute' AS e
              FROM events)
        GROUP BY ALL HAVING e <= {CLOSED_SQL}"""
)
def stream_rate(spark, sf_dir):
    """Records per second over five minutes, every minute, as windows close."""
    rates = trailing_rate(
        events_stream(spark, sf_dir), ts="ts", length=300, slide=60, by=["event_type"]
    )
    return rounded(stored(spark, rates, "rates"), rate=6)


@query(
    " UNION ALL ".join(
        f"""SELECT e AS window_end, '{le}' AS le,
                   round(count(*) FILTER (value <= {'1e308' if le == '+Inf' else le}) / 300.0, 6) AS rate
            FROM (SELECT value, unnest(generate_series(0, 4)) AS i,
                         time_bucket(INTERVAL '1 minute', ts, TIMESTAMP '1970-01-01')
                           + INTERVAL '1 minute' + i * INTERVAL '1 minute' AS e
                  FROM events)
            GROUP BY 1 HAVING e <= {CLOSED_SQL}"""
        for le in [*map(bound_name, BOUNDS), "+Inf"]
    )
)
def stream_bucket_rate(spark, sf_dir):
    """Rate of each histogram bucket over five minutes, every minute, as windows close."""
    rates = bucket_rate(
        events_stream(spark, sf_dir), ts="ts", value="value", length=300, slide=60
    )
    return rounded(stored(spark, rates, "bucket-rates"), rate=6)


@query(
    " UNION ALL ".join(
        f"""SELECT 'lag_seconds' AS column_name, {p}::DOUBLE AS p, count(*) AS n,
                   round(quantile_disc(abs(value) + 0.5, {p}), 3) AS value
            FROM events WHERE date_trunc('day', ts) + INTERVAL '1 day' <= {CLOSED_SQL}"""
        for p in (0.5, 0.95)
    )
)
def stream_lag_quantiles(spark, sf_dir):
    """Median and 95th percentile of the lag, from daily sketches of a stream as days close.

    Events arrive as many seconds late as their value says, and half a second.
    """
    micros = F.round((F.abs("value") + 0.5) * 1_000_000).cast("bigint")
    arrival = F.timestamp_micros(F.unix_micros("ts") + micros)
    events = events_stream(spark, sf_dir).select("ts", arrival.alias("arrived_at"))
    days = stored(
        spark, lag_sketches(events, event_time="ts", arrival="arrived_at", k=EXACT_K), "lags"
    )
    found = quantiles(merged(days, k=EXACT_K), [0.5, 0.95])
    return rounded(found, value=3)


@query(
    f"""SELECT event_id, row_number() OVER (ORDER BY ts >= TIMESTAMP '{SPLIT_AT}', ts, event_id) - 1
                 AS position
        FROM events"""
)
def stream_positions(spark, sf_dir):
    """Places in time order, handed on from one half of the events to the next."""
    folder = new_folder(spark, "numbered")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    first = F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")
    for part in (events.filter(first), events.filter(~first)):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream = stream_parquet(spark, f"{folder}/landing", events.schema)
        order = ["ts", "event_id"]
        finish(start_numbering(stream, f"{folder}/out", f"{folder}/checkpoint", order_by=order))
    return numbered_rows(spark, f"{folder}/out", events.schema).drop("ts")
