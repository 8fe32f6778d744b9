"""Monitoring metrics.  Events are the scored records, in order of their number."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import row_json
from ..operators import monitor
from ..operators.enrich import attach
from ..plans.monitor import latest_version, start_snapshots
from ..sources.bus import Bus
from ..sources.scratch import new_folder
from ..streaming.runner import finish
from .registry import entities, query, rounded, table

NOW = "2024-02-01"
RECORDS_SQL = """
  SELECT event_id, ts, event_type AS meter_type, CAST(c_nationkey AS VARCHAR) AS site_id, value
  FROM events LEFT JOIN customer ON c_custkey = user_id"""


def records(spark, sf_dir):
    sites = entities(spark, sf_dir).select("user_id", "site_id")
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("meter_type"), "value"
    )
    return attach(events, sites, ["user_id"])


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("SELECT count(*) AS processed FROM events")
def metric_count(spark, sf_dir):
    return monitor.processed(table(spark, sf_dir, "events"))


@query(
    f"""SELECT meter_type, coalesce(site_id, 'unknown') AS site_id, arg_max(value, event_id) AS latest
        FROM ({RECORDS_SQL}) GROUP BY ALL"""
)
def metric_latest(spark, sf_dir):
    return monitor.latest_value(
        records(spark, sf_dir), labels=["meter_type", "site_id"], value="value", arrival="event_id"
    )


@query(
    f"""WITH l AS (SELECT event_id, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 1e6 AS lag FROM events)
        SELECT arg_max(lag, event_id) AS lag_seconds, round(avg(lag), 3) AS mean_lag_seconds,
               max(lag) AS max_lag_seconds
        FROM l"""
)
def metric_lag(spark, sf_dir):
    lag = monitor.newest_lag(
        table(spark, sf_dir, "events"), event_time="ts", arrival="event_id", now=now()
    )
    return rounded(lag, mean_lag_seconds=3)


LES = [*map(monitor.bound_name, monitor.BOUNDS), "+Inf"]


def _le_sql(le: str) -> str:
    return f"value <= {float('1e308') if le == '+Inf' else le}"


@query(
    " UNION ALL ".join(
        f"""SELECT event_type, count(*) AS count, round(sum(value), 4) AS sum, '{le}' AS le,
                   count(*) FILTER ({_le_sql(le)}) AS bucket
            FROM events GROUP BY 1"""
        for le in LES
    )
)
def metric_histogram(spark, sf_dir):
    counted = monitor.histogram(table(spark, sf_dir, "events"), "value", by=["event_type"])
    return rounded(counted, sum=4)


@query(
    f"""SELECT '{monitor.PROCESSED}' AS metric, '' AS labels, CAST(count(*) AS DOUBLE) AS value FROM events
        UNION ALL SELECT '{monitor.LAG}', '',
               round(arg_max((epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 1e6, event_id), 4) FROM events
        UNION ALL SELECT '{monitor.DISTRIBUTION}_count', '', count(value) FROM events
        UNION ALL SELECT '{monitor.DISTRIBUTION}_sum', '', round(sum(value), 4) FROM events
        UNION ALL SELECT '{monitor.LATEST}',
               'meter_type="' || meter_type || '",site_id="' || coalesce(site_id, 'unknown') || '"',
               arg_max(value, event_id) FROM ({RECORDS_SQL}) GROUP BY ALL
        """
    + "".join(
        f"""UNION ALL SELECT '{monitor.DISTRIBUTION}_bucket', 'le="{le}"',
                   count(*) FILTER ({_le_sql(le)}) FROM events """
        for le in LES
    )
)
def metric_snapshot(spark, sf_dir):
    """All families in one table, the records read once."""
    taken = monitor.snapshot(
        records(spark, sf_dir), value="value", event_time="ts", arrival="event_id", now=now()
    )
    return rounded(taken, value=4)


@query(
    """SELECT e AS window_end, event_type, count(*) AS records,
              round(count(*) / 60.0, 6) AS rate
       FROM (SELECT event_type, unnest(generate_series(0, 11)) AS i,
                    time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01')
                      + INTERVAL '5 seconds' + i * INTERVAL '5 seconds' AS e
             FROM events)
       GROUP BY ALL"""
)
def metric_rate(spark, sf_dir):
    """Records per second over the last minute, every five seconds, per type."""
    events = table(spark, sf_dir, "events")
    return rounded(monitor.trailing_rate(events, ts="ts", by=["event_type"]), rate=6)


@query(
    " UNION ALL ".join(
        f"""SELECT e AS window_end, '{le}' AS le,
                   round(count(*) FILTER ({_le_sql(le)}) / 300.0, 6) AS rate
            FROM (SELECT value, unnest(generate_series(0, 4)) AS i,
                         time_bucket(INTERVAL '1 minute', ts, TIMESTAMP '1970-01-01')
                           + INTERVAL '1 minute' + i * INTERVAL '1 minute' AS e
                  FROM events)
            GROUP BY 1"""
        for le in LES
    )
)
def metric_bucket_rate(spark, sf_dir):
    """Rate of each histogram bucket over five minutes, every minute."""
    rates = monitor.bucket_rate(
        table(spark, sf_dir, "events"), ts="ts", value="value", length=300, slide=60
    )
    return rounded(rates, rate=6)


@query(
    f"""SELECT time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '5 seconds' AS scraped_at,
               meter_type, coalesce(site_id, 'unknown') AS site_id, arg_max(value, event_id) AS latest
        FROM ({RECORDS_SQL}) GROUP BY ALL"""
)
def metric_live(spark, sf_dir):
    """The latest values as the scrapes see them."""
    return monitor.live_series(
        records(spark, sf_dir),
        ts="ts",
        labels=["meter_type", "site_id"],
        value="value",
        arrival="event_id",
    )


@query(
    f"""WITH c AS (
          SELECT time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '30 minutes'
                   AS seen,
                 meter_type, coalesce(site_id, 'unknown') AS site_id, arg_max(value, event_id) AS latest
          FROM ({RECORDS_SQL}) GROUP BY ALL),
        s AS (SELECT unnest(generate_series(min(seen), max(seen), INTERVAL '30 minutes')) AS scraped_at FROM c),
        l AS (SELECT DISTINCT meter_type, site_id FROM c)
        SELECT scraped_at, p.meter_type, p.site_id, latest
        FROM (SELECT * FROM s, l) p
        ASOF JOIN c ON c.meter_type = p.meter_type AND c.site_id = p.site_id AND p.scraped_at >= c.seen"""
)
def metric_live_filled(spark, sf_dir):
    """The gauges at every scrape, half an hour apart, also those without new records."""
    return monitor.filled_series(
        records(spark, sf_dir),
        ts="ts",
        labels=["meter_type", "site_id"],
        value="value",
        arrival="event_id",
        every=1800,
    )


@query(
    """WITH p AS (SELECT time_bucket(INTERVAL '1 minute', ts, TIMESTAMP '1970-01-01')
                           + INTERVAL '1 minute' AS e, count(*) AS n FROM events GROUP BY 1),
            a AS (SELECT unnest(generate_series(min(e), max(e) + INTERVAL '4 minutes',
                                                INTERVAL '1 minute')) AS window_end FROM p),
            r AS (SELECT window_end, CAST(coalesce(sum(n), 0) AS BIGINT) AS records
                  FROM a LEFT JOIN p ON e <= window_end AND e > window_end - INTERVAL '5 minutes'
                  GROUP BY 1)
       SELECT window_end, records, round(records / 300.0, 6) AS rate,
              CASE WHEN records / 300.0 >= 0.01 THEN 'green' ELSE 'red' END AS status
       FROM r"""
)
def metric_throughput(spark, sf_dir):
    """Throughput over five minutes, every minute, with the minutes when nothing came."""
    rates = monitor.trailing_rate(
        table(spark, sf_dir, "events"), ts="ts", length=300, slide=60, empty=True
    )
    return rounded(rates.withColumn("status", monitor.throughput(F.col("rate"))), rate=6)


@query(
    """SELECT e AS scraped_at, round((epoch_us(e) - max(epoch_us(ts))) / 1e6, 6) AS lag_seconds,
              CASE WHEN epoch_us(e) - max(epoch_us(ts)) >= 300e6 THEN 'red'
                   WHEN epoch_us(e) - max(epoch_us(ts)) >= 60e6 THEN 'yellow' ELSE 'green' END AS status
       FROM (SELECT ts, time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01')
                          + INTERVAL '10 minutes' AS e FROM events)
       GROUP BY 1"""
)
def metric_freshness(spark, sf_dir):
    """Age of the newest record at the end of every ten minutes, and its light."""
    scraped = F.window("ts", "10 minutes").end
    events = table(spark, sf_dir, "events").select("event_id", "ts", scraped.alias("scraped_at"))
    newest = events.groupBy("scraped_at").agg(F.max("ts").alias("ts"))
    lag = monitor.seconds_between(F.col("scraped_at"), F.col("ts"))
    aged = newest.select("scraped_at", lag.alias("lag_seconds"))
    return rounded(aged.withColumn("status", monitor.freshness(F.col("lag_seconds"))), lag_seconds=6)


def faulty_messages(spark, sf_dir):
    """Records as JSON, of which some are cut off, lack a field or have no number."""
    kind = F.col("event_id") % 10
    fields = [
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_time"),
        F.col("user_id").alias("building_id"),
        F.when(kind != 5, F.col("event_type")).alias("meter_type"),
        F.when(kind == 3, "abc").when(kind != 9, F.col("value").cast("string")).alias("prediction"),
    ]
    whole = row_json(*fields)
    text = F.when(kind == 7, F.substring(whole, 1, 40)).otherwise(whole)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"), text.alias("value")
    )


MUCH_LATER = "2030-01-01 00:00:00"
SCREENED_SQL = """
  SELECT event_id, ts, value, event_id % 10 AS k,
         CASE event_id % 10 WHEN 7 THEN 'malformed' WHEN 3 THEN 'prediction is not a number'
              WHEN 9 THEN 'missing prediction' END AS reject,
         CASE WHEN event_id % 10 = 5 THEN 'unknown' ELSE event_type END AS meter_type
  FROM events"""


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS key, coalesce(reject, '') AS reject,
               CASE WHEN reject IS NULL THEN meter_type END AS meter_type,
               CASE WHEN reject IS NULL THEN value END AS prediction,
               CASE WHEN reject IS NULL THEN ts END AS event_time
        FROM ({SCREENED_SQL})"""
)
def quarantine(spark, sf_dir):
    """Usable and rejected records, with the reason."""
    screened = monitor.screen(faulty_messages(spark, sf_dir))
    good = F.col("reject").isNull()
    return screened.select(
        "key",
        F.coalesce("reject", F.lit("")).alias("reject"),
        *[F.when(good, F.col(n)).alias(n) for n in ("meter_type", "prediction", "event_time")],
    )


@query(
    f"""WITH r AS (SELECT * FROM ({SCREENED_SQL}) WHERE reject IS NULL)
        SELECT '{monitor.PROCESSED}' AS metric, '' AS labels, CAST(count(*) AS DOUBLE) AS value FROM r
        UNION ALL SELECT '{monitor.DISTRIBUTION}_count', '', count(value) FROM r
        UNION ALL SELECT '{monitor.DISTRIBUTION}_sum', '', round(sum(value), 4) FROM r
        UNION ALL SELECT '{monitor.LATEST}',
                         'meter_type="' || meter_type || '",site_id="unknown"',
                         round(arg_max(value, event_id), 4) FROM r GROUP BY meter_type
        UNION ALL SELECT '{monitor.LAG}', '',
                         round((epoch_us(TIMESTAMP '{MUCH_LATER}') - epoch_us(arg_max(ts, event_id))) / 1e6, 4)
                  FROM r
        """
    + "".join(
        f"""UNION ALL SELECT '{monitor.DISTRIBUTION}_bucket', 'le="{le}"',
                   count(*) FILTER ({_le_sql(le)}) FROM r """
        for le in LES
    )
)
def stream_metrics(spark, sf_dir):
    """All metric families over a topic with faulty records, sent in the order of their ids.

    Lags are measured against a fixed time.
    """
    folder = new_folder(spark, "metrics")
    bus = Bus("files", folder)
    ordered = faulty_messages(spark, sf_dir).orderBy(F.col("key").cast("bigint"))
    bus.send(ordered, "predictions-stream")
    finish(
        start_snapshots(
            bus.subscribe(spark, "predictions-stream", arrival=True),
            now=F.lit(MUCH_LATER).cast("timestamp"),
            quarantine=f"{folder}/quarantine",
            metrics=f"{folder}/metrics",
            checkpoint=f"{folder}/checkpoint",
        )
    )
    return rounded(latest_version(spark, f"{folder}/metrics"), value=4)
