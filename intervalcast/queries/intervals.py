"""Intervals, resampling and the joined frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import interval_index, interval_label
from ..operators.enrich import attach, categories_table, fan_out, fan_out_by
from ..operators.features import add_interval_features
from ..operators.resample import (
    calendar_mean,
    calendar_sum,
    interval_mean,
    interval_of,
    interval_sum,
)
from ..operators.season import label_season, peak_months
from ..settings import METER_TYPES
from ..sources.colocated import by_site_and_interval, frame_in_place
from .registry import (
    ENTITIES_SQL,
    FEED_SQL,
    FRAME_SQL,
    TOTALS_SQL,
    conditions,
    entities,
    floor_sql,
    label_sql,
    query,
    readings,
    rounded,
    table,
)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval_sum(
        readings(spark, sf_dir),
        keys=["user_id", "event_type"],
        ts="ts",
        value="value",
        total="total",
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean per site and interval.  Entities are added up first, so that a busy one is a row
    per interval, not all its readings, in the join with the sites."""
    views = readings(spark, sf_dir).filter(F.col("event_type") == "view")
    interval = interval_of(views, "ts").alias("interval_start")
    parts = views.groupBy("user_id", interval).agg(
        F.sum("value").alias("total"), F.count("value").alias("n")
    )
    sites = entities(spark, sf_dir).select("user_id", "site_id")
    mean = F.sum("total") / F.nullif(F.sum("n"), F.lit(0))
    return parts.join(sites, "user_id").groupBy("site_id", "interval_start").agg(
        mean.alias("condition")
    )


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval totals with entity attributes and the site's interval conditions."""
    described = attach(totals(spark, sf_dir), entities(spark, sf_dir), ["user_id"])
    return attach(described, feed(spark, sf_dir), ["site_id", "interval_start"])


@query(
    f"""SELECT event_id, {floor_sql()} AS interval_start,
               CAST(hour(ts) // 6 AS INTEGER) AS interval_index
        FROM events"""
)
def interval_floor(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        interval_of(events, "ts").alias("interval_start"),
        interval_index(F.col("ts")).alias("interval_index"),
    )


@query(f"SELECT event_id, {label_sql()} AS time_interval FROM events")
def interval_name(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", interval_label(F.col("ts")).alias("time_interval"))


@query(f"SELECT user_id, event_type, interval_start, round(total, 4) + 0.0 AS total FROM ({TOTALS_SQL})")
def interval_totals(spark, sf_dir):
    return rounded(totals(spark, sf_dir), total=4)


@query(
    f"""SELECT c_nationkey AS site_id, {floor_sql()} AS interval_start,
               round(avg(value), 7) + 0.0 AS condition, round(avg(value % 360), 7) + 0.0 AS angle
        FROM events JOIN customer ON c_custkey = user_id
        WHERE event_type = 'view' GROUP BY ALL"""
)
def interval_means(spark, sf_dir):
    means = interval_mean(
        conditions(spark, sf_dir), keys=["site_id"], ts="ts", values=["condition", "angle"]
    )
    return rounded(means, condition=7, angle=7)


@query(
    f"""WITH turned AS (
          SELECT c_nationkey AS site_id, {floor_sql()} AS interval_start,
                 degrees(atan2(avg(sin(radians(value % 360))), avg(cos(radians(value % 360))))) AS a
          FROM events JOIN customer ON c_custkey = user_id
          WHERE event_type = 'view' GROUP BY ALL)
        SELECT site_id, interval_start,
               round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 4) + 0.0 AS angle
        FROM turned"""
)
def interval_circular_means(spark, sf_dir):
    means = interval_mean(
        conditions(spark, sf_dir), keys=["site_id"], ts="ts", values=["angle"], angles=["angle"]
    )
    return rounded(means, angle=4)


@query(
    f"""SELECT user_id, event_type, CAST(year(ts) AS INTEGER) AS year,
               CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
               {label_sql()} AS time_interval, round(sum(value), 4) + 0.0 AS total
        FROM events GROUP BY ALL"""
)
def calendar_totals(spark, sf_dir):
    summed = calendar_sum(
        readings(spark, sf_dir),
        keys=["user_id", "event_type"],
        ts="ts",
        value="value",
        total="total",
    )
    return rounded(summed, total=4)


PEAKS_SQL = """
  SELECT month FROM (
    SELECT month, row_number() OVER (ORDER BY m DESC, month) AS hot,
           row_number() OVER (ORDER BY m, month) AS cold
    FROM (SELECT month(o_orderdate) AS month, avg(o_totalprice) AS m FROM orders GROUP BY 1))
  WHERE hot <= 3 OR cold <= 3"""


@query(
    f"""SELECT o_orderpriority,
               CASE WHEN month(o_orderdate) IN ({PEAKS_SQL}) THEN 'peak' ELSE 'off-peak' END AS season,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(day(o_orderdate) AS INTEGER) AS day,
               {label_sql("o_orderdate")} AS time_interval,
               round(avg(o_totalprice), 7) + 0.0 AS o_totalprice
        FROM orders GROUP BY ALL"""
)
def calendar_means(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    peaks = peak_months(orders, ts="o_orderdate", value="o_totalprice")
    means = calendar_mean(
        label_season(orders, peaks, ts="o_orderdate"),
        keys=["o_orderpriority", "season"],
        ts="o_orderdate",
        values=["o_totalprice"],
    )
    return rounded(means, o_totalprice=7)


@query(
    f"""SELECT t.user_id, event_type, interval_start, round(total, 4) + 0.0 AS total,
               site_id, segment, area
        FROM ({TOTALS_SQL}) t LEFT JOIN ({ENTITIES_SQL}) e USING (user_id)"""
)
def enrich_left(spark, sf_dir):
    joined = attach(totals(spark, sf_dir), entities(spark, sf_dir), ["user_id"])
    return rounded(joined, total=4)


@query(
    f"""SELECT user_id, event_type, interval_start, site_id, round(total, 4) + 0.0 AS total,
               round(condition, 7) + 0.0 AS condition
        FROM ({FRAME_SQL})"""
)
def enrich_interval(spark, sf_dir):
    joined = frame(spark, sf_dir).select(
        "user_id", "event_type", "interval_start", "site_id", "total", "condition"
    )
    return rounded(joined, total=4, condition=7)


@query(
    f"""WITH s AS (
          SELECT user_id, event_type, CAST(year(ts) AS INTEGER) AS year,
                 CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
                 {label_sql()} AS time_interval, sum(value) AS total
          FROM events GROUP BY ALL),
        m AS (
          SELECT c_nationkey AS site_id, CAST(year(ts) AS INTEGER) AS year,
                 CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
                 {label_sql()} AS time_interval, avg(value) AS condition
          FROM events JOIN customer ON c_custkey = user_id
          WHERE event_type = 'view' GROUP BY ALL)
        SELECT s.user_id, s.event_type, e.site_id, s.year, s.month, s.day, s.time_interval,
               round(total, 4) + 0.0 AS total, round(condition, 7) + 0.0 AS condition
        FROM s LEFT JOIN ({ENTITIES_SQL}) e USING (user_id)
        LEFT JOIN m ON m.site_id = e.site_id AND m.year = s.year AND m.month = s.month
                   AND m.day = s.day AND m.time_interval = s.time_interval"""
)
def enrich_calendar(spark, sf_dir):
    summed = calendar_sum(
        readings(spark, sf_dir),
        keys=["user_id", "event_type"],
        ts="ts",
        value="value",
        total="total",
    )
    means = calendar_mean(
        conditions(spark, sf_dir), keys=["site_id"], ts="ts", values=["condition"]
    )
    sites = entities(spark, sf_dir).select("user_id", "site_id")
    joined = attach(
        attach(summed, sites, ["user_id"]),
        means,
        ["site_id", "year", "month", "day", "time_interval"],
    )
    return rounded(joined, total=4, condition=7)


@query(
    f"""SELECT user_id, event_type, interval_start, site_id, segment,
               round(total, 4) + 0.0 AS total, round(condition, 7) + 0.0 AS condition,
               round(ln(1 + area), 6) + 0.0 AS log_area,
               CAST(month(interval_start) AS INTEGER) AS month,
               CAST(hour(interval_start) // 6 AS INTEGER) AS time_interval_num,
               round(sin(2 * pi() * (hour(interval_start) // 6) / 4), 6) + 0.0 AS time_sin,
               round(cos(2 * pi() * (hour(interval_start) // 6) / 4), 6) + 0.0 AS time_cos,
               round(sin(2 * pi() * month(interval_start) / 12), 6) + 0.0 AS month_sin,
               round(cos(2 * pi() * month(interval_start) / 12), 6) + 0.0 AS month_cos
        FROM ({FRAME_SQL})"""
)
def training_frame(spark, sf_dir):
    """The flagship: labelled rows with all features."""
    featured = add_interval_features(
        frame(spark, sf_dir).withColumn("log_area", F.log1p("area")).drop("area"),
        "interval_start",
    )
    return rounded(
        featured,
        total=4,
        condition=7,
        log_area=6,
        time_sin=6,
        time_cos=6,
        month_sin=6,
        month_cos=6,
    )


@query(FRAME_SQL.replace("t.*", "t.user_id, t.event_type, t.interval_start, round(t.total, 4) + 0.0 AS total").replace("f.condition", "round(f.condition, 7) + 0.0 AS condition"))
def frame_colocated(spark, sf_dir):
    """The labelled rows from tables stored by site and interval: joined without a shuffle."""
    stored, conditions_stored = by_site_and_interval(
        readings(spark, sf_dir),
        entities(spark, sf_dir),
        conditions(spark, sf_dir).drop("angle"),
        entity="user_id",
        site="site_id",
        ts="ts",
        buckets=8,
    )
    framed = frame_in_place(
        stored,
        conditions_stored,
        entity="user_id",
        category="event_type",
        site="site_id",
        value="value",
        total="total",
        attributes=["segment", "area"],
        means=["condition"],
    )
    return rounded(framed, total=4, condition=7)


@query(
    """SELECT c_custkey, m.meter_type
       FROM customer CROSS JOIN (VALUES ('c'), ('e'), ('h'), ('s')) m(meter_type)"""
)
def category_fan_out(spark, sf_dir):
    """Each entity once per literal category."""
    return fan_out(table(spark, sf_dir, "customer").select("c_custkey"), "meter_type", METER_TYPES)


@query(
    """SELECT c_custkey AS user_id, event_type
       FROM customer LEFT JOIN (SELECT DISTINCT user_id, event_type FROM events) ON c_custkey = user_id"""
)
def owned_fan_out(spark, sf_dir):
    """Each entity once per category it has readings of; entities without any stay."""
    users = entities(spark, sf_dir).select("user_id")
    return fan_out_by(users, readings(spark, sf_dir), ["user_id"], category="event_type")


@query(
    """SELECT t.event_type, count(event_id) AS events
       FROM (VALUES ('view'), ('click'), ('purchase'), ('refund')) t(event_type)
       LEFT JOIN events USING (event_type) GROUP BY 1"""
)
def literal_dimension(spark, sf_dir):
    """A literal table of categories as the left side, one of them without rows."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    names = categories_table(events, "event_type", ["view", "click", "purchase", "refund"])
    counted = events.groupBy("event_type").agg(F.count("event_id").alias("events"))
    joined = attach(names, counted, ["event_type"])
    return joined.withColumn("events", F.coalesce("events", F.lit(0).cast("bigint")))
