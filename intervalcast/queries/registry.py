"""Named queries and the roles the test tables play in them.

``events`` are the meter readings (entity ``user_id``, category ``event_type``),
``customer`` describes the entities, and the events of type ``view`` stand for the
condition feed of the entities' sites (``c_nationkey``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function under its name, with equivalent SQL if there is any."""

    def register(build: Build) -> Build:
        REGISTRY[build.__name__] = Query(lambda spark, sf_dir: run(build, spark, sf_dir), sql)
        return build

    return register


def run(build: Build, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of the test tables are UTC clock readings, so the session reads them as such."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return plain_times(build(spark, sf_dir))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files.  The pattern also fits a table that is one file."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.{{parquet}}")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").alias("site_id"),
        F.col("c_mktsegment").alias("segment"),
        F.greatest("c_acctbal", F.lit(0.0)).alias("area"),
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of type view as the feed of their entity's site."""
    views = readings(spark, sf_dir).filter(F.col("event_type") == "view")
    sites = entities(spark, sf_dir).select("user_id", "site_id")
    return views.join(sites, "user_id").select(
        "site_id", "ts", F.col("value").alias("condition"), (F.col("value") % 360).alias("angle")
    )


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums are added up in another order on every run; compare the digits that are settled.

    Values have two decimals, so sums are exact at four.  A mean of 2 ** (n - 1) values may
    lie halfway between two n-digit numbers: means of intervals are compared at seven.
    """
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


def floor_sql(ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '6 hours', {ts}, TIMESTAMP '1970-01-01')"


def label_sql(ts: str = "ts") -> str:
    return (
        f"CASE WHEN hour({ts}) < 6 THEN '0:00-5:59' WHEN hour({ts}) < 12 THEN '6:00-11:59' "
        f"WHEN hour({ts}) < 18 THEN '12:00-17:59' ELSE '18:00-23:59' END"
    )


# Common parts of the SQL side.
TOTALS_SQL = f"""
  SELECT user_id, event_type, {floor_sql()} AS interval_start, sum(value) AS total
  FROM events GROUP BY ALL"""
FEED_SQL = f"""
  SELECT c_nationkey AS site_id, {floor_sql()} AS interval_start, avg(value) AS condition
  FROM events JOIN customer ON c_custkey = user_id
  WHERE event_type = 'view' GROUP BY ALL"""
ENTITIES_SQL = """
  SELECT c_custkey AS user_id, c_nationkey AS site_id, c_mktsegment AS segment,
         greatest(c_acctbal, 0.0) AS area
  FROM customer"""
FRAME_SQL = f"""
  SELECT t.*, e.site_id, e.segment, e.area, f.condition
  FROM ({TOTALS_SQL}) t
  LEFT JOIN ({ENTITIES_SQL}) e USING (user_id)
  LEFT JOIN ({FEED_SQL}) f ON f.site_id = e.site_id AND f.interval_start = t.interval_start"""


