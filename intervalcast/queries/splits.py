"""Outlier bounds, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import outliers, split
from .intervals import totals
from .registry import TOTALS_SQL, query, rounded, table

KEY = ["user_id", "event_type", "interval_start"]

BOUNDS_SQL = """
  SELECT avg(value) - 3 * stddev_samp(value) AS lo, avg(value) + 3 * stddev_samp(value) AS hi
  FROM events"""


def share_sql(text: str, fraction: float) -> str:
    """Whether the hash of a text is in the first part of its range."""
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) < {round(fraction * 2**60)}"


IN_TRAIN = share_sql("CAST(event_id AS VARCHAR)", 0.8)


@query(f"SELECT round(lo, 6) + 0.0 AS lo, round(hi, 6) + 0.0 AS hi FROM ({BOUNDS_SQL})")
def sigma_bounds(spark, sf_dir):
    bounds = outliers.sigma_bounds(table(spark, sf_dir, "events"), "value")
    return rounded(bounds, lo=6, hi=6)


@query(
    f"""SELECT user_id, event_type, interval_start, round(total, 4) + 0.0 AS total
        FROM ({TOTALS_SQL}), (SELECT avg(total) AS m, stddev_samp(total) AS s FROM ({TOTALS_SQL}))
        WHERE total BETWEEN m - 3 * s AND m + 3 * s"""
)
def sigma_filter(spark, sf_dir):
    return rounded(outliers.sigma_filter(totals(spark, sf_dir), "total"), total=4)


@query(
    f"""SELECT event_id, CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'test' END AS part
        FROM events"""
)
def hash_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id")
    return split.split_label(events, ["event_id"], portable=True)


@query(
    f"""WITH s AS (SELECT event_id, value, {IN_TRAIN} AS in_train FROM events),
             b AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM s WHERE in_train)
        SELECT event_id, CASE WHEN in_train THEN 'train' ELSE 'test' END AS part
        FROM s, b WHERE NOT in_train OR value BETWEEN m - 3 * d AND m + 3 * d"""
)
def train_only_filter(spark, sf_dir):
    """Bounds from the training rows, applied to them; the test rows are all kept."""
    events = table(spark, sf_dir, "events").select("event_id", "value")
    labelled = split.split_label(events, ["event_id"], portable=True)
    return split.train_only_filter(labelled, "value").select("event_id", "part")


@query(f"SELECT event_id FROM events WHERE {share_sql("'s1|' || event_id", 0.25)}")
def hash_sample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id")
    return split.hash_sample(events, ["event_id"], 0.25, salt="s1", portable=True)


@query(f"SELECT event_id FROM events WHERE {share_sql("'s2|' || event_id", 0.01234567)}")
def hash_sample_fine(spark, sf_dir):
    """A fraction that no small number of steps expresses."""
    events = table(spark, sf_dir, "events").select("event_id")
    return split.hash_sample(events, ["event_id"], 0.01234567, salt="s2", portable=True)


def _likely(n: Column, of: Column, share: float) -> Column:
    """Whether a draw of n is within five deviations of its expectation."""
    spread = F.sqrt(of * F.lit(share * (1 - share)))
    return F.abs(n - of * F.lit(share)) <= 5 * spread + 1


@query("SELECT count(*) AS rows, true AS likely, true AS drawn_once FROM events")
def sample_rows(spark, sf_dir):
    """Seeded Bernoulli sample.  Its rows depend on the partitions, so what must hold of
    any draw is returned: its size, and that each row is one of the table's, once."""
    events = table(spark, sf_dir, "events")
    drawn = split.random_sample(events, 0.25, seed=2025)
    marks = events.select(F.lit(1).alias("of"), F.lit(0).alias("n"), "event_id").unionByName(
        drawn.select(F.lit(0).alias("of"), F.lit(1).alias("n"), "event_id")
    )
    by_row = marks.groupBy("event_id").agg(F.sum("of").alias("of"), F.sum("n").alias("n"))
    return by_row.agg(
        F.sum("of").alias("rows"),
        _likely(F.sum("n"), F.sum("of"), 0.25).alias("likely"),
        F.every(F.col("n") <= F.col("of")).alias("drawn_once"),
    )


@query("SELECT count(*) AS rows, true AS likely, true AS on_one_side FROM events")
def random_split(spark, sf_dir):
    """Spark's seeded split: sizes are as drawn, and each row is on one side."""
    train, test = split.random_split(table(spark, sf_dir, "events"), 0.8, seed=2025)
    marks = train.select("event_id", F.lit(1).alias("train")).unionByName(
        test.select("event_id", F.lit(0).alias("train"))
    )
    by_row = marks.groupBy("event_id").agg(
        F.count("*").alias("sides"), F.sum("train").alias("train")
    )
    return by_row.agg(
        F.count("*").alias("rows"),
        _likely(F.sum("train"), F.count("*"), 0.8).alias("likely"),
        F.every(F.col("sides") == 1).alias("on_one_side"),
    )
