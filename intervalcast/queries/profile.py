"""Describing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, sketches
from ..operators.enrich import attach
from ..operators.outliers import sigma_bounds
from ..operators.season import label_season, peak_months
from ..sources.scratch import materialise
from .intervals import PEAKS_SQL, frame, totals
from .registry import ENTITIES_SQL, FRAME_SQL, TOTALS_SQL, entities, query, rounded, table


@query(
    f"""SELECT count(*) FILTER (user_id IS NULL) AS user_id,
               count(*) FILTER (segment IS NULL) AS segment,
               count(*) FILTER (event_type IS NULL) AS event_type,
               count(*) FILTER (interval_start IS NULL) AS interval_start,
               count(*) FILTER (total IS NULL) AS total
        FROM ({ENTITIES_SQL}) e LEFT JOIN ({TOTALS_SQL}) t USING (user_id)"""
)
def null_counts(spark, sf_dir):
    """Entities joined with their totals: those without readings leave gaps."""
    joined = attach(entities(spark, sf_dir), totals(spark, sf_dir), ["user_id"])
    return profile.null_counts(
        joined, ["user_id", "segment", "event_type", "interval_start", "total"]
    )


def _summary_sql(name: str) -> str:
    return f"""
      SELECT '{name}' AS column_name, count({name}) AS count, round(avg({name}), 6) AS mean,
             round(stddev_samp({name}), 6) AS stddev, min({name}) AS min,
             round(quantile_cont({name}, 0.25), 6) AS p25,
             round(quantile_cont({name}, 0.5), 6) AS p50,
             round(quantile_cont({name}, 0.75), 6) AS p75, max({name}) AS max
      FROM lineitem"""


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(map(_summary_sql, MEASURES)))
def numeric_summary(spark, sf_dir):
    summary = profile.numeric_summary(table(spark, sf_dir, "lineitem"), MEASURES)
    return rounded(summary, mean=6, stddev=6, p25=6, p50=6, p75=6)


@query(
    """SELECT 'l_quantity' AS column_name, count(q) AS count, CAST('inf' AS DOUBLE) AS mean,
              min(q) AS min, round(quantile_cont(q, 0.25), 6) AS p25,
              round(quantile_cont(q, 0.5), 6) AS p50, round(quantile_cont(q, 0.75), 6) AS p75,
              max(q) AS max
       FROM (SELECT CASE WHEN l_linenumber = 7 THEN CAST('inf' AS DOUBLE)
                         ELSE CAST(l_quantity AS DOUBLE) END AS q FROM lineitem)"""
)
def numeric_summary_infinite(spark, sf_dir):
    """Some values are infinite: so are mean and maximum, the quartiles are not."""
    infinite = F.when(F.col("l_linenumber") == 7, F.lit(float("inf")))
    lines = table(spark, sf_dir, "lineitem").select(
        infinite.otherwise(F.col("l_quantity").cast("double")).alias("l_quantity")
    )
    summary = profile.numeric_summary(lines, ["l_quantity"]).drop("stddev")
    return rounded(summary, p25=6, p50=6, p75=6)


@query("SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


def _top_sql(name: str) -> str:
    return f"""
      SELECT '{name}' AS column_name, CAST({name} AS VARCHAR) AS value, count(*) AS count,
             CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({name} AS VARCHAR)) AS INTEGER) AS rank
      FROM part GROUP BY {name} QUALIFY rank <= 5"""


@query(" UNION ALL ".join(f"SELECT * FROM ({_top_sql(n)})" for n in ["p_type", "p_brand", "p_size"]))
def top_values(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"), ["p_type", "p_brand", "p_size"])


@query(
    """SELECT count(*) AS rows_before,
              count(*) FILTER (value BETWEEN m - 3 * s AND m + 3 * s) AS rows_after
       FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)"""
)
def filter_counts(spark, sf_dir):
    """Rows before and after the outlier filter."""
    events = table(spark, sf_dir, "events").select("value")
    bounded = events.crossJoin(F.broadcast(sigma_bounds(events, "value")))
    return profile.filter_counts(bounded, F.col("value").between(F.col("lo"), F.col("hi")))


@query(
    f"""SELECT site_id, round(avg(total), 5) + 0.0 AS avg_energy,
               round(avg(condition), 5) + 0.0 AS avg_condition
        FROM ({FRAME_SQL}) GROUP BY 1"""
)
def site_means(spark, sf_dir):
    means = profile.group_means(
        frame(spark, sf_dir), ["site_id"], {"avg_energy": "total", "avg_condition": "condition"}
    )
    return rounded(means, avg_energy=5, avg_condition=5)


@query(
    """SELECT CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade, c_mktsegment AS use,
              round(avg(o_totalprice), 4) + 0.0 AS mean_value,
              round(avg(c_acctbal), 4) + 0.0 AS mean_size, count(*) AS rows
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL"""
)
def decade_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"), "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("use"), "c_acctbal"
    )
    described = profile.decade_profile(
        attach(orders, customers, ["c_custkey"]),
        year="year",
        use="use",
        value="o_totalprice",
        size="c_acctbal",
    )
    return rounded(described, mean_value=4, mean_size=4)


@query(
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
              round(avg(o_totalprice), 4) + 0.0 AS month_mean
       FROM orders GROUP BY 1 ORDER BY month_mean DESC"""
)
def month_means(spark, sf_dir):
    """Sorted from the highest mean to the lowest."""
    means = profile.month_means(
        table(spark, sf_dir, "orders"), ts="o_orderdate", value="o_totalprice"
    )
    return rounded(means, month_mean=4).orderBy(F.desc("month_mean"))


@query(
    """WITH m AS (SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
                         avg(o_totalprice) AS month_mean FROM orders GROUP BY 1)
       SELECT * FROM (SELECT 'highest' AS side, month, round(month_mean, 4) + 0.0 AS month_mean
                      FROM m ORDER BY m.month_mean DESC, month LIMIT 3)
       UNION ALL
       SELECT * FROM (SELECT 'lowest' AS side, month, round(month_mean, 4) + 0.0 AS month_mean
                      FROM m ORDER BY m.month_mean, month LIMIT 3)"""
)
def extreme_months(spark, sf_dir):
    """The three months with the highest and the three with the lowest mean."""
    means = profile.month_means(
        table(spark, sf_dir, "orders"), ts="o_orderdate", value="o_totalprice"
    )
    sides = [
        profile.ranked(means, "month_mean", 3, descending=highest, tie="month").select(
            F.lit("highest" if highest else "lowest").alias("side"), "month", "month_mean"
        )
        for highest in (True, False)
    ]
    return rounded(sides[0].union(sides[1]), month_mean=4)


@query(
    f"""SELECT o_orderkey,
               CASE WHEN month(o_orderdate) IN ({PEAKS_SQL}) THEN 'peak' ELSE 'off-peak' END AS season
        FROM orders"""
)
def season_label(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    peaks = peak_months(orders, ts="o_orderdate", value="o_totalprice")
    return label_season(orders, peaks, ts="o_orderdate").select("o_orderkey", "season")


@query(
    f"""SELECT CASE WHEN month(o_orderdate) IN ({PEAKS_SQL}) THEN 'peak' ELSE 'off-peak' END AS season,
               count(*) AS count
        FROM orders GROUP BY 1"""
)
def season_counts(spark, sf_dir):
    return profile.value_counts(season_label(spark, sf_dir), "season")


@query(
    "SELECT least(count(*), 20) AS rows, least(count(*), 20) AS in_table FROM events"
)
def preview(spark, sf_dir):
    """Any twenty rows; which ones is left open, so they are counted and looked up."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    shown = profile.preview(events, 20)
    met = attach(shown, events.distinct(), ["event_id", "ts", "user_id"], matched="is_there")
    return met.agg(F.count("*").alias("rows"), F.count_if("is_there").alias("in_table"))


# Large enough to hold the test tables whole, so that quantiles can be compared as they are.
EXACT_K = 32768


@query(
    " UNION ALL ".join(
        f"""SELECT event_type, 'value' AS column_name, {p}::DOUBLE AS p, count(*) AS n,
                   quantile_disc(value, {p}) AS value
            FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'
            GROUP BY event_type"""
        for p in (0.25, 0.5, 0.95)
    )
)
def day_quantiles(spark, sf_dir):
    """Quantiles of two weeks, merged from sketches stored per day and type."""
    events = table(spark, sf_dir, "events")
    stored = materialise(
        sketches.sketches(events, ["value"], ts="ts", by=["event_type"], k=EXACT_K), "sketches"
    )
    days = stored.filter(
        (F.col("period_start") >= F.lit("2024-01-08").cast("timestamp_ntz"))
        & (F.col("period_start") < F.lit("2024-01-22").cast("timestamp_ntz"))
    )
    weeks = sketches.merged(days, ["event_type"], EXACT_K)
    return sketches.quantiles(weeks, [0.25, 0.5, 0.95])
