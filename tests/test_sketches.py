"""Stored sketches, and rates of a stream in many batches."""

import math

import pytest
from pyspark.sql import functions as F

from intervalcast.operators import monitor, sketches
from intervalcast.operators.profile import numeric_summary
from intervalcast.sources.sinks import append_parquet
from intervalcast.sources.tables import read_parquet, stream_parquet
from intervalcast.streaming.runner import finish
from intervalcast.streaming.windows import with_event_time


@pytest.fixture(scope="module")
def skewed(spark):
    """Thirty days, one key with a third of all rows, a heavy value, NaN and nulls."""
    df = spark.range(0, 60_000, 1, 6).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 43).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("key"),
        (F.xxhash64("id") % 1_000_000).cast("double").alias("x"),
    )
    x = F.when(F.col("x") % 10 == 0, 7.0).when(F.col("x") % 10 == 1, float("nan")).when(F.col("x") % 10 == 2, None)
    return df.withColumn("x", x.otherwise(F.exp(F.col("x") / 100_000)))


@pytest.mark.parametrize("k", [200, 4096])
def test_merged_days_err_within_the_bound(spark, skewed, k):
    days = sketches.sketches(skewed, ["x"], ts="ts", by=["key"], k=k)
    assert days.select("period_start").distinct().count() == 30
    for by in ([], ["key"]):
        found = sketches.quantiles(sketches.merged(days, by, k), [0.05, 0.5, 0.95]).collect()
        numbers = skewed.filter(~F.isnan("x") & F.col("x").isNotNull())
        for row in found:
            own = numbers.filter(F.col("key") == row.key) if by else numbers
            n, below, upto = own.agg(
                F.count("*"), F.count_if(F.col("x") < row.value), F.count_if(F.col("x") <= row.value)
            ).first()
            assert row.n == n
            # The rank that the value has, where many rows share it the nearest.
            error = max(below / n - row.p, row.p - upto / n, 0.0)
            assert error <= 1.5 * sketches.rank_error(k)
        if by:
            break_at = {row.key for row in found}
            assert "hot" in break_at and len(break_at) > 10


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(None,), (math.nan,)], "x DOUBLE")
    (row,) = sketches.quantiles(sketches.merged(sketches.sketches(rows, ["x"])), [0.5]).collect()
    assert (row.n, row.value) == (0, None)
    assert sketches.sketches(rows.filter("false"), ["x"], by=["x"]).count() == 0


def test_quartiles_stay_exact_when_a_bracket_misses(spark, skewed, monkeypatch):
    """With far too small a sketch, ranks outside its brackets are searched for."""
    exact = skewed.filter(~F.isnan("x") & F.col("x").isNotNull()).agg(F.percentile("x", [0.25, 0.5, 0.75])).first()[0]
    for size, margin in ((8192, None), (8, 0.0)):
        monkeypatch.setattr("intervalcast.operators.profile.SKETCH", size)
        if margin is not None:
            monkeypatch.setattr("intervalcast.operators.quantiles.rank_error", lambda k: margin)
        (row,) = numeric_summary(skewed, ["x"]).collect()
        assert [row.p25, row.p50, row.p75] == pytest.approx(exact, rel=1e-12)


@pytest.mark.parametrize("by", [[], ["key"]])
def test_rates_of_a_stream_equal_those_of_the_table(spark, tmp_path, by):
    """Eight batches in order of time: what is closed at the end equals the batch form."""
    rows = spark.range(400).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7 + F.col("id") % 5).alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("key"),
        (F.col("id") * 3.0).alias("value"),
    )
    for i in range(8):
        part = rows.filter(F.floor((F.unix_seconds("ts") - 1_700_000_000) / 360) == i)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = with_event_time(stream_parquet(spark, f"{tmp_path}/in", rows.schema, files_per_trigger=1), "ts", "1 minute")
    closed = rows.agg(F.max("ts") - F.expr("INTERVAL 1 MINUTE")).first()[0]

    def run(make, name):
        out = make(stream)
        query = finish(append_parquet(out, f"{tmp_path}/{name}", f"{tmp_path}/c{name}"))
        assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
        found = read_parquet(spark, f"{tmp_path}/{name}", out.schema).collect()
        expected = make(rows).filter(F.col("window_end") <= closed).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, expected)) and found

    run(lambda df: monitor.trailing_rate(df, ts="ts", length=60, slide=10, by=by), "rate")
    if not by:
        run(lambda df: monitor.bucket_rate(df, ts="ts", value="value", length=120, slide=30), "bucket")
        with pytest.raises(ValueError, match="table"):
            monitor.trailing_rate(stream, ts="ts", empty=True)
