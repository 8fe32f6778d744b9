"""DataFrame operators on hand-made tables."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from intervalcast.operators import enrich, monitor, outliers, profile, quantiles, season, split
from intervalcast.operators.accuracy import evaluator_scores, regression_metrics, rmsle, scores
from intervalcast.operators.messages import from_messages, to_messages, with_position
from intervalcast.operators.preprocess import impute_means
from intervalcast.schemas import CONDITION_COLS, WEATHER, WEATHER_BATCH, WEATHER_EVENT


def labels(spark, values):
    return spark.createDataFrame([(v,) for v in values], "label DOUBLE")


def test_bounds_of_skewed_labels_by_hand(spark):
    """Of 0, 4, 8, 8, 100: mean 24, squared deviations 576, 400, 256, 256, 5776, over four."""
    df = labels(spark, [8.0, 0.0, None, 100.0, 4.0, 8.0])
    lo, hi = outliers.bounds_on_driver(outliers.sigma_bounds(df, "label", 1.5))
    width = 1.5 * (7264 / 4) ** 0.5
    assert (lo, hi) == pytest.approx((24 - width, 24 + width))
    lazily = sorted(r["label"] for r in outliers.sigma_filter(df, "label", 1.5).collect())
    eagerly = sorted(r["label"] for r in outliers.range_filter(df, "label", lo, hi).collect())
    assert lazily == eagerly == [0.0, 4.0, 8.0, 8.0]


@pytest.mark.parametrize("values", [[], [None, None], [-3.25, None]])
def test_bounds_of_fewer_than_two_labels_are_none(spark, values):
    df = labels(spark, values)
    assert outliers.bounds_on_driver(outliers.sigma_bounds(df, "label")) == (None, None)
    for kept in (outliers.sigma_filter(df, "label"), outliers.range_filter(df, "label", None, None)):
        assert kept.count() == len(values)


def test_range_is_inclusive_and_drops_nulls(spark):
    df = labels(spark, [1.0, 2.0, 3.0, None])
    assert [r[0] for r in outliers.range_filter(df, "label", 1.0, 2.0).collect()] == [1.0, 2.0]


def test_unmatched_rows_stay_and_are_flagged(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k INT")
    dim = spark.createDataFrame([(1, "a")], "k INT, name STRING")
    rows = {r["k"]: (r["name"], r["hit"]) for r in enrich.attach(facts, dim, ["k"], matched="hit").collect()}
    assert rows == {1: ("a", True), 2: (None, False), None: (None, False)}


def test_fan_out_by_owned_categories(spark):
    df = spark.createDataFrame([(1,), (2,)], "b INT")
    owned = spark.createDataFrame([(1, "e"), (1, "c"), (1, "e")], "b INT, meter STRING")
    rows = enrich.fan_out_by(df, owned, ["b"], category="meter").collect()
    assert sorted((r["b"], r["meter"] or "") for r in rows) == [(1, "c"), (1, "e"), (2, "")]
    assert enrich.fan_out(df, "meter", ["c", "e", "h", "s"]).count() == 8


@pytest.mark.parametrize("few", [0, 5, 10_000])
def test_quantiles_equal_a_sort(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    draw = random.Random(7)
    heavy = [draw.lognormvariate(0, 4) * draw.choice([-1, 1]) for _ in range(400)]
    skewed = [3.0] * 200 + [draw.random() for _ in range(200)]
    rows = list(zip(heavy, skewed)) + [(None, float("nan"))]
    df = spark.createDataFrame(rows, "heavy DOUBLE, skewed DOUBLE")
    got = {r["column_name"]: r for r in profile.numeric_summary(df, ["heavy", "skewed"]).collect()}
    for name, values in {"heavy": heavy, "skewed": skewed}.items():
        cuts = statistics.quantiles(values, n=4, method="inclusive")
        row = got[name]
        assert row["count"] == 400 and row["min"] == min(values) and row["max"] == max(values)
        assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(cuts, rel=1e-12)


def test_summary_of_an_empty_column(spark):
    row = profile.numeric_summary(labels(spark, [None]), ["label"]).first()
    assert row["count"] == 0 and row["p50"] is None and row["mean"] is None


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"], "v STRING")
    rows = profile.top_values(df, ["v"], 2).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in rows] == [("a", 2), ("b", 2)]


def test_null_counts_and_filter_counts(spark):
    df = labels(spark, [1.0, None, 3.0])
    assert profile.null_counts(df).first()["label"] == 1
    assert tuple(profile.filter_counts(df, F.col("label") > 1).first()) == (3, 1)


def test_season_is_the_three_warmest_and_coldest_months(spark):
    rows = [(f"2022-{m:02}-15 00:00:00", float(m)) for m in range(1, 13)] + [(None, 50.0)]
    df = spark.createDataFrame(rows, "t STRING, temp DOUBLE").withColumn("t", F.col("t").cast("timestamp"))
    peaks = season.peak_months(df, ts="t", value="temp")
    named = season.label_season(df, peaks, ts="t").collect()
    peak = sorted(r["temp"] for r in named if r["season"] == "peak")
    assert peak == [1.0, 2.0, 3.0, 10.0, 11.0, 12.0]
    assert len(named) == 13


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    train, test = split.hash_split(df, ["k"], 0.8)
    again, _ = split.hash_split(df.repartition(7), ["k"], 0.8)
    kept = {r["k"] for r in train.collect()}
    assert kept == {r["k"] for r in again.collect()}
    assert len(kept) + test.count() == 1000 and 740 < len(kept) < 860


def test_samples(spark):
    df = spark.range(1000)
    assert split.random_sample(df, 1.0, 1) is df and split.hash_sample(df, ["id"], 1.0) is df
    assert 150 < split.random_sample(df, 0.2, 1).count() < 250
    assert 150 < split.hash_sample(df, ["id"], 0.2).count() < 250


@pytest.mark.parametrize("portable", [False, True])
def test_small_fractions_and_extreme_ratios(spark, portable):
    df = spark.range(1_000_000)
    assert 8 < split.hash_sample(df, ["id"], 0.00004, portable=portable).count() < 80
    for ratio, few in ((0.996, 1), (0.004, 0)):
        sides = split.hash_split(df, ["id"], ratio, portable=portable)
        assert 3600 < sides[few].count() < 4400
    assert split.hash_sample(df, ["id"], 0.0).count() == 0


def test_seeds_change_the_split(spark):
    df = spark.range(1000)
    one, two = (split.hash_split(df, ["id"], 0.5, salt=f"split{s}")[0] for s in (1, 2))
    assert 150 < one.intersect(two).count() < 350


def test_train_only_filter_leaves_the_test_rows(spark):
    train, test = labels(spark, [10.0] * 20 + [20.0]), labels(spark, [1000.0])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    kept = split.train_only_filter(both, "label")
    assert kept.groupBy("part").count().orderBy("part").collect() == [("test", 1), ("train", 20)]


def test_metrics_agree_with_the_evaluator(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.5), (5.0, 5.5)], "y DOUBLE, prediction DOUBLE")
    ours, theirs = scores(df, "y"), evaluator_scores(df, "y")
    assert {k: ours[k] for k in theirs} == pytest.approx(theirs)


def test_metrics_skip_rows_without_a_value(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 5.0), (5.0, None), (0.0, -3.0)], "y DOUBLE, prediction DOUBLE"
    )
    row = regression_metrics(df, "y").first()
    assert (row["rows"], row["skipped"]) == (2, 2)
    # Negative predictions count as zero.
    assert rmsle(df, "y") == 0.0


def test_impute_means_fills_nulls_and_nans(spark):
    df = spark.createDataFrame([(2, 1.0), (None, float("nan")), (3, 3.0)], "a INT, b DOUBLE")
    filled = sorted((r["a"], r["b"]) for r in impute_means(df, ["a", "b"]).collect())
    assert filled == [(2.0, 1.0), (2.5, 2.0), (3.0, 3.0)]


def test_positions_with_a_hot_time(spark):
    """Most rows share one time; the unique second key still orders and spreads them."""
    df = spark.range(2000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(500).alias("t")
    )
    rows = with_position(df.repartition(5), ["t", "id"]).collect()
    expected = sorted((r["t"], r["id"]) for r in rows)
    assert [(r["t"], r["id"]) for r in sorted(rows, key=lambda r: r["position"])] == expected
    assert sorted(r["position"] for r in rows) == list(range(2000))


def weather(spark, n):
    hours = spark.range(n).select(
        (F.col("id") % 3).cast("int").alias("site_id"),
        F.timestamp_seconds(F.lit(1640995200) + F.col("id") * 600).alias("event_time"),
        *[F.when(F.col("id") % 7 != 0, F.col("id") / 8).otherwise(F.lit(float("nan"))).alias(c) for c in CONDITION_COLS],
    )
    return hours


def test_messages_hold_120_rows_in_time_order(spark):
    df = weather(spark, 300)
    sent = to_messages(
        df.repartition(4), order_by=["event_time", "site_id"], fields=WEATHER_EVENT.fieldNames()
    )
    sizes = {}
    opened = from_messages(sent, WEATHER_BATCH, extra=["message_no"])
    for row in opened.collect():
        sizes.setdefault(row["message_no"], []).append(row["event_time"])
    assert [len(sizes[n]) for n in sorted(sizes)] == [120, 120, 60]
    assert max(sizes[0]) < min(sizes[1]) and max(sizes[1]) < min(sizes[2])
    # Numbers that are not numbers are sent as null.
    assert opened.filter(F.col("wind_speed").isNull()).count() == 43
    assert opened.filter(F.isnan("wind_speed")).count() == 0


def test_schemas():
    assert set(CONDITION_COLS) <= set(WEATHER.fieldNames())
    assert WEATHER_BATCH.fieldNames() == ["batch_ts", "rows"]
    kinds = {f.name: f.dataType.typeName() for f in WEATHER_EVENT}
    assert kinds["site_id"] == "integer" and kinds["event_time"] == "timestamp"
    assert {kinds[c] for c in CONDITION_COLS} == {"double"}


# Monitoring


def records(spark, *rows):
    shape = "event_time STRING, site_id INT, meter_type STRING, prediction DOUBLE, arrival INT"
    full = [(t, s, m, p, i) for i, (t, s, m, p) in enumerate(rows)]
    return spark.createDataFrame(full, shape).withColumn("event_time", F.col("event_time").cast("timestamp"))


NOON = "2022-06-01 12:00:00"


def now():
    return F.lit("2022-06-01 12:00:30").cast("timestamp")


def metric(df, name, labels=""):
    return {(r["metric"], r["labels"]): r["value"] for r in df.collect()}.get((name, labels))


def snap(spark, *rows):
    return monitor.snapshot(records(spark, *rows), now=now())


def test_one_record(spark):
    taken = snap(spark, (NOON, 1, "e", 512.5))
    assert metric(taken, monitor.PROCESSED) == 1
    assert metric(taken, monitor.LATEST, 'meter_type="e",site_id="1"') == 512.5
    assert metric(taken, monitor.LAG) == 30.0


def test_latest_record_wins_and_both_count(spark):
    taken = snap(spark, (NOON, 1, "e", 100.0), ("2022-06-01 11:00:00", 1, "e", 200.0))
    assert metric(taken, monitor.LATEST, 'meter_type="e",site_id="1"') == 200.0
    assert metric(taken, monitor.PROCESSED) == 2
    by_event = monitor.latest_value(
        records(spark, (NOON, 1, "e", 100.0), ("2022-06-01 11:00:00", 1, "e", 200.0)),
        labels=["meter_type"],
        value="prediction",
        arrival="event_time",
    )
    assert by_event.first()["latest"] == 100.0


def test_missing_event_time_counts_but_has_no_lag(spark):
    taken = snap(spark, (None, 1, "e", 1.0))
    assert metric(taken, monitor.PROCESSED) == 1 and metric(taken, monitor.LAG) is None
    lag = monitor.newest_lag(
        records(spark, (NOON, 1, "e", 1.0), (None, 1, "e", 1.0)),
        event_time="event_time",
        arrival="arrival",
        now=now(),
    ).first()
    assert lag["lag_seconds"] == 30.0


def test_histogram_places_300_above_250(spark):
    taken = snap(spark, (NOON, 1, "e", 300.0))
    buckets = [metric(taken, f"{monitor.DISTRIBUTION}_bucket", f'le="{b}"') for b in ("100.0", "250.0", "500.0", "+Inf")]
    assert buckets == [0, 0, 1, 1]
    assert metric(taken, f"{monitor.DISTRIBUTION}_count") == 1
    rows = monitor.histogram(records(spark, (NOON, 1, "e", 300.0)), "prediction").collect()
    assert {r["le"]: r["bucket"] for r in rows}["500.0"] == 1 and len(rows) == 9


def test_missing_labels_are_unknown(spark):
    taken = snap(spark, (NOON, None, None, 42.0))
    assert metric(taken, monitor.LATEST, 'meter_type="unknown",site_id="unknown"') == 42.0


def test_a_number_that_is_none_is_rejected(spark):
    rows = [(None, '{"prediction": "NaN"}'), (None, '{"prediction": 1.5}')]
    screened = monitor.screen(spark.createDataFrame(rows, "key STRING, value STRING"))
    assert [r["reject"] for r in screened.collect()] == ["prediction is not a number", None]


def test_snapshots_add_up(spark):
    first, second = (NOON, 1, "e", 100.0), ("2022-06-01 12:00:10", 1, "e", 300.0)
    merged = monitor.merge_snapshots(snap(spark, first), snap(spark, second))
    whole = snap(spark, first, second)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    kept = monitor.merge_snapshots(snap(spark, first), snap(spark, (None, 2, "e", 1.0)))
    assert metric(kept, monitor.LAG) == 30.0


def test_screening(spark):
    texts = [
        '{"event_time": "2022-06-01T12:00:00Z", "site_id": 1, "meter_type": "e", "prediction": 5}',
        '{"prediction": "7.5"}',
        '{"prediction": "many"}',
        '{"site_id": 1}',
        '{"prediction": null}',
        '{"prediction": 5',
        "nothing",
        None,
        '{"prediction": 1, "event_time": "soon", "site_id": null}',
    ]
    df = spark.createDataFrame([(None, t) for t in texts], "key STRING, value STRING")
    rows = monitor.screen(df).collect()
    assert [r["reject"] for r in rows] == [
        None,
        None,
        "prediction is not a number",
        "missing prediction",
        "missing prediction",
        "malformed",
        "malformed",
        "malformed",
        None,
    ]
    assert rows[0]["prediction"] == 5.0 and rows[0]["event_time"] is not None
    assert rows[1]["meter_type"] == rows[8]["site_id"] == "unknown"
    assert rows[8]["event_time"] is None


def test_trailing_rate_lists_empty_windows(spark):
    df = spark.createDataFrame([("2022-01-01 00:00:01",), ("2022-01-01 00:01:00",)], "t STRING")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    rows = monitor.trailing_rate(df, ts="t", length=20, slide=10, empty=True).orderBy("window_end").collect()
    assert [(str(r["window_end"])[14:], r["records"]) for r in rows] == [
        ("00:10", 1),
        ("00:20", 1),
        ("00:30", 0),
        ("00:40", 0),
        ("00:50", 0),
        ("01:00", 0),
        ("01:10", 1),
        ("01:20", 1),
    ]
    assert rows[0]["rate"] == 1 / 20
    with pytest.raises(ValueError):
        monitor.trailing_rate(df, ts="t", length=25, slide=10)


def test_empty_windows_over_several_days(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ '2022-01-01 00:00:01', TIMESTAMP_NTZ '2022-01-04 12:00:00')) AS t")
    rows = monitor.trailing_rate(df, ts="t", length=3600, slide=3600, empty=True).collect()
    assert len(rows) == len({r["window_end"] for r in rows}) == 3 * 24 + 13


def test_lights(spark):
    df = spark.createDataFrame([(0.0,), (59.9,), (60.0,), (299.0,), (300.0,), (None,)], "x DOUBLE")
    lights = [r[0] for r in df.select(monitor.freshness(F.col("x"))).collect()]
    assert lights == ["green", "green", "yellow", "yellow", "red", None]
    rates = spark.createDataFrame([(0.0,), (0.009,), (0.01,)], "x DOUBLE")
    assert [r[0] for r in rates.select(monitor.throughput(F.col("x"))).collect()] == ["red", "red", "green"]


def test_lag_percentiles(spark):
    df = spark.range(100).select(F.timestamp_seconds(1000 - F.col("id")).alias("t"))
    row = monitor.lag_percentiles(df, event_time="t", now=F.timestamp_seconds(F.lit(1000))).first()
    assert abs(row["p50_lag_seconds"] - 50) <= 1 and abs(row["p95_lag_seconds"] - 95) <= 1
