"""Column expressions on hand-made values."""

import math

import pytest
from pyspark.sql import functions as F

from intervalcast import functions as fn
from intervalcast.operators.features import add_interval_features, add_size_features
from intervalcast.operators.resample import interval_mean, interval_of


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    ("clock", "start"),
    [
        ("2022-10-02 00:30:00", "2022-10-02 00:00:00"),
        ("2022-10-02 04:30:00", "2022-10-02 00:00:00"),
        ("2022-10-02 07:30:00", "2022-10-02 06:00:00"),
        ("2022-04-03 00:30:00", "2022-04-03 00:00:00"),
        ("2022-04-03 05:30:00", "2022-04-03 00:00:00"),
    ],
)
def test_interval_start_keeps_to_the_clock_when_it_changes(spark, zone, clock, start):
    zone("Australia/Melbourne")
    zoned = fn.interval_start(ts(clock))
    zoneless = fn.interval_start(F.lit(clock).cast("timestamp_ntz"), zoneless=True)
    assert one(spark, start=zoned.cast("string"))["start"] == start
    assert one(spark, start=zoneless.cast("string"))["start"] == start


def test_interval_start_has_the_type_of_its_column(spark):
    df = spark.sql("SELECT TIMESTAMP '2022-01-01 07:00:00' AS a, TIMESTAMP_NTZ '2022-01-01 07:00:00' AS b")
    for name, kind in (("a", "timestamp"), ("b", "timestamp_ntz")):
        start = df.select(interval_of(df, name).alias("start"))
        assert start.dtypes == [("start", kind)]
        assert start.select(F.col("start").cast("string")).first()[0] == "2022-01-01 06:00:00"


def test_interval_names_and_numbers(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    rows = hours.select(
        fn.interval_index(F.make_timestamp_ntz(*map(F.lit, (2022, 1, 1)), "h", F.lit(5), F.lit(0))).alias("i"),
        fn.interval_label(F.make_timestamp_ntz(*map(F.lit, (2022, 1, 1)), "h", F.lit(5), F.lit(0))).alias("n"),
    ).collect()
    assert [r["i"] for r in rows] == [h // 6 for h in range(24)]
    names = ["0:00-5:59", "6:00-11:59", "12:00-17:59", "18:00-23:59"]
    assert [r["n"] for r in rows] == [names[h // 6] for h in range(24)]


def test_null_time_stays_null(spark):
    none = F.lit(None).cast("timestamp")
    early = fn.interval_start(ts("1969-12-31 23:00:00"))
    assert one(spark, a=early.cast("string"))["a"] == "1969-12-31 18:00:00"
    row = one(spark, a=fn.interval_start(none), b=fn.interval_label(none), c=fn.interval_index(none))
    assert list(row) == [None, None, None]


def test_intervals_must_divide_the_day(spark):
    with pytest.raises(ValueError):
        fn.interval_start(F.current_timestamp(), 5)


def test_encodings(spark):
    sine, cosine = fn.cyclic(F.lit(90.0), 360)
    row = one(
        spark,
        s=sine,
        c=cosine,
        size=fn.log_size(F.lit(0)),
        void=fn.log_size(F.lit(-1)),
        decade=fn.decade(F.lit(1995)),
        early=fn.decade(F.lit(-15)),
    )
    assert row["s"] == pytest.approx(1) and row["c"] == pytest.approx(0)
    assert row["size"] == 0 and row["void"] is None
    assert (row["decade"], row["early"]) == (1990, -10)


def test_loose_values(spark):
    texts = ["", "abc", "NaN", "1.5", "3", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = df.select(
        fn.loose_double(F.col("t")).alias("d"),
        fn.loose_int(F.col("t")).alias("i"),
        fn.nan_to_null(fn.loose_double(F.col("t"))).alias("n"),
    ).collect()
    assert [r["d"] for r in rows if not (r["d"] and math.isnan(r["d"]))] == [None, None, 1.5, 3.0, None]
    assert math.isnan(rows[2]["d"])
    assert [r["n"] for r in rows] == [None, None, None, 1.5, 3.0, None]
    assert rows[4]["i"] == 3 and rows[0]["i"] is None and rows[1]["i"] is None


def test_times_from_text(spark):
    row = one(
        spark,
        unix=fn.unix_timestamp(F.lit("1654084800.5")).cast("string"),
        blank=fn.unix_timestamp(F.lit("")),
        z=fn.iso_timestamp(F.lit("2022-06-01T12:00:00Z")).cast("string"),
        offset=fn.iso_timestamp(F.lit("2022-06-01T12:00:00+10:00")).cast("string"),
        bad=fn.iso_timestamp(F.lit("yesterday")),
    )
    assert row["unix"] == "2022-06-01 12:00:00.5"
    assert row["z"] == "2022-06-01 12:00:00" and row["offset"] == "2022-06-01 02:00:00"
    assert row["blank"] is None and row["bad"] is None


def test_lag_of_thirty_seconds(spark):
    lag = fn.seconds_between(ts("2022-06-01 12:00:30"), ts("2022-06-01 12:00:00"))
    assert one(spark, lag=lag)["lag"] == 30.0


def sample_rows(spark):
    """One row per interval of a day."""
    rows = [
        (f"2022-06-01 {h:02}:00:00", 100 + i, 10000 + i, 1995) for i, h in enumerate([0, 6, 12, 18])
    ]
    df = spark.createDataFrame(rows, "t STRING, building_id INT, square_feet INT, year_built INT")
    return df.withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def test_time_features_tell_the_intervals_apart(spark):
    rows = add_interval_features(sample_rows(spark), "event_time").collect()
    assert {r["time_interval_num"] for r in rows} == {0, 1, 2, 3}
    assert len({(round(r["time_sin"], 6), round(r["time_cos"], 6)) for r in rows}) == 4
    assert {r["month"] for r in rows} == {6}


def test_size_features(spark):
    row = add_size_features(sample_rows(spark), size="square_feet", year="year_built").first()
    assert row["decade"] == 1990 and row["log_square_feet"] == pytest.approx(math.log(10001))


def test_circular_mean_of_angles(spark):
    df = spark.sql(
        "SELECT 1 AS k, TIMESTAMP '2022-01-01 01:00:00' AS t, explode(array(350D, 10D)) AS angle"
    )
    plain = interval_mean(df, keys=["k"], ts="t", values=["angle"]).first()["angle"]
    turned = interval_mean(df, keys=["k"], ts="t", values=["angle"], angles=["angle"]).first()["angle"]
    assert plain == 180.0
    assert min(turned, 360 - turned) == pytest.approx(0, abs=1e-9)
