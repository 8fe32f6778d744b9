"""Metrics of a scored stream as DataFrame aggregates.

The functions up to ``histogram`` aggregate all records and work on a batch, on a stream
in update or complete mode, and inside ``foreachBatch``.  The rates and the live series
are windowed: records are first counted per pane of one slide, so a sliding window adds
up a few panes and no record is copied into every window it belongs to.  Rates work on a
watermarked stream in append mode as well, with a row of state per open pane and window.

Rates are records in the window divided by its length.  They are not extrapolated from
scraped samples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import or_unknown, seconds_between

# Histogram bounds, metric names and alert thresholds of the dashboard.
BOUNDS = (50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0, 10000.0)
PROCESSED = "energy_predictions_processed_total"
LATEST = "energy_predicted_consumption"
LAG = "energy_prediction_lag_seconds"
DISTRIBUTION = "energy_predicted_consumption_distribution"
LAG_YELLOW, LAG_RED = 60.0, 300.0
RATE_GREEN = 0.01


def screen(messages: DataFrame, value: str = "value") -> DataFrame:
    """Read JSON prediction records and say which can be used.

    Adds the parsed fields, labels with ``unknown`` for missing ones, and ``reject``: null
    for a usable record, otherwise why it is not.  Filter on it to split the records from
    the quarantine.
    """
    names = ["event_time", "site_id", "building_id", "meter_type", "prediction", "broken"]
    shape = ", ".join(f"{name} STRING" for name in names)
    parsed = messages.withColumn(
        "_r",
        F.from_json(
            F.col(value).cast("string"),
            shape,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"},
        ),
    )
    prediction = F.col("_r.prediction").try_cast("double")
    reason = (
        F.when(F.col("_r").isNull() | F.col("_r.broken").isNotNull(), "malformed")
        .when(F.col("_r.prediction").isNull(), "missing prediction")
        .when(prediction.isNull() | F.isnan(prediction), "prediction is not a number")
    )
    return parsed.withColumns(
        {
            "event_time": F.try_to_timestamp(F.col("_r.event_time")),
            "site_id": or_unknown(F.col("_r.site_id")),
            "building_id": F.col("_r.building_id"),
            "meter_type": or_unknown(F.col("_r.meter_type")),
            "prediction": prediction,
            "reject": reason,
        }
    ).drop("_r")


def processed(records: DataFrame) -> DataFrame:
    """Number of records, those without an event time included."""
    return records.agg(F.count("*").alias("processed"))


def latest_value(
    records: DataFrame, *, labels: Sequence[str], value: str, arrival: str | Column
) -> DataFrame:
    """Value that arrived last per label set.

    ``arrival`` orders the records: an ingest time or offset, or a struct of both.  Give the
    event time instead for the newest observation.
    """
    keys = [or_unknown(F.col(name)).alias(name) for name in labels]
    return records.groupBy(*keys).agg(F.max_by(F.col(value), arrival).alias("latest"))


def newest_lag(
    records: DataFrame, *, event_time: str, arrival: str | Column, now: Column
) -> DataFrame:
    """Seconds from the observation to ``now`` for the record that arrived last.

    One row; records without an event time do not count, and with none left the lag is
    null.  Mean and maximum describe all records.
    """
    lag = seconds_between(now, F.col(event_time))
    arrived = F.col(arrival) if isinstance(arrival, str) else arrival
    order = F.when(F.col(event_time).isNotNull(), arrived)
    return records.agg(
        F.max_by(lag, order).alias("lag_seconds"),
        F.avg(lag).alias("mean_lag_seconds"),
        F.max(lag).alias("max_lag_seconds"),
    )


def lag_percentiles(records: DataFrame, *, event_time: str, now: Column) -> DataFrame:
    """Approximate median and 95th percentile of the lag, from a mergeable sketch."""
    lag = seconds_between(now, F.col(event_time))
    ends = F.percentile_approx(lag, [0.5, 0.95])
    return records.agg(ends.alias("_p")).select(
        F.col("_p")[0].alias("p50_lag_seconds"), F.col("_p")[1].alias("p95_lag_seconds")
    )


def bound_name(bound: float | None) -> str:
    return "+Inf" if bound is None else str(float(bound))


def _bucket_counts(value: str, bounds: Sequence[float]) -> list[Column]:
    counts = [
        F.count_if(F.col(value) <= F.lit(float(bound))).alias(f"_le{i}")
        for i, bound in enumerate(bounds)
    ]
    return [*counts, F.count_if(F.col(value) <= F.lit(float("inf"))).alias(f"_le{len(bounds)}")]


def _by_bound(bounds: Sequence[float], name: str, make=F.col) -> Column:
    """The bucket columns turned into rows (le, name)."""
    names = [*map(bound_name, bounds), bound_name(None)]
    cells = [
        F.struct(F.lit(le).alias("le"), make(f"_le{i}").alias(name)) for i, le in enumerate(names)
    ]
    return F.inline(F.array(*cells))


def histogram(
    records: DataFrame, value: str, bounds: Sequence[float] = BOUNDS, by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative counts: for each bound, the records with a value up to it.

    ``count`` and ``sum`` of the distribution are repeated on its rows.
    """
    counted = records.groupBy(*by).agg(
        *_bucket_counts(value, bounds), F.count(value).alias("count"), F.sum(value).alias("sum")
    )
    return counted.select(*by, "count", "sum", _by_bound(bounds, "bucket"))


def snapshot(
    records: DataFrame,
    *,
    value: str = "prediction",
    event_time: str = "event_time",
    labels: Sequence[str] = ("meter_type", "site_id"),
    arrival: str | Column = "arrival",
    now: Column | None = None,
) -> DataFrame:
    """All metric families in one table (metric, labels, value), a row per label set.

    One pass over the records: everything is aggregated per label set first, and families
    without labels are combined from that small result.  With numbers or times as
    ``arrival`` this is a hash aggregate; a struct would make it sort the records.
    """
    now = F.current_timestamp() if now is None else now
    order = F.col(arrival) if isinstance(arrival, str) else arrival
    lag = seconds_between(now, F.col(event_time))
    timed = F.when(lag.isNotNull(), order)
    names = [f"_le{i}" for i in range(len(BOUNDS) + 1)]
    per_label = records.groupBy(*[or_unknown(F.col(name)).alias(name) for name in labels]).agg(
        *_bucket_counts(value, BOUNDS),
        F.count("*").alias("_records"),
        F.count(value).alias("_count"),
        F.sum(value).alias("_sum"),
        F.max_by(F.col(value), order).alias("_latest"),
        F.max(order).alias("_order"),
        F.max_by(lag, timed).alias("_lag"),
        F.max(timed).alias("_timed"),
    )

    def sample(metric: str, number: str, of: Column | None = None, order: str = "_order") -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            (F.lit("") if of is None else of).alias("labels"),
            F.col(number).cast("double").alias("value"),
            F.col(order).alias("order"),
        )

    label_text = F.concat_ws(",", *[F.format_string(f'{n}="%s"', F.col(n)) for n in labels])
    bounds = [*map(bound_name, BOUNDS), bound_name(None)]
    samples = [
        sample(PROCESSED, "_records"),
        sample(LATEST, "_latest", label_text),
        sample(LAG, "_lag", order="_timed"),
        sample(f"{DISTRIBUTION}_count", "_count"),
        sample(f"{DISTRIBUTION}_sum", "_sum"),
        *[
            sample(f"{DISTRIBUTION}_bucket", name, F.lit(f'le="{le}"'))
            for le, name in zip(bounds, names)
        ],
    ]
    return _combined(per_label.select(F.inline(F.array(*samples))))


def _combined(samples: DataFrame) -> DataFrame:
    """Samples (metric, labels, value, order) of one metric each: counters add up, gauges
    take the last."""
    grouped = samples.groupBy("metric", "labels").agg(
        F.sum("value").alias("_sum"), F.max_by("value", "order").alias("_last")
    )
    gauge = F.col("metric").isin(LATEST, LAG)
    return grouped.select(
        "metric", "labels", F.when(gauge, F.col("_last")).otherwise(F.col("_sum")).alias("value")
    )


def merge_snapshots(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Two snapshots of successive records as one."""
    both = earlier.withColumn("order", F.lit(0)).unionByName(later.withColumn("order", F.lit(1)))
    return _combined(both.filter(F.col("value").isNotNull()))


def _seconds(count: int) -> str:
    return f"{count} seconds"


def _pane_sums(
    records: DataFrame,
    ts: str,
    length: int,
    slide: int,
    by: Sequence[str],
    measures: Sequence[Column],
    names: Sequence[str],
) -> DataFrame:
    """Sums of additive measures over windows of ``length`` seconds every ``slide``."""
    if slide < 1 or length % slide:
        raise ValueError("the window length must be a multiple of the slide")
    panes = records.groupBy(F.window(ts, _seconds(slide)).alias("_pane"), *by).agg(*measures)
    if records.isStreaming:
        # Two aggregates with state, one after the other: closed panes go into the windows they
        # belong to, and a window comes out when the watermark has passed its end.
        at = F.window(F.window_time("_pane"), _seconds(length), _seconds(slide))
        sums = [F.sum(name).alias(name) for name in names]
        windows = panes.groupBy(at.alias("_window"), *by).agg(*sums)
        return windows.select(F.col("_window.end").alias("window_end"), *by, *names)
    step = F.make_dt_interval(secs=F.lit(slide))
    ends = F.sequence(
        F.col("_pane.end"),
        F.col("_pane.end") + F.make_dt_interval(secs=F.lit(length - slide)),
        step,
    )
    return (
        panes.select(F.explode(ends).alias("window_end"), *by, *names)
        .groupBy("window_end", *by)
        .agg(*[F.sum(name).alias(name) for name in names])
    )


def _all_ends(records: DataFrame, ts: str, length: int, slide: int) -> DataFrame:
    """End of every window that overlaps the records' time range, also the empty ones.

    The range is one row; it is opened by day and then by slide, so no row holds more
    than a day of windows.
    """
    step = F.make_dt_interval(secs=F.lit(slide))
    tail = F.make_dt_interval(secs=F.lit(length - slide))
    day = F.make_dt_interval(days=F.lit(1))
    edges = records.agg(F.array(F.min(ts), F.max(ts)).alias("_edges"))
    panes = edges.select(F.explode("_edges").alias("_edge")).select(
        F.window("_edge", _seconds(slide)).end.alias("_end")
    )
    span = panes.agg(F.min("_end").alias("first"), (F.max("_end") + tail).alias("last"))
    days = span.select(F.explode(F.sequence("first", "last", day)).alias("first"), "last")
    upto = F.least(F.col("first") + day - step, F.col("last"))
    return days.repartition("first").select(
        F.explode(F.sequence(F.col("first"), upto, step)).alias("window_end")
    )


def trailing_rate(
    records: DataFrame,
    *,
    ts: str,
    length: int = 60,
    slide: int = 5,
    by: Sequence[str] = (),
    empty: bool = False,
) -> DataFrame:
    """Records per second over the last ``length`` seconds, every ``slide`` seconds.

    Windows are named by their end.  With ``empty`` the windows without records are there
    too, with rate 0; that needs ``by`` to be empty, and a table instead of a stream.
    """
    counted = _pane_sums(
        records, ts, length, slide, by, [F.count("*").alias("records")], ["records"]
    )
    if empty:
        if by:
            raise ValueError("empty windows can only be listed without labels")
        if records.isStreaming:
            raise ValueError("empty windows can only be listed for a table")
        counted = _all_ends(records, ts, length, slide).join(counted, "window_end", "left")
        counted = counted.withColumn("records", F.coalesce("records", F.lit(0).cast("bigint")))
    return counted.withColumn("rate", F.col("records") / F.lit(float(length)))


def bucket_rate(
    records: DataFrame,
    *,
    ts: str,
    value: str,
    bounds: Sequence[float] = BOUNDS,
    length: int = 300,
    slide: int = 5,
) -> DataFrame:
    """Rate of each cumulative histogram bucket over a trailing window."""
    names = [f"_le{i}" for i in range(len(bounds) + 1)]
    counted = _pane_sums(records, ts, length, slide, [], _bucket_counts(value, bounds), names)
    per_second = lambda name: F.col(name) / F.lit(float(length))
    return counted.select("window_end", _by_bound(bounds, "rate", per_second))


def live_series(
    records: DataFrame,
    *,
    ts: str,
    labels: Sequence[str],
    value: str,
    arrival: str,
    every: int = 5,
) -> DataFrame:
    """Latest value per label set at the end of every scrape interval with records."""
    keys = [or_unknown(F.col(name)).alias(name) for name in labels]
    grouped = records.groupBy(F.window(ts, _seconds(every)).alias("_w"), *keys)
    latest = grouped.agg(F.max_by(value, arrival).alias("latest"))
    return latest.select(F.col("_w.end").alias("scraped_at"), *labels, "latest")


def filled_series(
    records: DataFrame,
    *,
    ts: str,
    labels: Sequence[str],
    value: str,
    arrival: str,
    every: int = 5,
    span: int = 86_400,
) -> DataFrame:
    """Latest value per label set at every scrape, from its first record to the last scrape.

    A scrape without new records shows the value before it, as a gauge does.  Time is cut
    into ranges of ``span`` seconds: a range is filled by itself, from the last value before
    it, which comes from a table with a row per label set and range.  So a label set is
    spread over as many tasks as it has ranges, and what is ordered in one place is bounded
    by the scrapes of a range.
    """
    if every < 1 or span % every:
        raise ValueError("the span of a range must be a multiple of the scrape interval")
    step, day = F.make_dt_interval(secs=F.lit(every)), F.make_dt_interval(secs=F.lit(span))
    range_of = F.window(F.col("scraped_at"), _seconds(span)).start
    cells = live_series(records, ts=ts, labels=labels, value=value, arrival=arrival, every=every)
    cells = cells.withColumn("_range", range_of)
    end = F.broadcast(cells.agg(F.max("scraped_at").alias("_end")))
    last = F.max_by("latest", "scraped_at").alias("_last")
    ends = cells.groupBy(*labels, "_range").agg(last)
    # From each range with records to the next one, or to the end: what is carried into them.
    ahead = F.lead("_range").over(Window.partitionBy(*labels).orderBy("_range"))
    upto = F.coalesce(F.col("_next"), F.window(F.col("_end"), _seconds(span)).start)
    carried = (
        ends.withColumn("_next", ahead)
        .crossJoin(end)
        .withColumn("_upto", upto)
        .filter(F.col("_upto") > F.col("_range"))
        .select(
            *labels,
            F.explode(F.sequence(F.col("_range") + day, "_upto", day)).alias("_range"),
            F.col("_last").alias("latest"),
        )
        .withColumn("scraped_at", F.col("_range"))
    )
    # Of a carried value and a record of the same scrape the record counts.
    both = cells.withColumn("_own", F.lit(1)).unionByName(carried.withColumn("_own", F.lit(0)))
    inside = Window.partitionBy(*labels, "_range").orderBy("scraped_at", "_own")
    stop = F.least(F.col("_range") + day, F.col("_end") + step)
    until = F.coalesce(F.lead("scraped_at").over(inside), F.col("_stop"))
    rows = both.crossJoin(end).withColumn("_stop", stop).withColumn("_until", until)
    return rows.filter(F.col("_until") > F.col("scraped_at")).select(
        F.explode(F.sequence(F.col("scraped_at"), F.col("_until") - step, step)).alias("scraped_at"),
        *labels,
        "latest",
    )


def freshness(lag: Column) -> Column:
    """green, yellow or red by the lag in seconds."""
    slow = F.when(lag >= LAG_RED, "red").when(lag >= LAG_YELLOW, "yellow")
    return slow.when(lag.isNotNull(), "green")


def throughput(rate: Column) -> Column:
    """green from the threshold on, red below it."""
    return F.when(rate >= RATE_GREEN, "green").when(rate.isNotNull(), "red")
