"""Reports of streaming queries kept as a table, and gauges at every scrape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from intervalcast.operators import monitor
from intervalcast.sources.sinks import append_parquet
from intervalcast.sources.tables import stream_parquet
from intervalcast.streaming.progress import ProgressLog, events, runs, steps
from intervalcast.streaming.runner import finish

FILES = 112


def test_no_report_is_lost(spark, tmp_path):
    """More batches than Spark remembers, a second run of the query, and a query not asked for."""
    for i in range(4):
        rows = spark.range(i * FILES, (i + 1) * FILES, 1, FILES // 4)
        rows.write.mode("append").parquet(f"{tmp_path}/in")
    stream = stream_parquet(spark, f"{tmp_path}/in", rows.schema, files_per_trigger=1)
    with ProgressLog(spark, f"{tmp_path}/log", names={"kept"}) as log:
        done = finish(append_parquet(stream, f"{tmp_path}/a", f"{tmp_path}/ca", name="kept"))
        assert len(done.recentProgress) <= 100
        spark.range(7).write.mode("append").parquet(f"{tmp_path}/in")
        finish(append_parquet(stream, f"{tmp_path}/a", f"{tmp_path}/ca", name="kept"))
        small = stream_parquet(spark, f"{tmp_path}/in", rows.schema)
        finish(append_parquet(small, f"{tmp_path}/b", f"{tmp_path}/cb", name="other"))
        assert log.settle()
    first, second = runs(spark, f"{tmp_path}/log").orderBy("started_at").collect()
    assert (first.batches, first.input_rows, first.active, first.error) == (FILES, 4 * FILES, False, None)
    assert second.input_rows == 7 and not second.active and first.query == second.query == "kept"
    numbers = sorted(r.batch for r in steps(spark, f"{tmp_path}/log").collect())
    assert numbers == list(range(len(numbers)))
    assert events(spark, f"{tmp_path}/log").filter("event = 'ended'").count() == 2


def test_failures_are_reported(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    stream = stream_parquet(spark, f"{tmp_path}/in", spark.range(1).schema)
    broken = stream.select(F.raise_error(F.lit("no such thing")).cast("string").alias("x"))
    with ProgressLog(spark, f"{tmp_path}/log") as log:
        with pytest.raises(Exception, match="no such thing"):
            finish(append_parquet(broken, f"{tmp_path}/out", f"{tmp_path}/c"))
        assert log.settle()
    (row,) = runs(spark, f"{tmp_path}/log").collect()
    assert "no such thing" in row.error and not row.active and row.batches is None


def test_what_cannot_be_written_is_raised(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    spark.range(3).write.parquet(f"{tmp_path}/in")
    stream = stream_parquet(spark, f"{tmp_path}/in", spark.range(1).schema)
    log = ProgressLog(spark, f"{tmp_path}/file", pause=0.01)
    with pytest.raises(Exception), log:
        finish(append_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/c"))
        log.settle()


def plain_fill(rows, every):
    """rows (second, label, value, arrival) -> (scrape, label, latest)."""
    cells = {}
    for t, label, value, arrival in rows:
        scrape = (t // every + 1) * every
        cells[scrape, label] = max(cells.get((scrape, label), (-1, None)), (arrival, value))
    out, last = [], max((s for s, _ in cells), default=0)
    for label in {label for _, label in cells}:
        now = None
        for scrape in range(0, last + every, every):
            now = cells.get((scrape, label), (0, now))[1] if (scrape, label) in cells else now
            if now is not None:
                out.append((scrape, label, now))
    return sorted(out)


@pytest.mark.parametrize(("every", "span"), [(5, 20), (5, 5), (10, 86_400), (7, 70)])
def test_gauges_at_every_scrape(spark, every, span):
    """Ranges without records, records on the borders of ranges, ties of time."""
    rows = [(0, "a", 1.0, 1), (3, "a", 2.0, 2), (3, "b", 9.0, 3), (19, "a", 3.0, 5), (20, "a", 4.0, 4)]
    rows += [(97, "b", 5.0, 6), (100, "b", 6.0, 7), (99, "c", 0.5, 8), (241, "a", 7.0, 9), (240, "d", 8.0, 10)]
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(start + dt.timedelta(seconds=t), label, v, n) for t, label, v, n in rows],
        "ts TIMESTAMP_NTZ, label STRING, v DOUBLE, n INT",
    )
    found = monitor.filled_series(
        df, ts="ts", labels=["label"], value="v", arrival="n", every=every, span=span
    ).collect()
    # Scrapes are counted from 1970.
    shift = int((start - dt.datetime(1970, 1, 1)).total_seconds()) % every
    moved = plain_fill([(t + shift, label, v, n) for t, label, v, n in rows], every)
    got = sorted((int((r.scraped_at - start).total_seconds()), r.label, r.latest) for r in found)
    assert got == [(t - shift, label, v) for t, label, v in moved]


def test_gauges_of_nothing(spark):
    df = spark.createDataFrame([], "ts TIMESTAMP_NTZ, label STRING, v DOUBLE, n INT")
    assert monitor.filled_series(df, ts="ts", labels=["label"], value="v", arrival="n").collect() == []
    with pytest.raises(ValueError, match="multiple"):
        monitor.filled_series(df, ts="ts", labels=["label"], value="v", arrival="n", every=7, span=10)
