"""Tables stored by the hash of their join key, so that joins need no shuffle.

A table saved in ``buckets`` by some columns is read back as partitioned by them: grouping
by these columns (and any more), and joining with a table saved alike, happen in place.  The
shuffle is paid once, at writing.  Take keys of which no single value owns a large share of
the rows: (site, interval) deals a hot site over all its intervals.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import interval_start
from .scratch import new_folder


def save_bucketed(
    df: DataFrame, keys: Sequence[str], *, buckets: int, name: str = "", path: str | None = None
) -> DataFrame:
    """Save as an external table of the session's catalogue, a file per bucket, and read it.

    ``name`` is made up where it is not given; with ``path`` the files lie there.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    laid = df.repartition(buckets, *keys)
    writer = laid.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path or new_folder(spark, name)).saveAsTable(name)
    return spark.table(name)


def by_site_and_interval(
    readings: DataFrame,
    entities: DataFrame,
    feed: DataFrame,
    *,
    entity: str,
    site: str,
    ts: str,
    buckets: int,
    hours: int = 6,
) -> tuple[DataFrame, DataFrame]:
    """Readings with what is known of their entity, and the feed of the sites, stored alike.

    Both are in buckets of (site, ``interval_start``).  Readings of unknown entities stay,
    with a null site.
    """
    keys = [site, "interval_start"]

    def stored(rows: DataFrame) -> DataFrame:
        zoneless = isinstance(rows.schema[ts].dataType, T.TimestampNTZType)
        start = interval_start(F.col(ts), hours, zoneless=zoneless)
        return save_bucketed(rows.withColumn("interval_start", start), keys, buckets=buckets)

    return stored(readings.join(entities, entity, "left")), stored(feed)


def frame_in_place(
    readings: DataFrame,
    feed: DataFrame,
    *,
    entity: str,
    category: str,
    site: str,
    value: str,
    total: str,
    attributes: Sequence[str],
    means: Sequence[str],
) -> DataFrame:
    """The labelled frame from tables of ``by_site_and_interval``: two aggregates and a join,
    without an exchange.

    ``attributes`` belong to the entity: all of its rows have the same.  So they can be keys,
    which a hash aggregate takes and first values of text would keep it from.
    """
    keys = [site, "interval_start", entity, category, *attributes]
    totals = readings.groupBy(*keys).agg(F.sum(value).alias(total))
    conditions = feed.groupBy(site, "interval_start").agg(*[F.avg(name).alias(name) for name in means])
    return totals.join(conditions, [site, "interval_start"], "left")
