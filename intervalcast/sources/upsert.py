"""Keyed results that are updated in place, with readers that never see a gap.

A table is a folder:

    incoming/...                           the rows of the batch that is being written
    data/<batch>-<unique>/bucket=<b>/...   rows by the hash of their key, never changed
    manifest/version=<batch>/...           one file: which folder holds each bucket now

A batch rewrites the buckets that its keys fall into and nothing else, so the work follows
what has changed; then its manifest appears, as one file, by a rename.  A reader takes the
newest manifest and reads the folders it names.  Folders that are no longer named stay until
``vacuum``, for readers that are under way.  A batch that is run again finds its version
there and does nothing, so results are exact after a restart.

Two writers at once are not provided for: a streaming query is one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .sinks import paced
from .tables import ensure_folder

MANIFEST = "bucket INT, folder STRING, batch BIGINT"
KEPT = 8  # versions that vacuum leaves


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """The newest version, and its folder of each bucket; (-1, {}) where there is none.

    What comes to the driver is a row per bucket.
    """
    try:
        versions = spark.read.schema(f"{MANIFEST}, version BIGINT").parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, {}
    newest = versions.agg(F.max("version")).first()[0]
    if newest is None:
        return -1, {}
    rows = versions.filter(F.col("version") == newest).collect()
    return newest, {row.bucket: row.folder for row in rows if row.bucket >= 0}


def read_upserted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as its newest version has it."""
    _, folders = manifest(spark, path)
    return _folders(spark, path, schema, folders)


def _folders(spark: SparkSession, path: str, schema: T.StructType, folders: dict[int, str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    places = [f"{path}/data/{folder}/bucket={bucket}" for bucket, folder in sorted(folders.items())]
    return spark.read.schema(schema).parquet(*places)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert(
    batch: DataFrame,
    path: str,
    number: int,
    *,
    keys: Sequence[str],
    buckets: int,
    add: Sequence[str] = (),
) -> int:
    """Write the rows of a batch over those of the same key; gives the number of buckets written.

    Columns named in ``add`` are added to what is there instead of replacing it, and rows of
    one batch that share a key are added up first; without it keys must differ inside a batch.
    Keys may be structs or null.  ``buckets`` must stay the same for a table.
    """
    spark = batch.sparkSession
    newest, folders = manifest(spark, path)
    if newest >= number:
        return 0
    schema = batch.schema
    # The batch is computed once, here: what follows reads it more than once.
    numbered = batch.withColumn("bucket", bucket_of(keys, buckets))
    numbered.write.mode("overwrite").parquet(f"{path}/incoming")
    rows = spark.read.schema(numbered.schema).parquet(f"{path}/incoming")
    touched = [row.bucket for row in rows.select("bucket").distinct().collect()]
    held = {b: folders[b] for b in touched if b in folders}
    before = _folders(spark, path, schema, held).withColumn("bucket", bucket_of(keys, buckets))
    if add:
        # Of columns neither key nor sum the newest value stays.
        rest = [c for c in schema.names if c not in {*keys, *add}]
        both = rows.withColumn("_new", F.lit(1)).unionByName(before.withColumn("_new", F.lit(0)))
        sums = [F.sum(c).cast(schema[c].dataType).alias(c) for c in add]
        last = [F.max_by(c, "_new").alias(c) for c in rest]
        merged = both.groupBy("bucket", *keys).agg(*sums, *last)
    else:
        same = [before[k].eqNullSafe(rows[k]) for k in ("bucket", *keys)]
        merged = before.join(rows, same, "left_anti").unionByName(rows)
    folder = f"{number}-{uuid.uuid4().hex}"
    if touched:
        laid = merged.select(*schema.names, "bucket").repartition("bucket")
        laid.write.partitionBy("bucket").parquet(f"{path}/data/{folder}")
    named = folders | dict.fromkeys(touched, folder)
    # The row of bucket -1 makes a version also of a batch without rows.
    entries = [(b, f, number) for b, f in named.items()] + [(-1, "", number)]
    entry = spark.createDataFrame(entries, MANIFEST).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{path}/manifest/version={number}")
    return len(touched)


def upsert_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    keys: Sequence[str],
    buckets: int = 64,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """The rows an aggregate has changed at each trigger, over those of the same key.

    With a watermark the aggregate forgets closed windows, and the table keeps them: state
    is bounded, and the result is complete.
    """

    def write(batch: DataFrame, number: int) -> None:
        upsert(batch, path, number, keys=keys, buckets=buckets)
        if number % KEPT == KEPT - 1:
            vacuum(batch.sparkSession, path)

    ensure_folder(stream.sparkSession, path)
    writer = (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return paced(writer, every).start()


def vacuum(spark: SparkSession, path: str, keep: int = KEPT) -> int:
    """Delete folders that none of the newest ``keep`` versions names; gives their number.

    A reader that takes longer than ``keep`` batches may lose its files.
    """
    newest, _ = manifest(spark, path)
    versions = spark.read.schema(f"{MANIFEST}, version BIGINT").parquet(f"{path}/manifest")
    named = versions.filter((F.col("version") > newest - keep) & (F.col("bucket") >= 0))
    wanted = {row.folder for row in named.select("folder").distinct().collect()}
    old = versions.filter(F.col("version") <= newest - keep).select("version").distinct()
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for status in files.listStatus(root) if files.exists(root) else []:
        place = status.getPath()
        number = int(place.getName().partition("-")[0])
        # A folder of a batch that has no version yet may be in the making.
        if place.getName() not in wanted and number <= newest:
            files.delete(place, True)
            gone += 1
    for row in old.collect():
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/version={row.version}"), True)
    return gone
