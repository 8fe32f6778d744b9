"""Session profile."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .settings import Settings

# Applied only where the launcher has set nothing.
PROFILE = {
    # AQE merges small reduce partitions, splits hot partitions of joins and turns a
    # shuffle join into a broadcast one when a side proves small at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # AQE merges partitions and never adds any, so shuffles of batch jobs start from many.
    # Stateful streams keep spark.sql.shuffle.partitions, fixed by their first checkpoint.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    # Window totals keep one state row per open (window, key): off heap, and only the
    # changes of a batch are uploaded.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(settings: Settings | None = None, *, with_kafka: bool = False) -> SparkSession:
    """A session with the profile; explicit ``--conf`` values win over it."""
    settings = settings or Settings()
    wanted = settings.spark
    builder = SparkSession.builder.appName(wanted.app_name)
    if wanted.master:
        builder = builder.master(wanted.master)
    if with_kafka:
        builder = builder.config("spark.jars.packages", settings.bus.spark_kafka_package)
    spark = builder.getOrCreate()

    launched_with = {key for key, _ in spark.sparkContext.getConf().getAll()}
    profile = PROFILE | {
        "spark.sql.session.timeZone": wanted.timezone,
        "spark.sql.files.maxPartitionBytes": wanted.max_partition_bytes,
    }
    if wanted.shuffle_partitions:
        profile["spark.sql.shuffle.partitions"] = str(wanted.shuffle_partitions)
    for key, value in profile.items():
        if key not in launched_with:
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark
