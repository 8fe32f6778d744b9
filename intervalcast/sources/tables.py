"""Bounded tables and file streams, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row."""
    return spark.read.schema(schema).option("header", True).csv(path)


BROKEN = "_broken"


def screened_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True
) -> DataFrame:
    """Every line of a CSV: with ``reject`` null for a row of the schema.

    A line whose cells do not fit the types, or that has too few or too many, keeps the cells
    that could be read and has in ``reject`` its text, the file, the start of the file's
    block it lies in and the columns left empty.  Empty cells of a sound line are nulls.
    """
    shape = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    reader = spark.read.schema(shape).option("header", header).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", BROKEN).csv(path)
    empty = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in schema.names]), lambda c: c.isNotNull()
    )
    reject = F.struct(
        F.col(BROKEN).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        empty.alias("empty"),
    )
    # All columns are part of the test, so that no cell goes unread, whatever is selected later.
    broken = F.col(BROKEN).isNotNull() & (F.size(empty) >= 0)
    return rows.withColumn("reject", F.when(broken, reject)).drop(BROKEN)


def accepted_rows(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col("reject").isNull()).drop("reject")


def rejected_lines(screened: DataFrame) -> DataFrame:
    return screened.filter(F.col("reject").isNotNull()).select("reject.*")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def csv_to_parquet(spark: SparkSession, path: str, schema: T.StructType, out: str) -> DataFrame:
    """Convert once, so that later scans are columnar and can skip columns and row groups."""
    read_csv(spark, path, schema).write.mode("overwrite").parquet(out)
    return read_parquet(spark, out, schema)


def literal_table(spark: SparkSession, name: str, values: list[str]) -> DataFrame:
    """A list of categories as a one-column table."""
    schema = T.StructType().add(name, T.StringType())
    return spark.createDataFrame([(value,) for value in values], schema)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Make the folder if it is missing, so that a stream can wait for its first files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream; all new files per trigger unless bounded."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
