"""What the text operators share: columns, Arrow batches, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import materialise

__all__ = [
    "SPACE",
    "WORD",
    "appended",
    "crc_of",
    "documents",
    "fresh",
    "kept_rows",
    "looked_up",
    "materialise",
    "maybe_in",
    "sorted_groups",
    "text_or_empty",
    "words_of",
]

# What separates words, and what words are.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Bytes A-Z to a-z.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    """The text as such; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_of(column: str = "doc_id") -> Column:
    """Checksum of the id written as text; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text, in UTF-8."""
    return text.encode().translate(LOWER).split() if text else []


def appended(
    df: DataFrame, fields: list[T.StructField], text: str, compute: Callable[[list], list]
) -> DataFrame:
    """The rows with new columns computed from the text column, batch by batch.

    ``compute`` gets the batch's texts (None for null) and returns one array or list for
    each field.  Columns of the frame that have a new column's name are replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]
    schema = T.StructType(kept + fields)
    place = [f.name for f in df.schema.fields].index(text)
    keep_at = [i for i, f in enumerate(df.schema.fields) if f.name in set(names)]
    types = [_ARROW[f.dataType.simpleString()] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE):
                part = batch.slice(start, PIECE)
                found = compute(part.column(place).to_pylist())
                arrays = [part.column(i) for i in keep_at]
                arrays += [pa.array(x, type=t) for x, t in zip(found, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)


# Rows handled at once inside a task: bounds its memory, changes no result.
PIECE = 500

_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}


HOT_SHARE = 1000


def looked_up(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of rows with one row per key, where a key may own a third of all rows.

    Keys with more than 1/``HOT_SHARE`` of all rows (``size`` says how many a key has) are
    fewer than ``HOT_SHARE``: these are broadcast, the others are joined by shuffle.  Keys
    hold no nulls.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.filter(F.col(size) * HOT_SHARE > total)
    rest = groups.filter(F.col(size) * HOT_SHARE <= total)
    return rows.join(F.broadcast(hot), keys).unionByName(
        rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    )


def kept_rows(docs: DataFrame, marks: dict[str, Column], winners: DataFrame) -> DataFrame:
    """The rows whose marks are among the winners (columns named as the marks), one per mark.

    Rows that share all marks are told apart by their columns, in order; the first stays.
    The marks should differ from row to row, so that no task gets a large group.
    """
    names = {name: fresh(docs, f"__{name}") for name in (*marks, "place")}
    keys = [names[name] for name in marks]
    left = docs.withColumns({names[name]: column for name, column in marks.items()}).alias("l")
    right = winners.select(*(F.col(name).alias(names[name]) for name in marks)).alias("r")
    on = [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    order = [F.to_json(F.struct(c)) if _unordered(docs, c) else F.col(c) for c in docs.columns]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    met = left.join(right, on, "left_semi").withColumn(names["place"], place)
    return met.filter(F.col(names["place"]) == 1).select(*docs.columns)


def _unordered(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in {"map", "variant"}


def sorted_groups(name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Runs of rows (key, kind, blob) with equal values of a sorted column."""
    held, rows = None, []
    for batch in batches:
        at = batch.schema.get_field_index(name)
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "kind", "blob")]
        for i, value in enumerate(batch.column(at).to_pylist()):
            if value != held and rows:
                yield held, rows
                rows = []
            held = value
            rows.append(tuple(c[i].as_py() for c in columns))
    if rows:
        yield held, rows


# Bits of a filter: four megabytes, whatever the table holds.
FILTER_BITS = 1 << 25


def maybe_in(rows: DataFrame, keys: DataFrame, column: str, *, inverse: bool = False) -> DataFrame:
    """Rows whose column may be among the keys (both bigint hashes): none that is, is lost.

    ``inverse`` gives the other rows, which are not among the keys for sure.

    A filter of a fixed size is made of the keys and sent to the tasks.  It spares the
    shuffle before a join most rows without a partner, as long as keys are fewer than bits.
    """
    # Buckets of 2^15 bits, each one row of four kilobytes.
    at = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1
    bucket, place = F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("place")
    parts = keys.select(bucket, place).groupBy("bucket")
    found = parts.agg(F.bitmap_construct_agg("place").alias("bits")).collect()
    bits = np.zeros((FILTER_BITS >> 15, 4096), dtype=np.uint8)
    for row in found:
        bits[row.bucket - 1] = np.frombuffer(row.bits, dtype=np.uint8)
    sent = rows.sparkSession.sparkContext.broadcast(bits.reshape(-1))

    @F.pandas_udf("boolean")
    def is_set(values: pd.Series) -> pd.Series:
        at = values.to_numpy() % FILTER_BITS
        return pd.Series((sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1)

    return rows.filter(~is_set(column) if inverse else is_set(column))
