"""Parsing, formatting and defaults of single values.

Nothing here raises on bad input: a value that cannot be read becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds survive a round trip through text; the default pattern keeps milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
READ_OPTIONS = {"mode": "PERMISSIVE"}


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def loose_double(text: Column) -> Column:
    return blank_to_null(text).try_cast("double")


def loose_int(text: Column) -> Column:
    return blank_to_null(text).try_cast("int")


def unix_timestamp(text: Column) -> Column:
    """Time from Unix seconds given as text, fractions included."""
    return F.timestamp_seconds(loose_double(text))


def iso_timestamp(text: Column) -> Column:
    """Time from ISO-8601 text, with an offset or ``Z``."""
    return F.try_to_timestamp(blank_to_null(text))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def or_unknown(label: Column) -> Column:
    return F.coalesce(label.cast("string"), F.lit("unknown"))


def row_json(*columns: str | Column) -> Column:
    """The given columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*(columns or ("*",))), JSON_OPTIONS)


def parse_row(text: Column, schema: T.StructType) -> Column:
    """A struct from JSON text; unreadable fields are null.

    Times are read in any ISO form: fixing a pattern for reading would reject those
    written without a fraction.
    """
    return F.from_json(text, schema, READ_OPTIONS)
