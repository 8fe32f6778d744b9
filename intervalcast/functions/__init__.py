"""Column expressions: no DataFrame, no Python UDF, nothing learned from data."""

from .encodings import cyclic, decade, log_size
from .sampling import hash_bucket, in_fraction
from .time import (
    calendar_parts,
    interval_index,
    interval_label,
    interval_labels,
    interval_start,
    local_wall_clock,
    seconds_between,
)
from .values import (
    blank_to_null,
    iso_timestamp,
    loose_double,
    loose_int,
    nan_to_null,
    or_unknown,
    parse_row,
    row_json,
    unix_timestamp,
)

__all__ = [
    "blank_to_null",
    "calendar_parts",
    "cyclic",
    "decade",
    "hash_bucket",
    "in_fraction",
    "interval_index",
    "interval_label",
    "interval_labels",
    "interval_start",
    "iso_timestamp",
    "local_wall_clock",
    "log_size",
    "loose_double",
    "loose_int",
    "nan_to_null",
    "or_unknown",
    "parse_row",
    "row_json",
    "seconds_between",
    "unix_timestamp",
]
