"""Feature encodings of one value each."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def cyclic(position: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of the given length."""
    angle = position * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def log_size(size: Column) -> Column:
    """log(1 + size); null at -1 and below."""
    return F.log1p(size)


def decade(year: Column) -> Column:
    """First year of the decade, towards zero for negative years."""
    return (year - year % 10).cast("int")
