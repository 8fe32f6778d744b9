"""Exact quantiles without sorting the table.

A quantile is found by narrowing: the value range that holds the wanted rank is cut into
equal buckets, the rows of each bucket are counted, and the bucket with the rank becomes
the next range.  Each pass is a scan with a map-side count, and its result has at most
``BUCKETS`` rows per open range, whatever the table holds; a value that owns a third of
the rows is one count.  A pass divides the range by ``BUCKETS``, so a handful is enough.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nan_to_null
from .sketches import rank_error

BUCKETS = 4096
# A range with at most this many rows is listed, not narrowed further.
FEW = 10_000
# Size of the sketch that gives the first brackets.
SKETCH = 8192
_LARGEST = sys.float_info.max


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles; NaN is missing, infinities are the largest numbers."""
    return df.select(*[clamped(name).alias(name) for name in columns])


def clamped(name: str) -> Column:
    value = nan_to_null(F.col(name).cast("double"))
    inside = F.greatest(F.least(value, F.lit(_LARGEST)), F.lit(-_LARGEST))
    return F.when(value.isNotNull(), inside)


def _unclamped(value: float) -> float:
    return value if abs(value) < _LARGEST else math.copysign(math.inf, value)


@dataclass
class _Target:
    """One wanted rank of one column, and the value range known to hold it."""

    column: str
    rank: int
    rows: int
    lo: float
    hi: float
    below: int = 0

    @property
    def open(self) -> bool:
        return self.lo < self.hi

    @property
    def range(self) -> tuple[str, float, float]:
        return self.column, self.lo, self.hi


def _in_ranges(values: DataFrame, ranges: list[tuple[str, float, float]]) -> DataFrame:
    """Rows (range, value) of the values inside one of the ranges.

    The ranges of one column do not overlap, so a value falls into one of them or none.
    """
    columns = sorted({column for column, _, _ in ranges})
    cells = [
        F.struct(F.lit(number).alias("column"), F.col(name).alias("value"))
        for number, name in enumerate(columns)
    ]
    holder = F.lit(None).cast("int")
    for number, (column, lo, hi) in enumerate(ranges):
        inside = (F.col("column") == columns.index(column)) & F.col("value").between(lo, hi)
        holder = F.when(inside, number).otherwise(holder)
    cut = values.select(F.inline(F.array(*cells))).select(holder.alias("range"), "value")
    return cut.filter(F.col("range").isNotNull())


def _narrow(values: DataFrame, targets: list[_Target]) -> None:
    """One pass: shrink the ranges of the targets to the bucket with the rank."""
    ranges = sorted({target.range for target in targets})
    # Halves keep the width of a range finite.
    start = F.get(F.array(*[F.lit(lo / 2) for _, lo, _ in ranges]), F.col("range"))
    width = F.get(F.array(*[F.lit(hi / 2 - lo / 2) for _, lo, hi in ranges]), F.col("range"))
    # Neighbouring numbers may be half a width of 0 apart: their lower one is told off.
    share = F.when(width > 0, (F.col("value") / 2 - start) / width).otherwise(
        (F.col("value") / 2 > start).cast("double")
    )
    bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1).cast("bigint"))
    counted = (
        _in_ranges(values, ranges)
        .groupBy("range", bucket.alias("bucket"))
        .agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    upto = Window.partitionBy("range").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("upto", F.sum("n").over(upto))

    holds = F.lit(False)
    for target in targets:
        left = target.rank - target.below
        holds = holds | (
            (F.col("range") == ranges.index(target.range))
            & (F.col("upto") > left)
            & (F.col("upto") - F.col("n") <= left)
        )
    found = [row.asDict() for row in summed.filter(holds).collect()]
    for target in targets:
        number, left = ranges.index(target.range), target.rank - target.below
        cell = next(
            c for c in found if c["range"] == number and c["upto"] - c["n"] <= left < c["upto"]
        )
        target.below += cell["upto"] - cell["n"]
        target.rows, target.lo, target.hi = cell["n"], cell["lo"], cell["hi"]


def _pick(values: DataFrame, targets: list[_Target]) -> None:
    """The last pass: ranges of few rows are listed and the ranks read off."""
    ranges = sorted({target.range for target in targets})
    listed = (
        _in_ranges(values, ranges)
        .groupBy("range")
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
    )
    places = [
        F.get("values", target.rank - target.below).alias(f"_{number}")
        for number, target in enumerate(targets)
    ]
    rows = {row["range"]: row for row in listed.select("range", *places).collect()}
    for number, target in enumerate(targets):
        value = rows[ranges.index(target.range)][f"_{number}"]
        target.lo = target.hi = value


def around(probabilities: Sequence[float]) -> list[float]:
    """A little below and above each probability, by more than a sketch of SKETCH errs."""
    margin = 3 * rank_error(SKETCH)
    return [q for p in probabilities for q in (max(p - margin, 0.0), min(p + margin, 1.0))]


def _bracketed(values: DataFrame, targets: dict, brackets: dict[str, list[float]]) -> None:
    """One pass: ranges that a sketch gave are taken where they hold the wanted rank.

    A rank among the rows that equal an end is found at once: columns of few values need no
    further pass.
    """
    ends = sorted({(column, end) for column, i in targets for end in brackets[column][2 * i : 2 * i + 2]})
    counts = []
    for number, (column, end) in enumerate(ends):
        counts.append(F.count_if(F.col(column) < end).alias(f"below{number}"))
        counts.append(F.count_if(F.col(column) <= end).alias(f"upto{number}"))
    row = values.agg(*counts).first()
    for (column, i), wanted in targets.items():
        lo, hi = brackets[column][2 * i : 2 * i + 2]
        first, last = ends.index((column, lo)), ends.index((column, hi))
        below, inside = row[f"below{first}"], row[f"upto{last}"] - row[f"below{first}"]
        low, high = (row[f"upto{n}"] - row[f"below{n}"] for n in (first, last))
        for target in wanted:
            place = target.rank - below
            if 0 <= place < low:
                target.lo = target.hi = lo
            elif inside - high <= place < inside:
                target.lo = target.hi = hi
            elif 0 <= place < inside:
                target.lo, target.hi, target.below, target.rows = lo, hi, below, inside


def exact_quantiles(
    values: DataFrame,
    extent: dict[str, tuple[int, float, float]],
    probabilities: Sequence[float],
    brackets: dict[str, list[float]] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column of a ``numbers`` frame.

    ``extent`` holds count, minimum and maximum of each column, ``brackets`` its values at
    ``around(probabilities)`` as a sketch has them.  Every pass reads ``values`` again: hand
    over a table, not the end of a costly plan.
    """
    wanted: dict[tuple[str, int], _Target] = {}
    for column, (count, lo, hi) in extent.items():
        for p in probabilities if count else ():
            first = int(p * (count - 1))
            for rank in {first, min(first + 1, count - 1)}:
                wanted[column, rank] = _Target(column, rank, count, lo, hi)
    if brackets and wanted:
        near: dict[tuple[str, int], list[_Target]] = {}
        for column, (count, _, _) in extent.items():
            for i, p in enumerate(probabilities if count else ()):
                first = int(p * (count - 1))
                ranks = {first, min(first + 1, count - 1)}
                near[column, i] = [wanted[column, rank] for rank in ranks]
        _bracketed(values, near, brackets)

    def still_open() -> list[_Target]:
        return [target for target in wanted.values() if target.open]

    while large := [target for target in still_open() if target.rows > FEW]:
        _narrow(values, large)
    if few := still_open():
        _pick(values, few)

    result: dict[str, list[float | None]] = {}
    for column, (count, _, _) in extent.items():
        result[column] = []
        for p in probabilities:
            if not count:
                result[column].append(None)
                continue
            place = p * (count - 1)
            first = int(place)
            low = wanted[column, first].lo
            high = wanted[column, min(first + 1, count - 1)].lo
            low, high = map(_unclamped, (low, high))
            part = place - first
            result[column].append(low if part == 0 or low == high else low + part * (high - low))
    return result
