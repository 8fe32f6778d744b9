"""What the searches over vectors share: integer vectors, packed blocks, best lists.

Vectors become integers, ``floor(scale * x)``, and scores are inner products of these, so
that results do not depend on the order of sums.  Rows take part that have an id, a vector,
no null and no non-finite component, and (where labels are used) a label.  Shorter vectors
count as filled up with zeros.  Of rows that repeat an id, the one with the smallest label
and vector takes part.  Scores are 64-bit: components must stay below 2 ** 28 or so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = np.iinfo(np.int64).min

# Bytes of queries that are sent to all tasks at once; more queries take more passes.
PASS_BYTES = 16_000_000

PACKED = (
    "shelf int, n int, label_low bigint, label_high bigint, "
    "ids binary, labels binary, vectors binary, low binary, high binary"
)


def quantised(
    df: DataFrame,
    *,
    id_col: str,
    vector_col: str,
    label_col: str | None = None,
    scale: float = 256.0,
) -> DataFrame:
    """The rows that take part as (id, label, v); all of label 0 where labels are not used."""
    x = F.col(vector_col).cast("array<double>")
    number = F.col(id_col).cast("bigint")
    label = F.lit(0).cast("bigint") if label_col is None else F.col(label_col).cast("bigint")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c))
    rows = df.filter(number.isNotNull() & label.isNotNull() & finite).select(
        number.alias("id"), label.alias("label"), whole.alias("v")
    )
    first = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("first"))
    return first.select("id", "first.label", "first.v")


@dataclass(frozen=True)
class Shape:
    rows: int
    dims: int
    low: int
    high: int

    @property
    def stored(self) -> str:
        """Type of stored components: the smallest that holds all."""
        for kind in ("<i2", "<i4"):
            if np.iinfo(kind).min <= self.low and self.high <= np.iinfo(kind).max:
                return kind
        return "<i8"

    @property
    def exact(self) -> type:
        """Type in which inner products come out exact."""
        most = max(abs(self.low), abs(self.high))
        return np.float64 if self.dims * most * most < 2**53 else np.int64


def shape_of(rows: DataFrame) -> Shape:
    n, dims, low, high = rows.agg(
        F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))
    ).first()
    return Shape(n, max(dims or 0, 1), min(low or 0, 0), max(high or 0, 0))


def filled(rows: DataFrame, shape: Shape) -> DataFrame:
    """All vectors of the same length."""
    rest = F.array_repeat(F.lit(0).cast("bigint"), F.lit(shape.dims) - F.size("v"))
    return rows.withColumn("v", F.concat("v", rest))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def packed(rows: DataFrame, shape: Shape, size: int) -> DataFrame:
    """Rows (id, label, v), in the order they have, as one row for each ``size`` of them.

    ``low`` and ``high`` are the least and greatest component of each dimension, with those
    of the labels the zone map of the block.  ``shelf`` is the number of the partition.
    """
    dims, kind = shape.dims, shape.stored

    def block(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> tuple:
        zone = (vectors.min(axis=0), vectors.max(axis=0))
        arrays = (ids.astype("<i8"), labels.astype("<i8"), vectors.astype(kind))
        data = (a.tobytes() for a in (*arrays, *(z.astype(kind) for z in zone)))
        return (len(ids), int(labels.min()), int(labels.max()), *data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = TaskContext.get().partitionId()
        held: list[np.ndarray] = []

        def sent(blocks: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*blocks, strict=True))
            kinds = [pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 5
            arrays = [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]
            shelves = pa.array([shelf] * len(blocks), type=pa.int32())
            return pa.RecordBatch.from_arrays([shelves, *arrays], names=names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            at = batch.schema.get_field_index
            parts = [
                batch.column(at("id")).to_numpy(),
                batch.column(at("label")).to_numpy(),
                matrix(batch.column(at("v")), dims),
            ]
            if held:
                parts = [np.concatenate(pair) for pair in zip(held, parts, strict=True)]
            whole = len(parts[0]) // size * size
            for start in range(0, whole, size):
                yield sent([block(*(p[start : start + size] for p in parts))])
            held = [p[whole:] for p in parts]
        if held and len(held[0]):
            yield sent([block(*held)])

    names = [part.split()[0] for part in PACKED.split(", ")]
    return rows.select("id", "label", "v").mapInArrow(run, PACKED)


@dataclass(frozen=True)
class Block:
    """A packed row; its vectors are decoded when they are asked for."""

    row: dict
    shape: Shape

    @property
    def ids(self) -> np.ndarray:
        return np.frombuffer(self.row["ids"], "<i8")

    @property
    def labels(self) -> np.ndarray:
        return np.frombuffer(self.row["labels"], "<i8")

    @property
    def zone(self) -> tuple[np.ndarray, np.ndarray]:
        low, high = (np.frombuffer(self.row[k], self.shape.stored) for k in ("low", "high"))
        return low.astype(self.shape.exact), high.astype(self.shape.exact)

    @property
    def vectors(self) -> np.ndarray:
        flat = np.frombuffer(self.row["vectors"], self.shape.stored)
        return flat.reshape(-1, self.shape.dims).astype(self.shape.exact)


def blocks_of(batch: pa.RecordBatch, shape: Shape) -> Iterator[Block]:
    for i in range(batch.num_rows):
        yield Block({name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}, shape)


@dataclass(frozen=True)
class Stated:
    """A bounded part of the stated queries, as every task gets it."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def passes(queries: DataFrame, shape: Shape) -> Iterator[Stated]:
    """The stated queries (id, label, v) in parts of about ``PASS_BYTES``, by hash of their id.

    A pass reads all candidates once; how many passes there are grows with the queries, what
    a pass holds does not.
    """
    n = -(-queries.count() * shape.dims * 8 // PASS_BYTES)
    part = F.pmod(F.xxhash64("id"), F.lit(max(n, 1)))
    for i in range(n):
        rows = packed(queries.filter(part == i), shape, 4096).collect()
        found = [Block(row.asDict(), shape) for row in rows]
        if found:
            yield Stated(
                np.concatenate([b.ids for b in found]),
                np.concatenate([b.labels for b in found]),
                np.concatenate([b.vectors for b in found]),
            )


class Best:
    """For each group its first ``k`` candidates: scores from the top, ties by smaller id."""

    def __init__(self, groups: int, k: int) -> None:
        self.k = k
        # Score of the last of k; below it no candidate gets in.
        self.floor = np.full(groups, LEAST, dtype=np.int64)
        self.group, self.score, self.ident = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(group):
            return
        new = (group, score.astype(np.int64), ident)
        held = (self.group, self.score, self.ident)
        group, score, ident = (np.concatenate(pair) for pair in zip(held, new, strict=True))
        order = np.lexsort((ident, -score, group))
        group, score, ident = group[order], score[order], ident[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[first, len(group)])
        place = np.arange(len(group)) - np.repeat(first, sizes)
        kept = place < self.k
        self.group, self.score, self.ident = group[kept], score[kept], ident[kept]
        last = place == self.k - 1
        self.floor[group[last]] = score[last]


def per_task(make: Callable[[], tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator]:
    """A task body from (see a block, give the result): nothing is given before the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        see, result = make()
        for batch in batches:
            see(batch)
        yield from result()

    return run
