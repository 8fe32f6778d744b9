"""Hard negatives from blocks of vectors in Hilbert order, chosen by zone maps.

Rows are put in the order of a Hilbert curve through all dimensions and stored as Parquet in
blocks of ``BLOCK``, with the least and greatest component of each dimension of a block (its
zone map) and its labels.  Neighbouring ranges of the curve lie on one shelf, a folder.  By
interval arithmetic a zone map bounds the scores an anchor can have with any row of the
block.  These bounds choose, from the zone maps alone, the shelves that are read, and again
inside a task the blocks whose vectors are decoded for an anchor:

* positives, the anchor's first rows of its own label: blocks with that label whose upper
  bound reaches the last of the best so far, which starts from the anchor's own block;
* negatives, for each positive the first rows of other labels whose score lies within
  ``low`` to ``high`` hundredths of the positive's: blocks with another label whose bounds
  meet the window, above the last of the best so far.

Bounds are inclusive and ties go to smaller ids, so results are exact.  See ``vectors`` for
which rows take part.  An anchor without positives, or a positive without rows in its
window (that of a negative score is empty), gives no rows; neither does an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .vectors import (
    LEAST,
    Best,
    Block,
    Shape,
    blocks_of,
    filled,
    matrix,
    packed,
    passes,
    per_task,
    quantised,
    shape_of,
)

BLOCK = 512
SHELF = 64 * BLOCK  # rows of a shelf, at most about
BITS = 4  # bits of a dimension that the curve follows
SLICE = 512  # anchors compared with a block at once

RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Rows of bits: the places of cells (rows of numbers of ``bits`` bits) on the curve.

    From the top bit down the frame is turned for the cell that was entered: dimensions are
    swapped with the first one, or the first one is mirrored; what remains is a Gray code.
    """
    x = cells.T.astype(np.uint32)
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            mirror = (x[i] & bit) > 0
            swap = np.where(mirror, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] ^= np.where(mirror, below, swap).astype(np.uint32)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        odd = (x[-1] >> np.uint32(level)) & 1
        turned ^= odd * np.uint32((1 << level) - 1)
    x ^= turned
    levels = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return ((x.T[:, None, :] >> levels[None, :, None]) & 1).astype(np.uint8).reshape(-1, bits * dims)


def with_key(rows: DataFrame, shape: Shape) -> DataFrame:
    """The rows with ``key``, bytes in the order of the curve."""
    span = float(shape.high) - float(shape.low) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(batch.schema.get_field_index("v")), shape.dims)
            at = ((v - float(shape.low)) / span * (1 << BITS)).astype(np.int64)
            keys = np.packbits(hilbert_keys(np.clip(at, 0, (1 << BITS) - 1), BITS), axis=1)
            width = keys.shape[1]
            data = pa.array([k.tobytes() for k in keys] if width else [b""] * len(v), type=pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, data], names=[*batch.schema.names, "key"])

    return rows.mapInArrow(run, "id bigint, label bigint, v array<bigint>, key binary")


def in_blocks(rows: DataFrame, shape: Shape, block: int = BLOCK) -> DataFrame:
    """The stored blocks, a folder per shelf."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism * 2
    shelves = max(1, min(-(-shape.rows // block), max(tasks, -(-shape.rows // SHELF))))
    laid = with_key(rows, shape).repartitionByRange(shelves, "key", "id").sortWithinPartitions("key", "id")
    return materialise(packed(laid, shape, block), "blocks", partition_by=["shelf"])


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score each vector can have with a row inside the zone."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ low + down @ high, up @ high + down @ low


@dataclass(frozen=True)
class Windows:
    """What the anchors of a pass look for: scores from ``low`` to ``high``, one label or others.

    Rows are anchors, columns the windows of one.  ``floor`` is known to be reached by as
    many rows as are looked for.
    """

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray
    same: bool
    k: int

    def wanted(self, block: Block, floor: np.ndarray) -> np.ndarray:
        """Which anchors must read a block, from its zone map."""
        least, greatest = bounds(self.vectors, *block.zone)
        labels = block.row["label_low"], block.row["label_high"]
        from_, to = np.maximum(self.low, floor), self.high
        meets = ((greatest[:, None] >= from_) & (least[:, None] <= to) & (from_ <= to)).any(axis=1)
        if self.same:
            return meets & (labels[0] <= self.labels) & (self.labels <= labels[1])
        return meets & ((labels[0] != labels[1]) | (self.labels != labels[0]))


class Reader:
    """The state of a task: the best of each window so far.  Counts the blocks read."""

    def __init__(self, windows: Windows) -> None:
        self.windows = windows
        n = len(windows.ids)
        self.width = windows.low.shape[1]
        self.slices = [slice(a, min(a + SLICE, n)) for a in range(0, n, SLICE)]
        self.best = [Best((s.stop - s.start) * self.width, windows.k) for s in self.slices]
        self.read = self.all = 0

    def see(self, block: Block) -> None:
        w = self.windows
        labels = block.labels
        vectors, ids = None, block.ids
        floor = np.concatenate([b.floor.reshape(-1, self.width) for b in self.best])
        floor = np.maximum(floor, w.floor)
        chosen = w.wanted(block, floor)
        self.all += len(chosen)
        self.read += int(chosen.sum())
        for part, best in zip(self.slices, self.best, strict=True):
            at = np.flatnonzero(chosen[part])
            if not len(at):
                continue
            if vectors is None:
                vectors = block.vectors
            whole = at + part.start
            score = w.vectors[whole] @ vectors.T
            fits = (labels == w.labels[whole, None]) if w.same else (labels != w.labels[whole, None])
            fits &= ids != w.ids[whole, None]
            for j in range(self.width):
                from_ = np.maximum(floor[whole, j], w.low[whole, j])[:, None]
                row, column = np.nonzero(fits & (score >= from_) & (score <= w.high[whole, j, None]))
                best.add(at[row] * self.width + j, score[row, column], ids[column])

    def result(self) -> Iterator[pa.RecordBatch]:
        for part, best in zip(self.slices, self.best, strict=True):
            if len(best.group):
                anchor = self.windows.ids[part][best.group // self.width]
                columns = [anchor, (best.group % self.width).astype(np.int32), best.ident, best.score]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["anchor", "place", "id", "score"]
                )


def chosen_shelves(blocks: DataFrame, shape: Shape, windows: Windows) -> list[int]:
    """The shelves with a block that some anchor must read.  Only zone maps are read."""
    sent = blocks.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = set()
        for batch in batches:
            for block in blocks_of(batch, shape):
                if sent.value.wanted(block, sent.value.floor).any():
                    found.add(block.row["shelf"])
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), type=pa.int32())], names=["shelf"])

    zones = blocks.select("shelf", "label_low", "label_high", "low", "high")
    return [row.shelf for row in zones.mapInArrow(run, "shelf int").distinct().collect()]


def _read(blocks: DataFrame, shape: Shape, windows: Windows) -> DataFrame:
    """The first k of each window: anchor, place (of the window), id, score."""
    shelves = chosen_shelves(blocks, shape, windows)
    sent = blocks.sparkSession.sparkContext.broadcast(windows)

    def make() -> tuple:
        reader = Reader(sent.value)

        def see(batch: pa.RecordBatch) -> None:
            for block in blocks_of(batch, shape):
                reader.see(block)

        return see, reader.result

    found = blocks.filter(F.col("shelf").isin(shelves)).mapInArrow(
        per_task(make), "anchor bigint, place int, id bigint, score bigint"
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= windows.k)


def own_floors(blocks: DataFrame, shape: Shape, every: int, k: int) -> DataFrame:
    """Anchors (id, floor): the k-th best score of the own label in the anchor's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks_of(batch, shape):
                ids, labels = block.ids, block.labels
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                vectors, found = block.vectors, np.full(len(at), LEAST, dtype=np.int64)
                for j, i in enumerate(at.tolist()):
                    score = vectors[(labels == labels[i]) & (ids != ids[i])] @ vectors[i]
                    if len(score) >= k:
                        found[j] = np.partition(score, len(score) - k)[len(score) - k]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(found)], names=["id", "floor"])

    return blocks.mapInArrow(run, "id bigint, floor bigint")


def hard_negatives(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block: int = BLOCK,
) -> DataFrame:
    """Rows of ``RESULT``: for each anchor (id divisible by ``every``) and positive its negatives."""
    spark = df.sparkSession
    rows = quantised(df, id_col=id_col, vector_col=vector_col, label_col=label_col)
    rows = materialise(rows, "vectors")
    shape = shape_of(rows)
    rows = filled(rows, shape)
    blocks = in_blocks(rows, shape, block)
    floors = materialise(own_floors(blocks, shape, every, positives), "floors")
    parts = []
    for stated in passes(rows.filter(F.col("id") % every == 0), shape):
        n = len(stated.ids)
        place = {number: i for i, number in enumerate(stated.ids.tolist())}
        # Two jobs of a pass: what comes to the driver is a few numbers for each of its anchors.
        ids = spark.createDataFrame([(i,) for i in place], "id bigint")
        floor = np.full((n, 1), LEAST, dtype=np.int64)
        for row in floors.join(ids, "id").collect():
            floor[place[row.id], 0] = row.floor
        whole = np.iinfo(np.int64)
        same = Windows(
            stated.ids, stated.labels, stated.vectors,
            np.full((n, 1), whole.min), np.full((n, 1), whole.max), floor, True, positives,
        )
        first = materialise(_read(blocks, shape, same), "positives")
        from_ = np.ones((n, positives), dtype=np.int64)
        to = np.zeros((n, positives), dtype=np.int64)
        for row in first.collect():
            i, j = place[row.anchor], row.rank - 1
            from_[i, j], to[i, j] = -(-low * row.score // 100), high * row.score // 100
        other = Windows(
            stated.ids, stated.labels, stated.vectors,
            from_, to, np.full((n, positives), LEAST, dtype=np.int64), False, negatives,
        )
        found = _read(blocks, shape, other)
        named = first.select(
            "anchor",
            (F.col("rank") - 1).alias("place"),
            F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        parts.append(found.join(named, ["anchor", "place"]))
    if not parts:
        return spark.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, parts).select(
        F.col("anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
