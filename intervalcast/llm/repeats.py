"""Removal of passages that occur elsewhere, by bucket-pointer refinement of sampled suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the
same text or another; strings are judged on the input.  Texts are UTF-8 bytes, null is empty.

Suffixes start in buckets: the identifier of the ``GRAM`` bytes they begin with, a rolling
64-bit hash at every offset.  Longer strings are told apart by identifiers at later offsets,
never by reading their bytes again: a string of ``LENGTH`` bytes has the pair of identifiers
at its start and ``STEP`` bytes on.

1.  Of the bucket identifiers in a window (the offsets at which a gram fits into a string of
    ``LENGTH`` bytes) the smallest is its anchor.  Equal windows have equal anchors at equal
    offsets, and neighbouring windows mostly share theirs, so a text gives a row for about
    every hundred bytes: the run of windows of one anchor.  Runs whose anchor's bucket has no
    other member are done.
2.  The others are refined by what the whole run covers (identifiers at its first start, a step
    on, and at its last).  Members of a refined bucket are repeats as a whole.
3.  A bucket that falls into several refined ones keeps one member of each for the last step:
    their windows are refined to single windows, and those found twice are repeats.

All steps group and join by identifiers; a passage that a third of all texts share is counted
in parts first.  Identifiers of runs and windows have 128 bits or more.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import looked_up, materialise, maybe_in, sorted_groups, text_or_empty

LENGTH = 400
GRAM = 201
STEP = LENGTH - GRAM  # of the second identifier of a string
WIDTH = STEP + 1  # offsets in a window
PIECE = 1 << 22  # windows handled at once; bounds memory, changes no result

BYTES = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
PLACE = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=32)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; n is a power of two."""
    out = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def bucket_ids(data: np.ndarray) -> np.ndarray:
    """The identifier of the GRAM bytes at every offset."""
    size = 1 << max(12, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTES[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])


def anchors(ids: np.ndarray) -> np.ndarray:
    """For every window the offset of its smallest identifier, the first of equal ones."""
    n = len(ids) - WIDTH + 1
    keys = (ids & ~PLACE) | np.arange(len(ids), dtype=np.uint64)
    full = -(-len(keys) // WIDTH) * WIDTH
    blocks = np.full(full, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, WIDTH)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[WIDTH - 1 : WIDTH - 1 + n]) & PLACE).astype(np.int64)


def runs(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows that share an anchor: first and last start, bucket, refined bucket."""
    for begin in range(0, len(data) - LENGTH + 1, PIECE):
        ids = bucket_ids(data[begin : begin + PIECE + LENGTH - 1])
        at = anchors(ids)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        last = np.append(first[1:] - 1, len(at) - 1)
        place = at[first]
        cover = ids[first]
        for more in (ids[first + STEP], ids[last + STEP], (place - first).astype(np.uint64), (last - first).astype(np.uint64)):
            cover = mixed(cover * np.uint64(BASE) + more)
        yield first + begin, last + begin, ids[place].view(np.int64), cover.view(np.int64)


RUN = "id bigint, mark bigint, first bigint, last bigint, bucket bigint, refined bigint"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint8)
            for columns in runs(data):
                n = len(columns[0])
                where = pa.array(np.full(n, i))
                arrays = [ids.take(where), marks.take(where), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "mark", "first", "last", "bucket", "refined"])


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


ENTRY = np.dtype([("a", "<u8"), ("b", "<u4"), ("number", "<u4")])
TEXTS = 200  # texts whose windows are packed together
BUCKET = 500_000  # windows to a bucket, on average
PACKED = "route bigint, key bigint, kind int, blob binary"


def _packed(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the listed runs: per piece of texts each different one once, by bucket.

    A row of kind 0 keeps what the piece's windows are, and which of them are equal.
    """
    key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            ids, marks, texts, listed = (batch.column(i).slice(at, TEXTS) for i in range(4))
            spans, first_ids, second_ids = [], [], []
            for i in range(len(ids)):
                data = np.frombuffer(texts[i].as_buffer(), dtype=np.uint8)
                for run in listed[i].as_py():
                    for begin in range(run["first"], run["last"] + 1, PIECE):
                        end = min(run["last"] + 1, begin + PIECE)
                        found = bucket_ids(data[begin : end + LENGTH - 1])
                        spans.append((i, begin, end))
                        first_ids.append(found[: end - begin])
                        second_ids.append(found[STEP : STEP + end - begin])
            a = np.concatenate(first_ids)
            b = (np.concatenate(second_ids) >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((b, a))
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            number = np.empty(len(a), dtype=np.uint32)
            number[order] = np.cumsum(new) - 1
            one = order[new]
            entry = np.empty(len(one), dtype=ENTRY)
            entry["a"], entry["b"], entry["number"] = a[one], b[one], np.arange(len(one))
            kept = (ids.to_pylist(), marks.to_pylist(), np.array(spans, dtype=np.int64), number)
            routes, kinds, blobs = [buckets + key % buckets], [0], [pickle.dumps(kept)]
            bucket = (entry["a"] >> np.uint64(7)) % np.uint64(buckets)
            by_bucket = np.argsort(bucket, kind="stable")
            for part in np.split(by_bucket, np.flatnonzero(np.diff(bucket[by_bucket])) + 1):
                routes.append(int(bucket[part[0]]))
                kinds.append(1)
                blobs.append(entry[part].tobytes())
            arrays = [
                pa.array(routes, pa.int64()),
                pa.array([key] * len(routes), pa.int64()),
                pa.array(kinds, pa.int32()),
                pa.array(blobs, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["route", "key", "kind", "blob"])
            key += 1


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of windows to the numbers of those that another piece has, by piece."""
    for _, rows in sorted_groups("route", batches):
        out = [row for row in rows if row[1] == 0]
        packed = [(key, np.frombuffer(blob, dtype=ENTRY)) for key, kind, blob in rows if kind == 1]
        if packed:
            entry = np.concatenate([x for _, x in packed])
            order = np.lexsort((entry["b"], entry["a"]))
            a, b = entry["a"][order], entry["b"][order]
            same = np.zeros(len(entry), dtype=bool)
            equal = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            same[order[1:]] |= equal
            same[order[:-1]] |= equal
            at = 0
            for key, x in packed:
                numbers = x["number"][same[at : at + len(x)]]
                at += len(x)
                if len(numbers):
                    out.append((key, 1, numbers.tobytes()))
        if out:
            key, kind, blob = zip(*out, strict=True)
            arrays = [pa.array(key, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "kind", "blob"])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that occur twice, in a piece or in several."""
    for _, rows in sorted_groups("key", batches):
        ids, marks, spans, number = pickle.loads(next(b for _, kind, b in rows if kind == 0))
        twice = np.bincount(number) > 1
        for _, kind, blob in rows:
            if kind == 1:
                twice[np.frombuffer(blob, dtype="<u4")] = True
        out, at = [], 0
        for i, begin, end in spans.tolist():
            hit = np.flatnonzero(np.diff(np.concatenate([[0], twice[number[at : at + end - begin]], [0]])))
            at += end - begin
            out += [(ids[i], marks[i], begin + x, begin + y - 1 + LENGTH) for x, y in hit.reshape(-1, 2).tolist()]
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "mark", "start", "end"])


def _same_row(left: str = "l", right: str = "r"):
    return F.col(f"{left}.id").eqNullSafe(F.col(f"{right}.id")) & (F.col(f"{left}.mark") == F.col(f"{right}.mark"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows are told apart by id and text; rows that repeat both are repeats of each other."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("data"))


def repeated(texts: DataFrame) -> DataFrame:
    """(id, mark, spans): starts and ends of repeated strings per text that has any."""
    long = texts.filter(F.octet_length("data") >= LENGTH)
    all_runs = materialise(long.mapInArrow(lambda b: _gathered(_runs(b)), RUN), "runs")
    shared = all_runs.groupBy("bucket").count().filter(F.col("count") > 1).select("bucket")
    shared = materialise(shared, "buckets")
    met = materialise(maybe_in(all_runs, shared, "bucket").join(shared, "bucket"), "shared")

    one = F.min(F.struct("id", "mark", "first", "last")).alias("one")
    refined = materialise(met.groupBy("bucket", "refined").agg(F.count("*").alias("n"), one), "refined")
    whole = refined.filter(F.col("n") > 1).select("bucket", "refined", "n")
    found = looked_up(met, whole, ["bucket", "refined"], "n").select(
        "id", "mark", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end")
    )

    split = refined.groupBy("bucket").count().filter(F.col("count") > 1).select("bucket")
    left = refined.join(split, "bucket").select("one.*")
    left = left.groupBy("id", "mark").agg(
        F.collect_list(F.struct("first", "last")).alias("runs"),
        F.sum(F.col("last") - F.col("first") + 1).alias("windows"),
    )
    left = materialise(left, "listed")
    buckets = max(8, (left.agg(F.sum("windows")).first()[0] or 0) // BUCKET)
    # A row that repeats id and text adds nothing: its runs are whole repeats already.
    some = maybe_in(long, left, "mark").alias("l")
    near = some.join(left.alias("r"), _same_row()).select("l.id", "l.mark", "data", "runs")
    by_bucket = near.mapInArrow(lambda b: _packed(buckets, b), PACKED).repartition("route")
    twice = by_bucket.sortWithinPartitions("route").mapInArrow(_twice, "key bigint, kind int, blob binary")
    by_piece = twice.repartition("key").sortWithinPartitions("key")
    last = by_piece.mapInArrow(_found, "id bigint, mark bigint, start bigint, end bigint")
    spans = F.collect_list(F.struct("start", "end")).alias("spans")
    return found.unionByName(last).groupBy("id", "mark").agg(spans)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    for batch in batches:
        kept, removed, counts = [], [], []
        for i in range(batch.num_rows):
            data = batch.column(1)[i].as_py()
            spans = sorted((s["start"], s["end"]) for s in batch.column(2)[i].as_py() or ())
            parts, at, n = [], 0, 0
            joined: list[list[int]] = []
            for start, end in spans:
                if joined and start <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([start, end])
            for start, end in joined:
                parts.append(data[at:start])
                at = end
                n += end - start
            parts.append(data[at:])
            kept.append(b"".join(parts))
            removed.append(n)
            counts.append(len(joined))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64())],
            names=["id", "kept", "n_removed", "n_spans"],
        )


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, kept (bytes that stay), n_removed, n_spans (maximal removed runs)."""
    texts = _keyed(docs, id_col, text_col)
    spans = materialise(repeated(texts), "spans")
    # Texts without a span need not be shuffled.
    some = maybe_in(texts, spans, "mark")
    marked = some.alias("l").join(spans.alias("r"), _same_row(), "left").select("l.id", "data", "spans")
    rows = marked.mapInArrow(_cut, "id bigint, kept binary, n_removed bigint, n_spans bigint")
    none = F.lit(0).cast("bigint")
    others = maybe_in(texts, spans, "mark", inverse=True).select(
        "id", F.col("data").alias("kept"), none.alias("n_removed"), none.alias("n_spans")
    )
    return rows.unionByName(others).withColumnRenamed("id", id_col)
