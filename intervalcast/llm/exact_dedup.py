"""Exact duplicates by a tree of merges over sorted digest runs.

Every partition starts as a run of (digest, smallest id) rows.  In each round the runs of a
group of ``FAN`` partitions are exchanged slice by slice of the digest range and merged in
digest order; only the smallest id and the count of a digest survive.  After the last round
one group is left, cut into as many slices as there were runs: no task ever holds more than
its share, and a text that a third of all rows have is one row per run from the start.

Texts are equal when identical after each run of white space became one space; null counts
as empty.  Two 128-bit or longer checks identify a text: its SHA-256, and a second one that
is verified at every merge (its XXH64 and its length).  The smallest id stays; a missing id
comes after all others, and of rows that repeat id and text the one stored first stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, kept_rows, looked_up, materialise, text_or_empty

FAN = 16  # runs merged at once
BITS = 4  # digest bits that tell FAN slices apart

KEYS = ["digest", "check", "n_bytes"]


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def digest_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per document: id, digest, second check, run and row number."""
    rows = (
        docs.select(F.col(id_col).cast("bigint").alias("id"), normalised(text_col).alias("norm"))
        .select(
            "id",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.xxhash64("norm").alias("check"),
            F.octet_length("norm").cast("bigint").alias("n_bytes"),
        )
        .withColumn("row", F.monotonically_increasing_id())
    )
    return materialise(rows.withColumn("run", F.shiftright("row", 33)), "digests")


def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and id to one row per key: first id and row, summed count."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        parts = [batch] if held is None else [held.cast(batch.schema), batch]
        table = pa.Table.from_batches(parts).combine_chunks()
        rows = table.to_batches()[0]
        same = np.ones(rows.num_rows - 1, dtype=bool)
        for name in ("grp", "slice", *KEYS):
            column = rows.column(rows.schema.get_field_index(name))
            a, b = column.slice(0, rows.num_rows - 1), column.slice(1)
            same &= pc.equal(a, b).to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.flatnonzero(~same) + 1])
        n = rows.schema.get_field_index("n")
        sums = np.add.reduceat(rows.column(n).to_numpy(), first)
        merged = rows.take(pa.array(first)).set_column(n, "n", pa.array(sums))
        yield merged.slice(0, merged.num_rows - 1)
        held = merged.slice(merged.num_rows - 1)
    if held is not None:
        yield held


def merged_runs(digests: DataFrame) -> DataFrame:
    """One row per distinct text: keys, id and row that stay, number of rows."""
    runs = (digests.agg(F.max("run")).first()[0] or 0) + 1
    rows = digests.select(*KEYS, "id", "row", F.lit(1).cast("bigint").alias("n"), "run")
    level, left = 0, runs
    while True:
        grp = F.floor(F.col("run") / F.lit(FAN**level)).cast("bigint")
        piece = F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("bigint")
        piece = F.shiftright(piece, 56 - BITS * min(max(level, int(left <= 1)), 13))
        level_rows = rows.select(
            *KEYS, "id", "row", "n", "run", grp.alias("grp"), piece.alias("slice")
        )
        # Level 0 merges within each run, which its readers may have cut; the last level deals
        # the rows anew, so that a digest is in one task there.
        if level or left <= 1:
            level_rows = level_rows.repartition("grp", "slice")
        rows = level_rows.sortWithinPartitions(
            "grp", "slice", *KEYS, F.col("id").asc_nulls_last(), "row"
        ).mapInArrow(merge_sorted, level_rows.schema)
        if left <= 1:
            break
        left = -(-left // FAN)
        level += 1
    kept = rows.select(*KEYS, F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), "n")
    return materialise(kept, "runs")


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, keep_id, group_size, kept, digest (binary).

    An empty table gives no rows.  Columns other than id and text are not read.
    """
    digests = digest_rows(docs, id_col=id_col, text_col=text_col)
    runs = merged_runs(digests)
    found = looked_up(digests.select(*KEYS, "id", "row"), runs, KEYS, "n")
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "digest",
    )


def drop_exact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without exact copies: of equal texts the smallest id stays.

    Rows that repeat both id and text are told apart by their other columns, in order.
    """
    runs = merged_runs(digest_rows(docs, id_col=id_col, text_col=text_col))
    norm = normalised(text_col)
    marks = {
        "digest": F.unhex(F.sha2(norm, 256)),
        "check": F.xxhash64(norm),
        "n_bytes": F.octet_length(norm).cast("bigint"),
        "keep_id": F.col(id_col).cast("bigint"),
    }
    # The id is among the marks, so a hot text is spread over tasks.
    return kept_rows(docs, marks, runs)
