"""Exact top-k by inner product with MaxScore.

The terms of a vector are its dimensions; a shard keeps for each term its postings (the
components of the shard's vectors, zeros adding nothing) and the least and greatest of them.
For a query these give the most a term can add to a score in this shard.  Terms in order of
that bound, as many of the smallest as together stay below the query's k-th best score so
far are non-essential: a vector known by them alone cannot get in.  The postings of the
essential terms are traversed; a vector goes on only while what it has plus the bounds of
the terms not looked at reaches the k-th best score, and these terms are probed for it from
the highest bound down.  A shard whose bounds all together stay below is left out.  Ties
count as reaching, so results are exact; the shards' lists are merged at the end.

Rows are shards of ``SHARD`` vectors; a task carries a query's k-th best score from shard to
shard.  Queries are rows whose id is divisible by ``every``, sent to the tasks in parts of
a fixed size.  See ``vectors`` for which rows take part; an empty table, or a query that is
alone, gives no rows.  Columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .vectors import LEAST, Shape, Stated, blocks_of, filled, packed, passes, per_task, quantised, shape_of

SHARD = 1024  # vectors of a shard: their postings stay in a processor's cache
PROBE = 4  # terms looked at between two comparisons

FOUND = "query_id bigint, vec_id bigint, score bigint"


class Search:
    """The state of a task: for each query of a pass its k best so far.  Counts its work."""

    def __init__(self, stated: Stated, k: int) -> None:
        self.stated, self.k = stated, k
        n = len(stated.ids)
        self.scores: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * n
        self.idents: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * n
        self.floor = np.full(n, LEAST, dtype=np.int64)
        self.traversed = self.probed = self.all = 0

    def see(self, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Search a shard."""
        postings = np.ascontiguousarray(vectors.T)
        queries = self.stated.vectors
        bound = np.maximum(np.maximum(queries * low, queries * high), 0)
        order = np.argsort(bound, axis=1, kind="stable")
        reach = np.cumsum(np.take_along_axis(bound, order, axis=1), axis=1)
        self.all += len(ids) * queries.size
        for i in np.flatnonzero(reach[:, -1] >= self.floor).tolist():
            self._one(i, ids, postings, order[i], reach[i])

    def _one(self, i: int, ids: np.ndarray, postings: np.ndarray, order: np.ndarray, reach: np.ndarray) -> None:
        query, floor = self.stated.vectors[i], self.floor[i]
        split = int(np.searchsorted(reach, floor))  # terms before: non-essential
        essential = order[split:]
        score = query[essential] @ postings[essential]
        self.traversed += len(essential) * len(ids)
        if split:
            alive = np.flatnonzero(score + reach[split - 1] >= floor)
            score = score[alive]
            while split and len(alive):
                split, end = max(split - PROBE, 0), split
                terms = order[split:end]
                score = score + query[terms] @ postings[np.ix_(terms, alive)]
                self.probed += len(terms) * len(alive)
                go_on = score + (reach[split - 1] if split else 0) >= floor
                alive, score = alive[go_on], score[go_on]
            ids = ids[alive]
        others = ids != self.stated.ids[i]
        score = np.concatenate([self.scores[i], score[others].astype(np.int64)])
        ident = np.concatenate([self.idents[i], ids[others]])
        if len(score) > self.k:
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ident = score[score >= least], ident[score >= least]
        best = np.lexsort((ident, -score))[: self.k]
        self.scores[i], self.idents[i] = score[best], ident[best]
        if len(best) == self.k:
            self.floor[i] = self.scores[i][-1]

    def result(self) -> Iterator[pa.RecordBatch]:
        sizes = [len(x) for x in self.scores]
        if sum(sizes):
            columns = [np.repeat(self.stated.ids, sizes), np.concatenate(self.idents), np.concatenate(self.scores)]
            names = [part.split()[0] for part in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _searched(shards: DataFrame, shape: Shape, stated: Stated, k: int) -> DataFrame:
    sent = shards.sparkSession.sparkContext.broadcast(stated)

    def make() -> tuple:
        search = Search(sent.value, k)

        def see(batch: pa.RecordBatch) -> None:
            for block in blocks_of(batch, shape):
                search.see(block.ids, block.vectors, *block.zone)

        return see, search.result

    return shards.mapInArrow(per_task(make), FOUND)


def top_k(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
) -> DataFrame:
    """Per query its first ``k`` other rows: query_id, rank (from 1), vec_id, score."""
    rows = materialise(quantised(df, id_col=id_col, vector_col=vector_col), "vectors")
    shape = shape_of(rows)
    rows = filled(rows, shape)
    shards = materialise(packed(rows, shape, SHARD), "shards")
    parts = [
        _searched(shards, shape, stated, k)
        for stated in passes(rows.filter(F.col("id") % every == 0), shape)
    ]
    if not parts:
        parts = [df.sparkSession.createDataFrame([], FOUND)]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    merged = reduce(DataFrame.unionByName, parts).withColumn("rank", place).filter(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")
