"""SimHash near-duplicates found with pivot distance tables.

Fingerprint: 64 bits over the XXH64 (seed 42) of a text's word shingles, repeats included; a
bit is 1 if more than half of the hashes have it.  A text of fewer words than a shingle is
one shingle, a text without words has fingerprint zero.  Fingerprints link at ``RADIUS`` or
fewer differing bits, and components of links are groups.

Equal fingerprints are one node.  Two nodes within 3 bits agree on at least three of six
blocks of bits, so nodes meet in the buckets of the 20 choices of three blocks.  A bucket
with many nodes is dealt again by the 20 choices of three of six blocks of its other bits;
after that at most 16 bits are free, which bounds it.  Within a bucket a table has every
node's Hamming distances to ``PIVOTS`` reference fingerprints.  Distances to a pivot differ
by no more than two nodes do, so rows sorted by the first distance are compared only with
those up to 3 above; pairs with any coordinate more than 3 apart are discarded, and the
survivors are verified on their bits.  A bucket gives the links of its own components, never
all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, kept_rows, looked_up, materialise, text_or_empty, words_of
from .components import components

SEED = 42
WORDS = 3  # words in a shingle
RADIUS = 3
BLOCKS = 6
PIVOTS = 16
LARGE = 4096  # nodes in a bucket before it is dealt again

REFERENCE = np.random.default_rng(64).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def shingle_hashes(words: list[bytes], size: int = WORDS) -> list[int]:
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[size - 1 :].tolist(), strict=True)
    return [digest(joined[a:b], SEED) for a, b in spans]


def fingerprint_of(text: str | None, size: int = WORDS) -> int:
    """The fingerprint as a signed 64-bit integer."""
    return bits_of(shingle_hashes(words_of(text), size))


def bits_of(hashes: list[int]) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit integer."""
    if not hashes:
        return 0
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, *, text_col: str = "text", size: int = WORDS) -> DataFrame:
    """The rows with ``fp``, a bigint that holds the 64 bits."""

    def compute(texts: list[str | None]) -> list:
        return [[fingerprint_of(text, size) for text in texts]]

    return appended(docs, [T.StructField("fp", T.LongType())], text_col, compute)


def _masks(bits: int) -> list[int]:
    """For the set bits of ``bits``: masks of the choices of three of six blocks of them."""
    places = [i for i in range(64) if bits >> i & 1]
    blocks = [sum(1 << i for i in part.tolist()) for part in np.array_split(places, BLOCKS)]
    return [sum(choice) for choice in combinations(blocks, BLOCKS - RADIUS)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _dealt(nodes: DataFrame, masks: list[int], name: str) -> DataFrame:
    """A row per node and mask: the number of the mask, and the node's bits under it."""
    keys = [F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(x))).alias("v")) for i, x in enumerate(masks)]
    rows = nodes.withColumn("k", F.explode(F.array(*keys)))
    return rows.select(*nodes.columns, F.col("k.m").alias(f"{name}m"), F.col("k.v").alias(f"{name}v"))


def _dealt_again(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Rows of large buckets by the bits outside their first mask."""
    second: Column | None = None
    for i, mask in enumerate(masks):
        choices = [
            F.struct(F.lit(j).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(x))).alias("v"))
            for j, x in enumerate(_masks(~mask & (2**64 - 1)))
        ]
        case = F.col("am") == i
        second = F.when(case, F.array(*choices)) if second is None else second.when(case, F.array(*choices))
    rows = rows.withColumn("k", F.explode(second))
    return rows.select("fp", "am", "av", F.col("k.m").alias("bm"), F.col("k.v").alias("bv"))


def linked(bits: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each row the row that stands for its component of links within its group.

    Rows are sorted by group, and within it by distance to the first reference.
    """
    n = len(bits)
    table = np.bitwise_count(bits[:, None] ^ REFERENCE).astype(np.int8)
    parent = np.arange(n)
    root = parent.copy()
    near = np.arange(n)
    step = 1
    while len(near):
        near = near[near + step < n]
        other = near + step
        # Sorted by the first coordinate: beyond the radius, and from there on, none is near.
        close = (group[near] == group[other]) & (table[other, 0] - table[near, 0] <= radius)
        near, other = near[close], other[close]
        a, b = near, other
        for pivot in range(1, PIVOTS):
            close = np.abs(table[a, pivot] - table[b, pivot]) <= radius
            a, b = a[close], b[close]
        close = np.bitwise_count(bits[a] ^ bits[b]) <= radius
        a, b = a[close], b[close]
        apart = root[a] != root[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
        if apart.any():
            root = parent
            while (root[root] != root).any():
                root = root[root]
            parent = root.copy()
        step += 1
    return root


def _links(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in (*batches, None):
            if batch is not None and batch.num_rows == 0:
                continue
            parts = [] if held is None else [held]
            parts += [] if batch is None else [pa.Table.from_batches([batch])]
            if not parts:
                return
            rows = pa.concat_tables(parts).combine_chunks()
            columns = [rows.column(k).to_numpy() for k in keys]
            new = np.zeros(rows.num_rows, dtype=bool)
            for column in columns:
                new[1:] |= column[1:] != column[:-1]
            # The last bucket may go on in the next batch.
            end = rows.num_rows if batch is None else int(np.flatnonzero(new)[-1]) if new.any() else 0
            held = rows.slice(end)
            if end:
                bits = rows.column("fp").to_numpy()[:end]
                root = linked(bits.view(np.uint64), np.cumsum(new[:end]))
                apart = root != np.arange(end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bits[apart]), pa.array(bits[root[apart]])], names=["a", "b"]
                )

    return run


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes (column ``fp``, distinct) within the radius."""
    masks = _masks(2**64 - 1)
    first = _dealt(nodes.select("fp"), masks, "a")
    sizes = materialise(first.groupBy("am", "av").count().filter(F.col("count") > 1), "buckets")
    large = sizes.filter(F.col("count") > LARGE).select("am", "av")
    small = sizes.filter(F.col("count") <= LARGE).select("am", "av")
    found = _searched(first.join(small, ["am", "av"]), ["am", "av"])
    if large.isEmpty():
        return found
    again = _dealt_again(first.join(large, ["am", "av"]), masks)
    return found.unionByName(_searched(again, ["am", "av", "bm", "bv"]))


def _searched(rows: DataFrame, keys: list[str]) -> DataFrame:
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(int(REFERENCE[0])))))
    dealt = rows.select(*keys, "fp", first.alias("d")).repartition(*keys)
    return dealt.sortWithinPartitions(*keys, "d", "fp").mapInArrow(_links(keys), "a bigint, b bigint")


def _grouped(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, root, n) per fingerprint, from stored rows of id, fp and text mark."""
    nodes = materialise(stored.groupBy("fp").agg(F.count("*").alias("n")), "nodes")
    roots = components(materialise(links(nodes), "links")).withColumnRenamed("node", "fp")
    met = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "n")
    return nodes, materialise(met, "groups")


def _stored(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    return materialise(fingerprints(rows).drop("text"), "fingerprints")


def _winners(stored: DataFrame, groups: DataFrame) -> DataFrame:
    """Per root the smallest id (missing ones last) with the mark of its text."""
    best = F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("best")
    by_node = stored.groupBy("fp").agg(best)
    return by_node.join(groups, "fp").groupBy("root").agg(F.min("best").alias("best"))


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, fp (bigint), component_id (smallest id reachable).

    Null counts as an empty text.  A component of missing ids only has a null component_id.
    """
    stored = _stored(docs, id_col, text_col)
    _, groups = _grouped(stored)
    named = groups.join(_winners(stored, groups), "root").select("fp", F.col("best.id").alias("component_id"), "n")
    found = looked_up(stored.select("id", "fp"), materialise(named, "named"), ["fp"], "n")
    return found.select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one document of each group: that of the smallest id."""
    stored = _stored(docs, id_col, text_col)
    _, groups = _grouped(stored)
    winners = _winners(stored, groups).select(F.col("best.id").alias("id"), F.col("best.mark").alias("mark"))
    marks = {"id": F.col(id_col).cast("bigint"), "mark": F.xxhash64(text_or_empty(text_col))}
    return kept_rows(docs, marks, winners)
