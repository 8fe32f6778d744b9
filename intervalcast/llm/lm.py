"""Scores of texts under a log-bilinear language model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end.  The ``TOP`` most frequent training words, classes
of the other words by their last two bytes, and the end are symbols.  The model's logit of a
symbol after another is the product of a vector of the one, a vector of the other, plus a
bias; it is fitted in numpy to the pair counts of the whole training part by full-batch
noise-contrastive estimation, every pair against ``NOISE`` draws from the symbol frequencies in
expectation.  Products of all vectors then give the table of log-probabilities, normalised over
symbols.  A word that shares a class adds its part of the class, count plus one, with one part
for all unseen words; so what is scored is a distribution over words.

All counts are over all training texts.  Words with more than one in ``HEAVY`` of the training
tokens are fewer than ``HEAVY`` and are broadcast with their counts.  The other words' hashes go,
packed, to buckets where they are counted and looked up at once, and their sums go back to
the texts; no task gets more than a bucket's share.  Null counts as empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of, materialise, sorted_groups, words_of

TOP = 1000
CLASSES = 64
HEAVY = 1_000_000
SYMBOLS = TOP + CLASSES + 1
END = TOP + CLASSES
END_WORD = b" "  # no word has a space
PARTS, HELD_OUT = 7, 2
SIZE = 32  # of the vectors
NOISE = 16
STEPS = 250
GATHERED = 400_000  # distinct words a task counts before it passes them on
PIECE = 500  # texts packed together
BUCKET = 50_000  # distinct words to a bucket, on average


def held_out(id_col: str = "doc_id") -> Column:
    return crc_of(id_col) % PARTS == HELD_OUT


def class_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word[-2:], 42) & (CLASSES - 1)


def _class_column(word: str) -> Column:
    """The same in Spark, whose hash is the same one."""
    return F.xxhash64(F.substring(word, -2, 2)).bitwiseAND(F.lit(CLASSES - 1))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = {}

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    for batch in batches:
        for text in batch.column(0).to_pylist():
            for word in words_of(text):
                counts[word] = counts.get(word, 0) + 1
            counts[END_WORD] = counts.get(END_WORD, 0) + 1
            if len(counts) > GATHERED:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


@dataclass
class Lexicon:
    """What tasks need to know of words: heavy ones by place, their symbols and counts."""

    place: dict[bytes, int]
    symbol: np.ndarray
    count: np.ndarray
    tokens: int
    distinct: int
    ends: int  # training texts
    class_size: np.ndarray  # training tokens, distinct words and one unseen, by class


def lexicon(texts: DataFrame) -> Lexicon:
    """Counted over the training texts (columns text, held_out)."""
    train = texts.filter(~F.col("held_out")).select("text")
    words = materialise(
        train.mapInArrow(_counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    tokens, distinct = words.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = tokens or 0, distinct or 0
    ends = words.filter(F.col("word") == F.lit(END_WORD)).agg(F.sum("n")).first()[0] or 0
    words = words.filter(F.col("word") != F.lit(END_WORD))
    top = words.orderBy(F.desc("n"), "word").limit(TOP).collect()
    least = max(tokens // HEAVY, 1)
    # Fewer than HEAVY words have a larger share.
    heavy = words.filter(F.col("n") > least).collect()
    rows = {bytes(r.word): r.n for r in (*top, *heavy)}
    place = {word: i for i, word in enumerate(rows)}
    symbol = np.array([i if i < len(top) else TOP + class_of(w) for i, w in enumerate(rows)], dtype=np.int64)
    count = np.array(list(rows.values()), dtype=np.int64)
    sizes = np.ones(CLASSES)
    by_class = words.groupBy(_class_column("word").alias("c"))
    for row in by_class.agg((F.sum("n") + F.count("*")).alias("size")).collect():
        sizes[row.c] += row["size"]
    for word, i in place.items():
        if i < len(top):
            sizes[class_of(word)] -= rows[word] + 1
    return Lexicon(place, symbol, count, tokens, distinct, ends, sizes)


class Reader:
    """Reads texts as symbols; remembers the classes of endings."""

    def __init__(self, lex: Lexicon):
        self.lex = lex
        self.symbol = np.append(lex.symbol, 0)
        self.endings: dict[bytes, int] = {}

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Places of the words (-1: not heavy), symbols with the end, words that are not heavy."""
        words = words_of(text)
        find = self.lex.place.get
        at = np.fromiter((find(w, -1) for w in words), dtype=np.int64, count=len(words))
        symbols = np.append(self.symbol[at], END)
        rare = np.flatnonzero(at < 0)
        others = [words[i] for i in rare.tolist()]
        if others:
            endings = self.endings
            classes = []
            for w in others:
                tail = w[-2:]
                if tail not in endings:
                    endings[tail] = TOP + class_of(tail)
                classes.append(endings[tail])
            symbols[rare] = classes
        return at, symbols, others


def pair_counts(texts: DataFrame, lex: Lexicon) -> np.ndarray:
    """How often a symbol follows another in the training texts; the end precedes the first."""
    sent = texts.sparkSession.sparkContext.broadcast(lex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        total = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for batch in batches:
            codes = []
            for text in batch.column(0).to_pylist():
                _, symbols, _ = reader.read(text)
                codes.append(np.concatenate([[END], symbols[:-1]]) * SYMBOLS + symbols)
                if len(codes) == PIECE:
                    total += np.bincount(np.concatenate(codes), minlength=len(total))
                    codes = []
            if codes:
                total += np.bincount(np.concatenate(codes), minlength=len(total))
        pairs = np.flatnonzero(total)
        for start in range(0, len(pairs), 50_000):
            part = pairs[start : start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    train = texts.filter(~F.col("held_out")).select("text")
    rows = train.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.zeros(SYMBOLS * SYMBOLS)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[c.to_numpy().astype("<i8").tobytes()] for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.binary()) for c in columns], names=["pairs", "n"])

    # SYMBOLS ** 2 pairs at most; they come as a few rows of bytes, not as a row each.
    for row in rows.select("pair", "n").mapInArrow(packed, "pairs binary, n binary").collect():
        counts[np.frombuffer(row.pairs, "<i8")] = np.frombuffer(row.n, "<i8")
    return counts.reshape(SYMBOLS, SYMBOLS)


def train(counts: np.ndarray, *, seed: int = 3) -> np.ndarray:
    """The table of log10 probabilities of a symbol (column) after another (row)."""
    n = len(counts)
    total = counts.sum()
    rng = np.random.default_rng(seed)
    frequency = ((counts.sum(axis=0) + 1) / (total + n)).astype(np.float32)
    seen = (counts / max(total, 1)).astype(np.float32)
    shown = seen.sum(axis=1, keepdims=True) * frequency * NOISE
    offset = np.log(NOISE * frequency)
    params = {
        "before": (rng.standard_normal((n, SIZE)) * 0.1).astype(np.float32),
        "after": (rng.standard_normal((n, SIZE)) * 0.1).astype(np.float32),
        "bias": np.log(frequency),
    }
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    for step in range(1, STEPS + 1 if total else 1):
        logits = params["before"] @ params["after"].T + params["bias"]
        data = 1 / (1 + np.exp(np.clip(offset - logits, -60, 60)))  # P(data | pair)
        slope = shown * data - seen * (1 - data)
        grad = {
            "before": slope @ params["after"],
            "after": slope.T @ params["before"],
            "bias": slope.sum(axis=0),
        }
        rate = 0.1 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grad.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            params[k] -= (rate * m / (np.sqrt(v) + 1e-10)).astype(np.float32)
    logits = (params["before"] @ params["after"].T + params["bias"]).astype(np.float64)
    most = logits.max(axis=1, keepdims=True)
    logits -= most + np.log(np.exp(logits - most).sum(axis=1, keepdims=True))
    return logits / math.log(10)


ENTRY = np.dtype([("word", "<u8"), ("text", "<u2")])  # the text's top bit: it is for training
SUMS = np.dtype([("text", "<u2"), ("logs", "<f8"), ("known", "<i8")])
FIXED = np.dtype(
    [("id", "<i8"), ("null", "?"), ("held", "?"), ("n", "<i8"), ("known", "<i8"), ("base", "<f8"), ("model", "<f8")]
)
TRAINING = 1 << 15
PACKED = "route bigint, key bigint, kind int, blob binary"


def _packed(lex: Lexicon, table: np.ndarray, buckets: int, batches: Iterator[pa.RecordBatch]):
    """Texts in pieces: what is known of them at once, and their other words by bucket."""
    reader = Reader(lex)
    logs = np.log10(lex.count + 1.0)
    # A word that is alone in its symbol has all of it.
    share = np.where(lex.symbol < TOP, 0.0, logs - np.log10(lex.class_size[np.maximum(lex.symbol - TOP, 0)]))
    unit = np.concatenate([np.zeros(TOP), np.log10(lex.class_size), [0.0]])
    unit_log = math.log10(lex.tokens + lex.distinct + 1)
    key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE):
            part = batch.slice(start, PIECE)
            fixed = np.zeros(part.num_rows, dtype=FIXED)
            entries = []
            ids, held, texts = (part.column(i).to_pylist() for i in range(3))
            for i, text in enumerate(texts):
                at, symbols, others = reader.read(text)
                heavy = at[at >= 0]
                model = table[np.concatenate([[END], symbols[:-1]]), symbols].sum() + share[heavy].sum()
                rare = symbols[:-1][at < 0]
                model -= unit[rare].sum()
                base = logs[heavy].sum() + math.log10(lex.ends + 1) - len(symbols) * unit_log
                known = len(heavy) + (lex.ends > 0)
                fixed[i] = (ids[i] or 0, ids[i] is None, held[i], len(symbols), known, base, model)
                if others:
                    entry = np.empty(len(others), dtype=ENTRY)
                    entry["word"] = [xxhash.xxh64_intdigest(w) for w in others]
                    entry["text"] = i if held[i] else i | TRAINING
                    entries.append(entry)
            routes, kinds, blobs = [buckets + key % buckets], [0], [fixed.tobytes()]
            if entries:
                entry = np.concatenate(entries)
                bucket = (entry["word"] >> np.uint64(11)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[order])) + 1
                for piece in np.split(order, cut):
                    routes.append(int(bucket[piece[0]]))
                    kinds.append(1)
                    blobs.append(entry[piece].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(routes, pa.int64()),
                    pa.array([key] * len(routes), pa.int64()),
                    pa.array(kinds, pa.int32()),
                    pa.array(blobs, pa.binary()),
                ],
                names=["route", "key", "kind", "blob"],
            )
            key += 1


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of words to sums over the words of each text."""
    for _, rows in sorted_groups("route", batches):
        out = [row for row in rows if row[1] == 0]
        packed = [np.frombuffer(blob, dtype=ENTRY) for _, kind, blob in rows if kind == 1]
        if packed:
            keys = [key for key, kind, _ in rows if kind == 1]
            entry = np.concatenate(packed)
            _, which = np.unique(entry["word"], return_inverse=True)
            counts = np.bincount(which, weights=(entry["text"] & TRAINING) > 0)[which]
            owner = np.repeat(np.arange(len(packed)), list(map(len, packed)))
            text = entry["text"] & (TRAINING - 1)
            slot = owner * TRAINING + text
            slots, which = np.unique(slot, return_inverse=True)
            sums = np.empty(len(slots), dtype=SUMS)
            sums["text"] = slots % TRAINING
            sums["logs"] = np.bincount(which, weights=np.log10(counts + 1))
            sums["known"] = np.bincount(which, weights=counts > 0)
            cut = np.searchsorted(slots // TRAINING, np.arange(1, len(keys)))
            out += [(k, 1, s.tobytes()) for k, s in zip(keys, np.split(sums, cut), strict=True)]
        key, kind, blob = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
            names=["key", "kind", "blob"],
        )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of texts to rows."""
    for _, rows in sorted_groups("key", batches):
        fixed = np.frombuffer(next(blob for _, kind, blob in rows if kind == 0), dtype=FIXED)
        logs, known = np.zeros(len(fixed)), np.zeros(len(fixed), dtype=np.int64)
        for _, kind, blob in rows:
            if kind == 1:
                sums = np.frombuffer(blob, dtype=SUMS)
                logs[sums["text"]] += sums["logs"]
                known[sums["text"]] += sums["known"]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(fixed["id"], mask=fixed["null"]),
                pa.array(fixed["held"]),
                pa.array(fixed["n"]),
                pa.array(fixed["known"] + known),
                pa.array(fixed["base"] + logs),
                pa.array(fixed["model"] + logs),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


RESULT = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def scored(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    held = held_out(id_col)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        held.alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    lex = lexicon(texts)
    table = train(pair_counts(texts, lex))
    buckets = max(8, lex.distinct // BUCKET)
    sent = texts.sparkSession.sparkContext.broadcast((lex, table))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(*sent.value, buckets, batches)

    by_word = texts.mapInArrow(pack, PACKED).repartition("route").sortWithinPartitions("route")
    sums = by_word.mapInArrow(_summed, "key bigint, kind int, blob binary")
    by_text = sums.repartition("key").sortWithinPartitions("key")
    rows = by_text.mapInArrow(_unpacked, RESULT)
    return rows.withColumn("train_tokens", F.lit(lex.tokens).cast("bigint")).withColumnRenamed("id", id_col)
