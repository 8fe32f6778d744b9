"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Words enter as a learned word vector and as the mean of learned vectors of their character
n-grams, so forms never seen are scored by their parts.  A word of more than ``UNBROKEN`` bytes,
such as a text without blanks, is taken apart into overlapping pieces.  The network runs both
ways over spans of ``SPAN`` words; attention pools its states over every window of ``WINDOW``
words, one starting at each word, and each window lies whole in a span.  A text's score is that
of its highest window.  A text of fewer words is one window, one without words an empty window.

Fitting is multiple-instance: of each labelled text windows are scored, one is drawn in favour
of high scores (later the highest), and the network learns from it.  All windows are scored when
a text is met first, later those of the highest span and of a quarter of the spans, in turn (of
``FEWEST``, if that is more), so long texts cost less and no window is left out.  One text in
``JOINED``, of those up to ``SHORT`` bytes, is half the time read without its blanks.  It uses at most ``SAMPLE`` labelled texts of each kind,
those with the smallest hash of their id among the rows that are not held out, and of these only
such up to ``LONGEST`` characters; all texts are scored whole.  An id labelled both ways counts
as both.  Without labels of both kinds every text scores 0.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, crc_of, fresh, words_of

SAMPLE = 1500  # labelled texts of each kind, at most
LONGEST = 100_000  # characters of a text in the sample, at most
HELD_OUT = 5
WINDOW = 32  # words; a power of two
SPAN = 2 * WINDOW
STARTS = SPAN - WINDOW + 1  # windows of a span
UNBROKEN, PART = 48, 12  # bytes of a word that is taken apart from there, and of its pieces
JOINED, SHORT = 3, 4096
HIDDEN = 8
CHARS, WORDS = 12, 8  # sizes of the two word inputs
BUCKETS = 2**14  # of character n-grams
VOCABULARY = 4000
GRAMS = (3, 4, 5)
ROUNDS, STEPS = 10, 600  # rounds over the sample and steps of learning, at least
TOGETHER = 48  # texts of a step
FEWEST, TURNS = 4, 4  # spans of a text scored anew in a step, at least; steps until all are
CACHE = 200_000  # words a worker remembers; more start it anew
SHUT = 30.0

EDGES = bytes(set(range(33, 127)) - set(b"0123456789abcdefghijklmnopqrstuvwxyz"))


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of ``^word$``, and the word each belongs to."""
    data = np.frombuffer(b"".join(b"^" + (w.strip(EDGES) or w) + b"$" for w in words), dtype=np.uint8)
    sizes = np.array([len(w.strip(EDGES) or w) + 2 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    codes = data.astype(np.uint64) + np.uint64(1)
    buckets, owners = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = np.zeros(m, dtype=np.uint64)
        for i in range(n):
            code = code * np.uint64(0x100000001B3) + codes[i : i + m]
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        inside = owner[:m] == owner[n - 1 :]
        buckets.append((code >> np.uint64(50))[inside].astype(np.int64))
        owners.append(owner[:m][inside])
    bucket, own = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return bucket[order], own[order]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _summed(rows: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by place."""
    out = np.zeros((size, rows.shape[1]), dtype=rows.dtype)
    if len(places):
        # Numbers of two bytes are sorted in far less time.
        order = np.argsort(places.astype(np.uint16) if size <= 2**16 else places, kind="stable")
        at = places[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def pieces_of(words: list[bytes]) -> list[bytes]:
    """The words, those that are very long as pieces that overlap by half."""
    if all(len(w) <= UNBROKEN for w in words):
        return words
    out: list[bytes] = []
    for w in words:
        if len(w) <= UNBROKEN:
            out.append(w)
        else:
            out += [w[i : i + PART] for i in range(0, len(w) - PART // 2, PART // 2)]
    return out


def _over_windows(x: np.ndarray) -> np.ndarray:
    """Sums over all windows along the first axis."""
    width = 1
    while width < WINDOW:
        x = x[:-width] + x[width:]
        width *= 2
    return x


@dataclass
class Network:
    """The parameters, and what they compute.  Word 0 of the vocabulary is any other word."""

    vocabulary: dict[bytes, int]
    weights: dict[str, np.ndarray]
    known: dict[bytes, int] = field(default_factory=dict, repr=False)
    sides: np.ndarray | None = field(default=None, repr=False)

    def parts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of n-grams, the word of each, how many a word has, and places in the vocabulary."""
        bucket, owner = grams(words)
        # Every word has an n-gram: with both edges it has three characters or more.
        counts = np.bincount(owner, minlength=len(words))
        ids = np.array([self.vocabulary.get(x.strip(EDGES), 0) for x in words], dtype=np.int64)
        return bucket, owner, counts, ids

    def inputs(self, bucket: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Both inputs of words from their parts, buckets in the order of words."""
        starts = np.concatenate([[0], np.cumsum(counts[:-1])])
        chars = np.add.reduceat(self.weights["chars"][bucket], starts, axis=0)
        chars /= counts[:, None].astype(np.float32)
        return np.hstack([chars, self.weights["words"][ids]])

    def states(self, sides: np.ndarray, at: np.ndarray, learn: bool) -> tuple[np.ndarray, dict]:
        """States of both directions by place (place, row, 2 * HIDDEN).

        ``at`` holds rows of the projected inputs of both sides, -1 for no word; ``learn`` keeps
        what the backward pass needs.
        """
        n, length = at.shape
        u = np.stack([self.weights["u0"], self.weights["u1"]])
        table = sides.reshape(-1, 3 * HIDDEN)
        turned = np.where(at.T < 0, sides.shape[1] - 1, at.T)
        places = np.stack([turned, turned[::-1] + sides.shape[1]], axis=1)
        states = np.zeros((length + 1, 2, n, HIDDEN), dtype=sides.dtype)
        gates = []
        for step in range(length):
            h = states[step]
            x = table[places[step]]
            y = h @ u
            zr = sigmoid(x[:, :, : 2 * HIDDEN] + y[:, :, : 2 * HIDDEN])
            z, r = zr[:, :, :HIDDEN], zr[:, :, HIDDEN:]
            c = np.tanh(x[:, :, 2 * HIDDEN :] + r * y[:, :, 2 * HIDDEN :])
            if learn:
                gates.append((z, r, c, y[:, :, 2 * HIDDEN :]))
            states[step + 1] = c + z * (h - c)
        both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=2)
        return both, {"at": at, "states": states, "gates": gates, "both": both}

    def forward(
        self, sides: np.ndarray, at: np.ndarray, inside: np.ndarray | None = None
    ) -> tuple[np.ndarray, dict]:
        """Logits of one window a row: the places ``inside``, or all."""
        w = self.weights
        both, kept = self.states(sides, at, learn=True)
        seen = (at >= 0 if inside is None else inside & (at >= 0)).T
        e = np.where(seen, both @ w["attend"], -1e9)
        a = np.exp(e - e.max(axis=0)) * seen
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", a, both)
        return pooled @ w["out"] + w["bias"][0], kept | {"a": a, "pooled": pooled}

    def of_windows(self, sides: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logits of all windows of spans (span, start); -inf where a text has no window."""
        w = self.weights
        both, _ = self.states(sides, at, learn=False)
        seen = at.T >= 0
        e = np.where(seen, both @ w["attend"], -1e9).astype(np.float64)
        a = np.exp(e - e.max(axis=0)) * seen
        logits = _over_windows(a * (both @ w["out"])) / np.maximum(_over_windows(a), 1e-300) + w["bias"][0]
        real = seen[WINDOW - 1 :].copy()
        real[0] = True
        return np.where(real, logits, -np.inf).T

    def backward(self, d: np.ndarray, kept: dict, size: int) -> tuple[dict, np.ndarray]:
        """Gradients of the recurrent part, and of the table of projected inputs."""
        w = self.weights
        a, both, states, at = kept["a"], kept["both"], kept["states"], kept["at"]
        grad = {"out": kept["pooled"].T @ d, "bias": np.array([d.sum()], dtype=np.float32)}
        dp = d[:, None] * w["out"]
        da = (both * dp).sum(axis=2)
        de = a * (da - (a * da).sum(axis=0))
        dboth = a[:, :, None] * dp + de[:, :, None] * w["attend"]
        grad["attend"] = np.einsum("tn,tnh->h", de, both)
        # By step, as the states: forwards on one side, backwards on the other.
        dstep = np.stack([dboth[:, :, :HIDDEN], dboth[::-1, :, HIDDEN:]], axis=1)
        back = np.stack([w["u0"].T, w["u1"].T])
        du = np.zeros((2, HIDDEN, 3 * HIDDEN), dtype=states.dtype)
        dh = np.zeros((2, len(at), HIDDEN), dtype=states.dtype)
        rows = np.empty((at.shape[1], 2, len(at), 3 * HIDDEN), dtype=states.dtype)
        for step in reversed(range(at.shape[1])):
            z, r, c, yc = kept["gates"][step]
            h = states[step]
            dh = dh + dstep[step]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * yc * r * (1 - r)
            rows[step] = np.concatenate([dz, dr, dc], axis=2)
            dy = np.concatenate([dz, dr, dc * r], axis=2)
            du += h.transpose(0, 2, 1) @ dy
            dh = dh * z + dy @ back
        grad["u0"], grad["u1"] = du
        places = np.stack([at.T, at.T[::-1]], axis=1)
        real = places >= 0
        places = places + np.array([0, size])[None, :, None]
        table = _summed(rows[real], places[real], 2 * size).reshape(2, size, 3 * HIDDEN)
        return grad, np.hstack([table[0], table[1]])

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Inputs through the input weights, by side."""
        rows = (x @ self.weights["w"] + self.weights["b"]).astype(np.float32)
        return np.ascontiguousarray(rows.reshape(len(x), 2, 3 * HIDDEN).transpose(1, 0, 2))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1 for each text: that of its highest window."""
        best = np.full(len(texts), -np.inf)
        at: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        waiting = 0
        for i, text in enumerate(texts):
            words = pieces_of(words_of(text))
            # Passages share words, so no window is lost between them.
            for start in range(0, max(len(words) - WINDOW + 1, 1), PASSAGE):
                part = words[start : start + PASSAGE + WINDOW - 1]
                new = [w for w in dict.fromkeys(part) if w not in self.known]
                if self.sides is None or len(self.known) + len(new) > CACHE:
                    self._highest(best, at, owner)
                    at, owner, waiting = [], [], 0
                    self.known = {}
                    self.sides = _with_shut(np.zeros((2, CACHE, 3 * HIDDEN), dtype=np.float32))
                    new = list(dict.fromkeys(part))
                if new:
                    first = len(self.known)
                    self.known.update(zip(new, range(first, first + len(new)), strict=True))
                    self.sides[:, first : first + len(new)] = self.projected(self._read(new))
                rows = np.array([self.known[w] for w in part], dtype=np.int64)
                at.append(_cut(rows))
                owner.append(np.full(len(at[-1]), i))
                waiting += len(at[-1])
                if waiting >= BATCH:
                    self._highest(best, at, owner)
                    at, owner, waiting = [], [], 0
        self._highest(best, at, owner)
        return sigmoid(np.clip(best, -30, 30))

    def _read(self, words: list[bytes]) -> np.ndarray:
        bucket, _, counts, ids = self.parts(words)
        return self.inputs(bucket, counts, ids)

    def _highest(self, best: np.ndarray, at: list, owner: list) -> None:
        if at:
            logits = self.of_windows(self.sides, np.concatenate(at)).max(axis=1)
            np.maximum.at(best, np.concatenate(owner), logits)


def _with_shut(sides: np.ndarray) -> np.ndarray:
    """With a last row, for no word, that leaves the state as it is."""
    shut = np.zeros((2, 1, 3 * HIDDEN), dtype=np.float32)
    shut[:, :, :HIDDEN] = SHUT
    return np.concatenate([sides, shut], axis=1)


BATCH = 2048  # spans scored at once
PASSAGE = 500 * STARTS  # words of a text looked up at once


def _cut(rows: np.ndarray) -> np.ndarray:
    """Rows of words as spans, -1 behind the end of the text."""
    spans = max(len(rows) - WINDOW, 0) // STARTS + 1
    padded = np.full((spans - 1) * STARTS + SPAN, -1, dtype=np.int64)
    padded[: len(rows)] = rows
    return np.lib.stride_tricks.sliding_window_view(padded, SPAN)[::STARTS]


def _start(texts: list[list[bytes]], rng: np.random.Generator) -> Network:
    counts: dict[bytes, int] = {}
    for words in texts:
        for w in {w.strip(EDGES) for w in words}:
            counts[w] = counts.get(w, 0) + 1
    often = sorted((w for w, c in counts.items() if c > 2 and w), key=lambda w: (-counts[w], w))
    vocabulary = {w: i for i, w in enumerate(often[:VOCABULARY], 1)}

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    weights = {
        "chars": normal(BUCKETS, CHARS, scale=0.3),
        "words": normal(len(vocabulary) + 1, WORDS, scale=0.1),
        "w": normal(CHARS + WORDS, 6 * HIDDEN, scale=0.4),
        "b": np.zeros(6 * HIDDEN, dtype=np.float32),
        "u0": normal(HIDDEN, 3 * HIDDEN, scale=0.2),
        "u1": normal(HIDDEN, 3 * HIDDEN, scale=0.2),
        "attend": normal(2 * HIDDEN, scale=0.2),
        "out": normal(2 * HIDDEN, scale=0.3),
        "bias": np.array([-1.0], dtype=np.float32),
    }
    return Network(vocabulary, weights)


@dataclass
class _Spans:
    """The spans of a text, and the highest score of each when it was last scored."""

    rows: np.ndarray
    best: np.ndarray | None = None
    turn: int = 0

    def chosen(self) -> np.ndarray:
        """All spans at first, then the highest and some in turn."""
        n = len(self.rows)
        some = max(FEWEST, -(-n // TURNS))
        if self.best is None or n <= some:
            return np.arange(n)
        at = np.append((self.turn + np.arange(some)) % n, self.best.argmax())
        self.turn = (self.turn + some) % n
        return np.unique(at)

    def note(self, at: np.ndarray, scores: np.ndarray) -> None:
        if self.best is None:
            self.best = np.empty(len(self.rows))
        self.best[at] = scores


@dataclass
class _Words:
    """The parts of all words of a sample, one word after another."""

    bucket: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, net: Network, words: list[bytes]) -> _Words:
        buckets, counts, ids = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 50_000):
            bucket, _, count, place = net.parts(words[at : at + 50_000])
            buckets.append(bucket.astype(np.uint16))
            counts.append(count)
            ids.append(place)
        sizes = np.concatenate(counts)
        return cls(np.concatenate(buckets), sizes, np.concatenate(ids), np.cumsum(sizes) - sizes)

    def take(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of these words, the word of each (by place), counts, places in the vocabulary."""
        counts = self.counts[words]
        word = np.repeat(np.arange(len(words)), counts)
        shift = self.starts[words] - (np.cumsum(counts) - counts)
        return self.bucket[np.arange(len(word)) + shift[word]].astype(np.int64), word, counts, self.ids[words]


def train(texts: list[str], toxic: np.ndarray, *, seed: int = 9, rate: float = 0.01) -> Network:
    """A network fitted to labelled texts; an empty text counts as one that is not toxic."""
    rng = np.random.default_rng(seed)
    read = [words_of(t) for t in (*texts, "")]
    split = [pieces_of(words) for words in read]
    y = np.append(np.asarray(toxic, dtype=np.float32), np.float32(0))
    net = _start(split, rng)
    index: dict[bytes, int] = {}

    def places(words: list[bytes]) -> np.ndarray:
        return np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)

    whole = [_Spans(_cut(places(words))) for words in split]
    joined = {
        i: _Spans(_cut(places(pieces_of([b"".join(words)]))))
        for i, words in enumerate(read)
        if i % JOINED == 0 and 0 < sum(map(len, words)) <= SHORT
    }
    sample = _Words.of(net, list(index))
    del read, split, index
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step = 0
    # Both kinds equally often.
    kinds = [np.flatnonzero(y == k) for k in (0, 1)]
    most = max(len(k) for k in kinds)
    rounds = max(ROUNDS, -(-STEPS * TOGETHER // (2 * most)))
    for turn in range(rounds):
        last = turn >= 0.7 * rounds
        order = rng.permutation(np.concatenate([np.resize(rng.permutation(k), most) for k in kinds]))
        for part in np.array_split(order, -(-len(order) // TOGETHER)):
            read = [joined[i] if i in joined and rng.integers(2) else whole[i] for i in part]
            chosen = [spans.chosen() for spans in read]
            at = np.concatenate([spans.rows[c] for spans, c in zip(read, chosen, strict=True)])
            real = at >= 0
            used, rows = np.unique(at[real], return_inverse=True)
            if not len(used):
                continue
            at[real] = rows
            ends = np.cumsum([len(c) for c in chosen])
            own = np.repeat(np.arange(len(part)), [len(c) * STARTS for c in chosen])
            bucket, word, counts, ids = sample.take(used)
            x = net.inputs(bucket, counts, ids)
            sides = _with_shut(net.projected(x))
            logits = net.of_windows(sides, at)
            for spans, c, top in zip(read, chosen, np.split(logits.max(axis=1), ends[:-1]), strict=True):
                spans.note(c, top)
            logits = logits.reshape(-1)
            # One window a text: drawn in favour of high scores, more and more strictly.
            drawn = logits * (1 + 10 * turn / rounds) + rng.gumbel(size=len(logits)) * (not last)
            ranked = np.lexsort((-drawn, own))
            window = ranked[np.concatenate([[0], np.flatnonzero(np.diff(own[ranked])) + 1])]
            start = (window % STARTS)[:, None]
            inside = (np.arange(SPAN) >= start) & (np.arange(SPAN) < start + WINDOW)
            logits, kept = net.forward(sides, at[window // STARTS], inside)
            d = ((sigmoid(logits) - y[part]) / len(part)).astype(np.float32)
            grad, dtable = net.backward(d, kept, len(used))
            grad["w"], grad["b"] = x.T @ dtable, dtable.sum(axis=0)
            dx = dtable @ net.weights["w"].T
            use = (np.abs(dx).max(axis=1) > 0)[word]
            grad["chars"] = _summed((dx[:, :CHARS] / counts[:, None].astype(np.float32))[word[use]], bucket[use], BUCKETS)
            grad["words"] = _summed(dx[:, CHARS:], ids, len(net.vocabulary) + 1)
            step += 1
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
                net.weights[k] -= (rate * (0.3 if last else 1) * m / (np.sqrt(v) + 1e-6)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Network | None:
    """The network learned from the labelled documents (``toxic`` 1 or 0) not held out."""
    known = labels.filter(F.col("toxic").isin(0, 1) & (crc_of(id_col) % HELD_OUT != 0))
    known = known.select(F.col(id_col).cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.distinct()
    order = [F.xxhash64("id"), "id"]
    ranked = [known.filter(F.col("toxic") == k).orderBy(*order).limit(SAMPLE * 2) for k in (0, 1)]
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter(F.length("text") <= LONGEST)
    # At most 4 * SAMPLE rows of two numbers are broadcast.
    met = texts.join(F.broadcast(ranked[0].unionByName(ranked[1])), "id")
    rows = []
    for k in (0, 1):
        rows += met.filter(F.col("toxic") == k).orderBy(*order, "text").limit(SAMPLE).collect()
    toxic = np.array([r.toxic for r in rows])
    if not 0 < toxic.sum() < len(toxic):
        return None
    return train([r.text for r in rows], toxic)


def scored(
    docs: DataFrame,
    net: Network | None,
    *,
    text_col: str = "text",
    score: str = "score",
    predicted: str = "predicted",
) -> DataFrame:
    """The rows with a score and a prediction (1 from 0.5), under the given names."""
    if net is None:
        rows = docs.withColumn(score, F.lit(0.0))
    else:
        sent = docs.sparkSession.sparkContext.broadcast((net.vocabulary, net.weights))
        held: dict[str, Network] = {}

        def compute(texts: list[str | None]) -> list:
            if "net" not in held:
                held["net"] = Network(*sent.value)
            return [held["net"].score(texts)]

        rows = appended(docs, [T.StructField(score, T.DoubleType())], text_col, compute)
    return rows.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, net: Network | None, *, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    names = {"score": fresh(docs, "__score"), "predicted": fresh(docs, "__predicted")}
    rows = scored(docs, net, text_col=text_col, **names)
    return rows.filter(F.col(names["predicted"]) == 0).select(*docs.columns)
