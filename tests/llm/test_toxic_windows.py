"""Scores of all windows against a plain pass, word by word; words taken apart."""

import math
import random

import numpy as np
import pytest

from intervalcast.llm import toxicity as t

H = t.HIDDEN


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(3)
    texts = [[b"ba", b"do", b"ki"]] * 3
    net = t._start(texts, rng)
    net.weights = {k: rng.standard_normal(v.shape).astype(np.float32) * 0.4 for k, v in net.weights.items()}
    return net


def sigma(x):
    return 1 / (1 + math.exp(-x))


def plain_states(net, rows, side):
    """One direction over the projected inputs of a span."""
    u = net.weights[f"u{side}"]
    h, out = [0.0] * H, []
    for x in rows:
        y = [sum(h[i] * float(u[i, j]) for i in range(H)) for j in range(3 * H)]
        new = []
        for j in range(H):
            z, r = sigma(x[j] + y[j]), sigma(x[H + j] + y[H + j])
            new.append(z * h[j] + (1 - z) * math.tanh(x[2 * H + j] + r * y[2 * H + j]))
        h = new
        out.append(h)
    return out


def plain_score(net, words):
    w = net.weights
    best = -math.inf
    inputs = {}
    for word in set(words):
        bucket, _ = t.grams([word])
        chars = [float(np.mean(w["chars"][bucket, k])) for k in range(t.CHARS)]
        known = w["words"][net.vocabulary.get(word.strip(t.EDGES), 0)]
        x = np.array([*chars, *known], dtype=np.float64)
        inputs[word] = x @ w["w"].astype(np.float64) + w["b"]
    for first in range(max(len(words) - t.WINDOW, 0) + 1):
        begin = first // t.STARTS * t.STARTS
        span = words[begin : begin + t.SPAN]
        left = plain_states(net, [inputs[x][: 3 * H] for x in span], 0)
        right = plain_states(net, [inputs[x][3 * H :] for x in reversed(span)], 1)[::-1]
        seen = [np.array([*a, *b]) for a, b in zip(left, right)][first - begin : first - begin + t.WINDOW]
        weight = [math.exp(float(s @ w["attend"])) for s in seen]
        pooled = sum(a * s for a, s in zip(weight, seen)) / sum(weight) if seen else np.zeros(2 * H)
        best = max(best, float(pooled @ w["out"]) + float(w["bias"][0]))
    return sigma(best)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64, 65, 66, 100])
def test_scores_equal_a_plain_pass(net, n):
    rnd = random.Random(n)
    words = [rnd.choice(["ba", "do", "ki", "lume", "vexor", "x"]).encode() for _ in range(n)]
    text = b" ".join(words).decode()
    assert net.score([text])[0] == pytest.approx(plain_score(net, words), abs=1e-5)


def test_every_word_starts_a_window(net):
    sides = t._with_shut(np.zeros((2, 300, 3 * H), dtype=np.float32))
    for n in (0, 5, 32, 33, 64, 65, 97, 98, 250):
        spans = t._cut(np.arange(n))
        assert np.isfinite(net.of_windows(sides, spans)).sum() == max(n - t.WINDOW, 0) + 1
        starts = [s[0] + j for s, row in zip(spans, net.of_windows(sides, spans)) for j in np.flatnonzero(np.isfinite(row))]
        assert n < t.WINDOW or starts == list(range(n - t.WINDOW + 1))


def test_passages_of_long_texts_lose_no_window(net):
    rnd = random.Random(1)
    words = [rnd.choice(["ba", "do", "ki", "lume", "vexor"]) for _ in range(400)]
    whole = net.score([" ".join(words)])[0]
    passage, t.PASSAGE = t.PASSAGE, 2 * t.STARTS
    try:
        assert net.score([" ".join(words)])[0] == pytest.approx(whole, abs=1e-6)
    finally:
        t.PASSAGE = passage


def test_long_words_are_taken_apart():
    assert t.pieces_of([b"a", b"b" * t.UNBROKEN]) == [b"a", b"b" * t.UNBROKEN]
    word = bytes(random.Random(2).choices(range(97, 123), k=101))
    pieces = t.pieces_of([b"a", word, b"c"])[1:-1]
    step = t.PART // 2
    assert all(word[i * step :].startswith(p) for i, p in enumerate(pieces))
    # Nothing is lost, and every half piece has a neighbour.
    assert pieces[0] + b"".join(p[step:] for p in pieces[1:]) == word


def test_words_looked_up_once_have_the_same_inputs(net):
    words = [b"ba", b"lume", b"x", b"do", b"vexor!"]
    sample = t._Words.of(net, words)
    bucket, word, counts, ids = sample.take(np.array([4, 1, 1, 2]))
    again = net.parts([words[i] for i in (4, 1, 1, 2)])
    assert all((a == b).all() for a, b in zip((bucket, word, counts, ids), again))


def test_spans_are_scored_in_turn_and_none_is_left_out():
    spans = t._Spans(np.zeros((23, t.SPAN), dtype=np.int64))
    first = spans.chosen()
    assert first.tolist() == list(range(23))
    spans.note(first, np.where(first == 7, 1.0, 0.0))
    seen = []
    for _ in range(t.TURNS):
        at = spans.chosen()
        assert 7 in at and len(at) <= 7
        spans.note(at, np.where(at == 7, 1.0, 0.0))
        seen += at.tolist()
    assert set(seen) == set(range(23))
    short = t._Spans(np.zeros((3, t.SPAN), dtype=np.int64))
    short.note(short.chosen(), np.zeros(3))
    assert short.chosen().tolist() == [0, 1, 2]
