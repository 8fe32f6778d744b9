"""Searches over vectors and the audit of sources, against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from __spark_entry__ import oracle_sql, queries
from intervalcast.llm import divergence, hard_negatives, maxscore, vectors

TABLES = "/root/testdata/sf0.001"
COLUMNS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_source_divergence", "op13_maxscore"])
def test_equal_to_sql(spark, name):
    con = check.connect(TABLES)
    assert check.differences(queries()[name](spark, TABLES), con, oracle_sql()[name]) == []


def awkward_vectors(n=260, dims=5):
    """Ties, copies, hot label, short and empty vectors, nulls, numbers that are none."""
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        v = [rnd.choice([-1.0, -0.5, 0.0, 0.25, 0.3, 1.0, rnd.gauss(0, 1)]) for _ in range(dims)]
        rows.append((i, v, 0 if i % 3 == 0 else rnd.randrange(4)))
    same = [0.5] * dims
    rows += [(n + i, same, i % 4) for i in range(60)]
    rows += [(1000, [0.7], 1), (1001, [], 2), (1100, same, 3), (1101, None, 1), (1102, [1.0, None], 1)]
    rows += [(1103, [math.nan], 1), (1200, [math.inf], 1), (1104, [-math.inf, 0.0], 2), (1105, same, None)]
    rows += [rows[4], (7, same, 2), (None, same, 1), (100, [9.0] * dims, 3)]
    return rows


def taking_part(rows, labelled):
    """id -> (label, integers), of repeated ids the smallest."""
    found = {}
    for i, v, label in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if labelled and label is None:
            continue
        row = (label if labelled else 0, [math.floor(256 * x) for x in v])
        found[i] = min(found.get(i, row), row)
    return found


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.fixture(scope="module")
def table(spark):
    rows = awkward_vectors()
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    return rows, df.withColumns({c: F.lit(c) for c in ("id", "v", "score", "shelf", "key", "rank", "anchor")})


@pytest.mark.parametrize("pass_bytes", [vectors.PASS_BYTES, 200])
def test_top_k(table, monkeypatch, pass_bytes):
    monkeypatch.setattr(vectors, "PASS_BYTES", pass_bytes)
    rows, df = table
    part = taking_part(rows, False)
    expected = []
    for q in part:
        if q % 20 == 0:
            scores = sorted((-inner(part[q][1], v), i) for i, (_, v) in part.items() if i != q)[:5]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    found = maxscore.top_k(df, every=20)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize(("block", "pass_bytes"), [(512, vectors.PASS_BYTES), (7, 100)])
def test_hard_negatives(table, monkeypatch, block, pass_bytes):
    monkeypatch.setattr(vectors, "PASS_BYTES", pass_bytes)
    rows, df = table
    part = taking_part(rows, True)
    expected = []
    for a, (label, v) in part.items():
        if a % 20:
            continue
        scores = sorted((-inner(v, x), i) for i, (_, x) in part.items() if i != a)
        for p, b in [(-s, i) for s, i in scores if part[i][0] == label][:5]:
            fit = [(-s, i) for s, i in scores if part[i][0] != label and 30 * p <= -100 * s <= 90 * p]
            expected += [(a, b, n + 1, i, p, s) for n, (s, i) in enumerate(fit[:10])]
    found = hard_negatives.hard_negatives(df, every=20, block=block)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_empty_tables_of_vectors(spark):
    for rows in ([], [(3, [1.0], 1)], [(100, [1.0], 1)], [(100, None, 1)], [(100, [], 0), (200, [], 1)]):
        df = spark.createDataFrame(rows, COLUMNS)
        found = maxscore.top_k(df).collect()
        assert [(r.query_id, r.vec_id, r.score) for r in found] == (
            [(100, 200, 0), (200, 100, 0)] if len(rows) == 2 else []
        )
        assert hard_negatives.hard_negatives(df).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 3.0], 0), (1, [1e6, 1.0], 0), (2, [1e6, 1.0 + 2**-8], 1), (3, [-1e6, 0.0], 1)]
    found = maxscore.top_k(spark.createDataFrame(rows, COLUMNS), k=3).collect()
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    assert [(r.vec_id, r.score) for r in found] == [(i, inner(whole[0], whole[i])) for i in (2, 1, 3)]


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = np.packbits(hard_negatives.hilbert_keys(cells, bits), axis=1)
    order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
    assert len({keys[i].tobytes() for i in order}) == len(cells)
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_spare_work():
    """Bunched vectors: bounds are never passed, and most of the work falls away."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 200, (8, 16))
    data = np.floor(centres[np.arange(4096) // 512] + rng.normal(0, 20, (4096, 16)))
    blocks = data.reshape(-1, 256, 16)
    queries = data[::64]
    stated = vectors.Stated(np.arange(len(queries)) * 64, np.zeros(len(queries)), queries)
    search = maxscore.Search(stated, 5)
    for n, block in enumerate(blocks):
        low, high = block.min(axis=0), block.max(axis=0)
        least, greatest = hard_negatives.bounds(queries, low, high)
        scores = queries @ block.T
        assert (least <= scores.min(axis=1)).all() and (scores.max(axis=1) <= greatest).all()
        search.see(np.arange(n * 256, n * 256 + 256), block, low, high)
    assert search.traversed + search.probed < 0.6 * search.all
    scores = queries @ data.T
    for i, number in enumerate(stated.ids):
        order = [j for j in np.lexsort((np.arange(4096), -scores[i])) if j != number][:5]
        assert search.idents[i].tolist() == order


def plain_divergence(rows, least_docs, top):
    terms = lambda text: "".join(
        c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or c > "\x7f" else " " for c in text or ""
    ).split(" ")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        key = (lang or "", source or "")
        groups.add(key)
        found = [t for t in terms(text) if t]
        counts[key].update(found)
        docs[key[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        whole = shares(sum((counts[g] for g in groups if g[0] == lang), Counter()))
        p = {g[1]: shares(counts[g]) for g in groups if g[0] == lang}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for source in p:
            pairs = [(-sum(f(p[source][t], p[o][t]) for t in kept), o.encode(), o) for o in p if o != source]
            out += [(lang, source, "pair", o, -v, n + 1) for n, (v, _, o) in enumerate(sorted(pairs))]
            own = [
                (-f(p[source][t], whole[t]), t.encode(), t)
                for t in kept
                if counts[lang, source][t] and p[source][t] > whole[t]
            ]
            out += [(lang, source, "term", t, -v, n + 1) for n, (v, _, t) in enumerate(sorted(own)[:top])]
    return sorted(out)


def source_rows():
    rnd = random.Random(12)
    words = [f"{a}{b}" for a in "abcdefghijklm" for b in ("x", "Yy", "é", "漢", "")]
    rows = []
    for i in range(240):
        size = rnd.choice([0, 1, 5, 40, 200])
        text = rnd.choice([" ", "\n", "-7"]).join(rnd.choice(words[i % 7 :]) for _ in range(size))
        rows.append((text, rnd.choice(["en", "de", None]), rnd.choice(["s0", "s0", "s1", "s2", None])))
    rows += [rows[0], rows[0], (None, "en", "s9"), (None, "xx", "s1"), ("a b", "xx", "s2"), ("", None, "s8")]
    rows += [(("word " * 20_000) + "Ünd", "en", "s1")]
    return rows


@pytest.mark.parametrize("width", [64, 5, 1])
def test_divergence(spark, width, monkeypatch):
    """Digests of a few bits collide and are split."""
    monkeypatch.setattr(divergence, "HELD", 50)
    rows = source_rows()
    df = spark.createDataFrame(rows, "text STRING, lang STRING, source STRING").repartition(3)
    df = df.withColumns({c: F.lit(c) for c in ("n", "digest", "term", "p", "rank", "part")})
    found = divergence.divergence(df, least_docs=10, top=10, width=width)
    assert sorted(tuple(r) for r in found.collect()) == plain_divergence(rows, 10, 10)
    if width == 64:
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_divergence_of_little(spark):
    empty = spark.createDataFrame([], "text STRING, lang STRING, source STRING")
    assert divergence.divergence(empty).collect() == []
    rows = [("a b", "en", "x"), ("a", "en", "y"), (None, "de", "x")]
    found = divergence.divergence(spark.createDataFrame(rows, empty.schema)).collect()
    assert sorted(tuple(r) for r in found) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_shares_beyond_64_bits(spark):
    rows = [(10**13, 10**15, 10**9), (9_223_372_034, 10**12, 5), (9_223_372_035, 10**12, 5), (0, 0, 1)]
    df = spark.createDataFrame(rows, "c BIGINT, t BIGINT, v BIGINT")
    found = df.select("*", divergence.share(F.col("c"), F.col("t"), F.col("v")).alias("p")).collect()
    assert [r.p for r in found] == [1 + 10**9 * (c + 2) // (t + 2 * v) for c, t, v in rows]
