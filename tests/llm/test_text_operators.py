"""The text operators against plain versions, on awkward rows and small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from intervalcast.llm import (
    bpe,
    components,
    edit_counts,
    exact_dedup,
    lm,
    mixing,
    pii,
    quality,
    repeats,
    simhash,
    similar,
    toxicity,
)
from intervalcast.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Columns named like those the operators make or use inside.
CLASHES = ["fp", "n_tokens", "ids", "score", "mark", "kept", "id", "spans", "copies", "__id"]


def awkward_rows():
    rnd = random.Random(4)
    words = ["alpha", "beta", "gamma,", "Delta", "epsilon.", "été", "漢字", "x1", "42", "--"]
    long = " ".join(rnd.choice(words) for _ in range(9000))
    prose = [" ".join(rnd.choice(words) for _ in range(rnd.randint(30, 120))) for _ in range(8)]
    texts = [None, "", " ", "one", "one two", long, long + " end", prose[0], prose[0], "a" * 30_000]
    texts += [prose[0].replace(" ", "\n ", 3), *prose, prose[1] + " tail", "mail a.b@c.de or 10.0.0.1"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[7], rows[0], (None, prose[2], None, None, None), (None, None, None, None, None)]
    rows += [(None, prose[2], None, None, None), (3, "another text of the same id", "en", "s0", 1)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    return df.withColumns({name: F.lit(name) for name in CLASHES})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{TABLES}/labels.parquet")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# Byte-level BPE


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoding(public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN)[0]


def test_ids_are_those_of_the_library_and_come_back(docs, rows, encoder):
    out = bpe.decode(bpe.encode(docs)).collect()
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in out)
    expected = Counter()
    for i, text, *_ in rows:
        ids = encoder.encode_ordinary(text or "")
        expected[i, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()] += 1
    assert got == expected


def test_cuts_are_where_matches_end(encoder):
    rnd = random.Random(2)
    parts = ["a", "b ", "  ", "\n", "'s", "'ll", "1", "23 ", ".", ",", "!!", "é", "漢", " x", "\t", " ", "'"]
    for _ in range(400):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 300)))
        whole = encoder.encode_ordinary(text)
        assert [i for p in bpe.pieces(text, 20) for i in encoder.encode_ordinary(p)] == whole
    assert isinstance(encoder, tiktoken.Encoding)


# Edit-aware counts


def test_edits_are_counted_as_if_encoded_anew(encoder, monkeypatch):
    rnd = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'re", "1", "23", ".", "!!", "é", "漢", " x", "'", "word"]
    for size in (5, 20, 60):
        monkeypatch.setattr(edit_counts, "LEAF", size)
        for _ in range(200):
            text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 200)))
            cuts = sorted(rnd.randint(0, len(text) + 3) for _ in range(2 * rnd.randint(0, 6)))
            edits = [(a, b, rnd.choice(["", "a", " 1", "'"])) for a, b in zip(cuts[::2], cuts[1::2])]
            after = text
            for a, b, new in sorted(((min(a, len(text)), min(b, len(text)), n) for a, b, n in edits), reverse=True):
                after = after[:a] + new + after[b:]
            counted = edit_counts.Counted(text, encoder)
            counted.edit(edits)
            assert counted.text() == after
            assert counted.tokens.total() == len(encoder.encode_ordinary(after))


def test_only_the_edited_region_is_encoded_again(docs, rows, encoder):
    text = " ".join(["some words"] * 5000)
    counted = edit_counts.Counted(text, encoder)
    counted.edit([(20_000, 20_004, "other")])
    assert counted.encoded < 3 * edit_counts.LEAF
    edits = F.array(F.struct(F.lit(0).alias("start"), F.lit(3).alias("end"), F.lit("new ").alias("text")))
    got = edit_counts.recounted(docs.withColumn("edits", edits)).collect()
    expected = Counter(len(encoder.encode_ordinary("new " + (t or "")[3:])) for _, t, *_ in rows)
    assert Counter(r.n_tokens for r in got) == expected


# Exact duplicates


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_equal_texts_keep_the_smallest_id(docs, rows):
    got = exact_dedup.exact_groups(docs).collect()
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(normal(text), []).append(i)
    assert len(got) == len(rows)
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        own = [r for r in got if bytes(r.digest) == hashlib.sha256(text.encode()).digest()]
        assert len(own) == len(ids) and {r.group_size for r in own} == {len(ids)}
        assert {r.keep_id for r in own} == {min(known) if known else None}
        assert sum(r.kept for r in own) == 1
    kept = exact_dedup.drop_exact(docs)
    assert kept.columns == docs.columns
    assert Counter(normal(r.text) for r in kept.collect()) == Counter(groups.keys())


def test_runs_meet_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FAN", 2)
    monkeypatch.setattr(exact_dedup, "BITS", 1)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 * F.col("id") % 50).cast("string").alias("text"))
    got = exact_dedup.exact_groups(df.repartition(13)).collect()
    expected = {}
    for i in range(3000):
        expected.setdefault(str(i % 7 * i % 50), []).append(i)
    sizes = {min(ids): len(ids) for ids in expected.values()}
    assert {r.keep_id: r.group_size for r in got} == sizes and sum(r.kept for r in got) == len(sizes)


def test_a_single_run_read_by_several_tasks(spark):
    """One partition of digests in a file that is read in pieces."""
    df = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), (F.col("id") % 50).cast("string").alias("text"))
    digests = exact_dedup.digest_rows(df)
    assert digests.agg(F.max("run")).first()[0] == 0
    runs = exact_dedup.merged_runs(digests.repartition(5))
    assert sorted((r.keep_id, r.n) for r in runs.collect()) == [(i, 60) for i in range(50)]


# SimHash


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(simhash_lower()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_lower():
    return bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def plain_components(fps):
    label = dict.fromkeys(fps)
    for fp in fps:
        if label[fp] is None:
            label[fp], todo = fp, [fp]
            while todo:
                x = todo.pop()
                for y in fps:
                    if label[y] is None and (x ^ y).bit_count() <= 3:
                        label[y] = fp
                        todo.append(y)
    return label


def test_fingerprints_and_components(docs, rows):
    got = simhash.near_groups(docs).collect()
    fps = {plain_fingerprint(t) for _, t, *_ in rows}
    label = plain_components(sorted(fps))
    smallest = {}
    for i, t, *_ in rows:
        key = label[plain_fingerprint(t)]
        smallest.setdefault(key, []).extend([] if i is None else [i])
    expected = Counter()
    for i, t, *_ in rows:
        ids = smallest[label[plain_fingerprint(t)]]
        expected[i, plain_fingerprint(t), min(ids) if ids else None] += 1
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == expected
    kept = simhash.drop_near(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label.values()))


@pytest.mark.parametrize("large", [4096, 8])
def test_links_connect_all_near_fingerprints(spark, large, monkeypatch):
    """Random and clustered fingerprints; small buckets are also dealt again."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rnd = random.Random(large)
    fps = {rnd.getrandbits(64) for _ in range(200)}
    for _ in range(6):
        center = rnd.getrandbits(64)
        for _ in range(60):
            x = center
            for _ in range(rnd.randint(0, 6)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    found = components.components(simhash.links(spark.createDataFrame(signed, "fp BIGINT")))
    root = {r.node % 2**64: r.root for r in found.collect()}
    label = plain_components(fps)
    ours, theirs = {}, {}
    for x in fps:
        ours.setdefault(root.get(x, x), set()).add(x)
        theirs.setdefault(label[x], set()).add(x)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


# Similar texts


def plain_set(text):
    words = (text or "").encode().translate(simhash_lower()).split()
    return {b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("large", [4096, 7])
def test_edited_copies_go_at_a_similarity_of_four_fifths(spark, large, monkeypatch):
    """Copies with edits on either side of 0.8, most of them beyond three bits of fingerprint."""
    monkeypatch.setattr(similar, "LARGE", large)
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    common = "this line is the same in every one of the texts below and says nothing".split()
    texts = [None, "", "one two", "One  two", "a b c d e", "a b c d e f"]
    for k in range(14):
        base = common + [rnd.choice(vocabulary) for _ in range(rnd.choice([8, 40, 150, 400]))]
        texts.append(" ".join(base))
        for _ in range(rnd.randint(1, 25)):
            words = list(base)
            for _ in range(rnd.randint(1, 1 + len(base) // 30)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words) + " tail" * (k % 2))
    rnd.shuffle(texts)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS).repartition(3)
    sets = [plain_set(t) for t in texts]
    label, far = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            if plain_jaccard(sets[i], sets[j]) >= 0.8:
                far += (plain_fingerprint(texts[i]) ^ plain_fingerprint(texts[j])).bit_count() > 3
                old, new = label[i], label[j]
                label = [min(old, new) if x in (old, new) else x for x in label]
    assert far > 50
    kept = corpus_pipeline.drop_near(spark, df, TABLES)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def test_fingerprints_of_the_similar_stage_link_on_their_own(spark, monkeypatch):
    """Without the filter on shingles: copies within three bits go, if their sets are similar."""
    monkeypatch.setattr(similar, "_met", lambda sets, similarity: sets.select("row", "row").toDF("a", "b").limit(0))
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(500)}" for _ in range(600)]
    edits = [base[:-1] + ["last"], [*base, "more"], base[:300] + ["in"] + base[300:]]
    texts = [" ".join(words) for words in (base, *edits)]
    texts += [f"other {i} " + " ".join(rnd.sample(base, 200)) for i in range(5)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS).repartition(3)
    prints = [plain_fingerprint_of(t, 5) for t in texts]
    sets = [plain_set(t) for t in texts]
    n = len(texts)
    near = [[(prints[i] ^ prints[j]).bit_count() <= 3 and plain_jaccard(sets[i], sets[j]) >= 0.8 for j in range(n)] for i in range(n)]
    label = list(range(n))
    for i in range(n):
        for j in range(i):
            if near[i][j]:
                old, new = label[i], label[j]
                label = [min(old, new) if x in (old, new) else x for x in label]
    assert len(set(label)) < n
    kept = similar.drop_similar(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def plain_fingerprint_of(text, size):
    words = text.encode().translate(simhash_lower()).split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_known_groups_are_taken_over():
    sets = [np.array(x, dtype=np.uint64) for x in ([1, 2, 3], [7, 8, 9], [1, 2, 3], [20, 21], [30, 31])]
    root = similar.linked_sets(sets, 0.8, [None, 5, None, 5, None])
    assert root[0] == root[2] and root[1] == root[3] and len(set(root.tolist())) == 3


def test_similar_stage_on_awkward_rows(docs, rows, empty):
    kept = similar.drop_similar(docs)
    sets = {frozenset(plain_set(t)) for _, t, *_ in rows}
    assert kept.columns == docs.columns and 0 < kept.count() <= len(sets)
    assert similar.drop_similar(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    found = components.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    assert {r.root for r in found if r.node <= 40} == {0} and {r.root for r in found if r.node >= 100} == {100}
    assert len(found) == 41 + 50


# Mixing


def test_weights_meet_the_target(spark):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.lit("w w w w").alias("text"),
        F.when(F.col("id") < 900, "big").when(F.col("id") < 990, "mid").otherwise("small").alias("source"),
    )
    units = mixing.units(docs, "doc_id", "text", "source")
    for target in (mixing.Target(max_repeat=3.0), mixing.Target(entropy=0.9), mixing.Target(max_repeat=1.0)):
        rows = mixing.weights(units, target).collect()
        weight = np.array([r.weight for r in rows])
        assert weight.sum() == pytest.approx(1)
        if target.entropy:
            assert -(weight * np.log(weight)).sum() == pytest.approx(target.entropy, abs=1e-4)
        else:
            repeats_ = np.array([r.weight / r.tokens for r in rows])
            assert repeats_.max() / repeats_.min() == pytest.approx(target.max_repeat, abs=1e-4)
    with pytest.raises(ValueError):
        mixing.exponent(spark.createDataFrame([(1.0,)], "share DOUBLE"), mixing.Target())


def test_budgets_are_filled_block_by_block(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 4 == 0, "few").otherwise("many").alias("source"),
    )
    taken = mixing.mixture(docs, mixing.Target(max_repeat=1.5), budget=20_000).collect()
    for source in ("few", "many"):
        own = sorted((r.start, r.n_tokens) for r in taken if r.source == source)
        quota = next(r.quota for r in taken if r.source == source)
        starts = np.cumsum([0] + [n for _, n in own])
        assert [s for s, _ in own] == starts[:-1].tolist()
        assert starts[-2] < quota <= starts[-1]


def test_mixing_keeps_every_row(docs, rows):
    mixed = mixing.mixed(docs, mixing.Target(max_repeat=2.0))
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    once = Counter((i, t, s) for i, t, _, s, _ in rows)
    assert got.keys() == once.keys() and all(once[k] <= n <= 2 * once[k] for k, n in got.items())


# Repeated passages


def plain_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(b for b, g in zip(t, gone) if not g), sum(gone), spans))
    return out


@pytest.mark.parametrize("piece", [1 << 22, 700])
def test_repeated_strings_go(spark, piece, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rnd = random.Random(piece)

    def noise(n):
        return "".join(rnd.choice("abcdefgh é") for _ in range(n))

    shared = [noise(n) for n in (399, 400, 401, 460, 900)]
    texts = [None, "", noise(399), "x" * 900, "ab" * 400]
    for _ in range(30):
        parts = [noise(rnd.randint(0, 300)) for _ in range(4)]
        for i in range(3):
            passage = rnd.choice(shared)
            cut = rnd.randint(0, 60) * (i == 2)
            parts.insert(2 * i + 1, passage[cut:])
        texts.append("".join(parts))
    texts.append(texts[7])
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[8])]
    got = repeats.without_repeats(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3))
    found = Counter((r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in got.collect())
    plain = plain_repeats([(t or "").encode() for _, t in rows], repeats.LENGTH)
    assert found == Counter((i, *p) for (i, _), p in zip(rows, plain))


# Personal data


def luhn(digits):
    double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in double) % 10 == 0


def only_digits(s):
    return re.sub("[^0-9]", "", s)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(only_digits(m)) <= 19 and luhn(only_digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(only_digits(m)) <= 15),
]


def plain_spans(text):
    found = []
    for k, (name, pattern, valid) in enumerate(PLAIN):
        found += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text or "") if valid(m[0])]
    return ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(found))


def test_base_spans_are_the_leftmost_matches(spark):
    rnd = random.Random(6)
    parts = ["a", "b", "@", ".", ".", "1", "2", "12", "255", "256", "-", " ", "+", "(", ")", "_", "é", "\n"]
    parts += ["4111111111111111", "4111 1111 1111 1111", "x@y.z", "1.2.3.4", "+44 20 7946 0958", "𝄞"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "1 " * 20_000, "a@b" + ".c" * 20_000, "x@y.z " * 3000, "+1 " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    spans = pii.labelled(pii.base_spans(F.coalesce("text", F.lit(""))))
    got = dict(df.select("doc_id", spans).collect())
    assert [i for i, t in enumerate(texts) if got[i] != plain_spans(t)] == []


def test_terms_that_give_an_entity_away(spark):
    """A nickname only ever near one address is masked with it; common words are not."""
    rows = [(i, f"note {i} says zorblax wrote from k.lee@corp.org about item {i * 7} today", "en", "s", 0) for i in range(8)]
    rows += [(100 + i, f"another note {i} about item {i} says nothing of today", "en", "s", 0) for i in range(200)]
    rows.append((7, rows[7][1], "en", "s", 0))
    df = spark.createDataFrame(rows, COLUMNS)
    got = pii.all_spans(df).collect()
    assert len(got) == len(rows)
    terms = {r.id: [s.value for s in r.terms] for r in got}
    assert all(terms[i] == ["zorblax", "wrote", "from"] for i in range(8))
    assert all(terms[100 + i] == [] for i in range(200))
    masked = pii.sanitised(df).filter("doc_id = 3").first().text
    assert masked == "note 3 says [TERM] [TERM] [TERM] [EMAIL] about item 21 today"
    assert pii.sanitised(df).count() == len(rows)


# Quality rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_counts_of_texts(docs, rows):
    got = quality.judged(docs, []).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter((i, *plain_counts(t)) for i, t, *_ in rows)
    text = "a b c\n a b c x\na b c\r\n#|\n\n \na b c\n| # *"
    c = dict(zip(quality.COUNTS, quality.counts_of(text), strict=True))
    assert tuple(c[n] for n in names) == plain_counts(text)


def test_rules_tell_bad_texts_on_held_out_labels(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rules = quality.fit(docs, labels)
    assert 1 <= len(rules) <= quality.RULES
    held = quality.judged(docs, rules).join(labels, "doc_id").filter(quality.crc_of() % 5 == 0)
    right = held.filter(F.col("base_failed") | (F.col("kept") == (F.col("quality") == 1))).count()
    assert right >= 0.95 * held.count()


# Toxicity


def test_parts_of_words_tell_toxic_texts():
    """A stem with new endings; long texts are read to their end; gradients fit the labels."""
    rnd = random.Random(8)
    clean = ["".join(rnd.choice(["ba", "do", "ki", "lu", "me"]) for _ in range(rnd.randint(1, 4))) for _ in range(300)]

    def text(n, bad):
        words = [rnd.choice(clean) for _ in range(n)]
        if bad:
            words[rnd.randrange(n)] = "vexor" + rnd.choice(clean)
        return " ".join(words)

    texts = [(text(rnd.randint(10, 120), i % 2), i % 2) for i in range(400)]
    net = toxicity.train([t for t, _ in texts[:320]], np.array([y for _, y in texts[:320]]))
    score = net.score([t for t, _ in texts[320:]])
    assert np.mean((score >= 0.5) == np.array([y for _, y in texts[320:]])) > 0.9
    late = " ".join([text(30_000, 0), "vexorbado", text(40, 0)])
    assert net.score([late])[0] > net.score([late.replace("vexorbado", "dokilu")])[0]
    assert net.score(["", None])[0] < 0.5
    toxicity.CACHE, cache = 50_0, toxicity.CACHE
    try:
        again = toxicity.Network(net.vocabulary, net.weights).score([t for t, _ in texts[320:]])
    finally:
        toxicity.CACHE = cache
    assert again == pytest.approx(score, abs=1e-5)


def test_backward_pass_matches_differences():
    net = toxicity.train(["a b c", "d e f"], np.array([0, 1]))
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    sides = rng.standard_normal((2, 6, 3 * toxicity.HIDDEN))
    sides[:, -1] = 0
    sides[:, -1, : toxicity.HIDDEN] = toxicity.SHUT
    at = rng.integers(0, 5, (3, toxicity.WINDOW))
    at[1, 9:] = -1
    _, kept = net.forward(sides, at)
    d = np.array([0.3, -0.2, 0.5])
    grad, dtable = net.backward(d, kept, 5)

    def value():
        return float(net.forward(sides, at)[0] @ d)

    for name in ("u0", "u1", "attend", "out"):
        w = net.weights[name].reshape(-1)
        for i in (0, len(w) // 2):
            old = w[i]
            w[i] = old + 1e-3
            up = value()
            w[i] = old - 1e-3
            down = value()
            w[i] = old
            assert grad[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-3, abs=2e-3)
    old = sides[1, 2, 4]
    sides[1, 2, 4] = old + 1e-3
    up = value()
    sides[1, 2, 4] = old - 1e-3
    down = value()
    assert dtable[2, 3 * toxicity.HIDDEN + 4] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_toxic_stage_on_awkward_rows(docs, labels, spark):
    net = toxicity.fit(spark.read.parquet(f"{TABLES}/documents.parquet"), labels)
    kept = toxicity.drop_toxic(docs, net)
    assert kept.columns == docs.columns
    assert toxicity.drop_toxic(docs, None).count() == docs.count()


# Language model


def test_scores_are_those_of_the_counts(docs, rows):
    got = lm.scored(docs).collect()
    lower = simhash_lower()
    tokens = [(i, [*(t or "").encode().translate(lower).split(), b" "]) for i, t, *_ in rows]
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in tokens}
    counts = Counter(w for i, words in tokens if not held[i] for w in words)
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (-1 if i is None else i, len(w), sum(counts[x] > 0 for x in w), round(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in w), 4))
        for i, w in tokens
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == expected
    assert all(r.train_tokens == n and r.held_out == held[r.doc_id] and r.score < 0 for r in got)


def test_the_model_is_a_distribution_and_learns(spark):
    counts = np.ones((lm.SYMBOLS, lm.SYMBOLS))
    for i in range(40):
        counts[i, (i * 7 + 1) % 40] += 5000
    table = lm.train(counts)
    assert (10.0**table).sum(axis=1) == pytest.approx(np.ones(lm.SYMBOLS))
    assert (10.0 ** table[np.arange(40), (np.arange(40) * 7 + 1) % 40]).mean() > 0.5


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = QUERIES["op3_lm_score"](spark, "/root/testdata/sf0.01").filter("held_out")
    score, base = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


# All of them


def test_empty_tables_give_empty_results(spark, empty, labels):
    no_labels = labels.limit(0)
    assert bpe.decode(bpe.encode(empty)).count() == 0
    assert exact_dedup.exact_groups(empty).count() == exact_dedup.drop_exact(empty).count() == 0
    assert simhash.near_groups(empty).count() == simhash.drop_near(empty).count() == 0
    target = mixing.Target(max_repeat=2.0)
    assert mixing.mixture(empty, target).count() == mixing.mixed(empty, target).count() == 0
    assert pii.all_spans(empty).count() == pii.sanitised(empty).count() == 0
    assert repeats.without_repeats(empty).count() == lm.scored(empty).count() == 0
    assert quality.fit(empty, no_labels) == [] and toxicity.fit(empty, no_labels) is None
    assert quality.judged(empty, []).count() == toxicity.scored(empty, None).count() == 0
    edits = empty.withColumn("edits", F.lit(None).cast("array<struct<start:int,end:int,text:string>>"))
    assert edit_counts.recounted(edits).count() == 0
