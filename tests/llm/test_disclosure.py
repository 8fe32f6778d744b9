"""Disclosing terms against a plain computation, and both tiers of sanitising."""

import math
from collections import Counter, defaultdict

import pytest
import regex

from intervalcast.llm import pii

EMAIL = regex.compile(r"[a-z.]+@[a-z.]+[a-z]")


@pytest.fixture(scope="module")
def texts():
    """Two addresses of one domain and fill-in texts; a copy, a null and an empty text."""
    out = []
    for i in range(6):
        out.append(f"case {i}a zorblax gromble quexon saw a.lee@corp.org on item {i * 7}\nfar {i} away zink")
        out.append(f"case {i}b vintor brought b.moor@corp.org the item {i * 3}")
    out += [f"groups of grown people, note {i}, on item {i}" for i in range(150)]
    out += ["gromble quexon elsewhere", "gromble again quexon", "vintor once more", out[0], None, ""]
    return dict(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)


def plain(texts):
    """(entity, term) to (disclosure, removed)."""
    term = regex.compile(pii.TERM)
    everywhere = Counter(t for x in texts.values() for t in term.findall((x or "").lower()))
    total = sum(len((x or "").split()) for x in texts.values())
    mentions, both, near = Counter(), Counter(), defaultdict(set)
    for x in texts.values():
        for line in (x or "").split("\n"):
            for m in EMAIL.finditer(line):
                around = line[: m.start()] + " " + line[m.end() :]
                for e in (f"0:{m[0]}", f"0:{m[0].split('@')[1]}:*"):
                    mentions[e] += 1
                    for t in set(term.findall(around.lower())):
                        both[e, t] += 1
                        near[e, t].add(around)

    def part(e, n, of):
        return 1 + math.log(min(n / of, 1)) / -math.log(mentions[e] / total)

    found = {}
    for (e, t), n in both.items():
        disclosed = part(e, n, everywhere[t])
        if len(near[e, t]) >= pii.SUPPORT and disclosed >= pii.GENERALISE:
            stem = t[: pii.STEM]
            n_stem = sum(k for (f, u), k in both.items() if f == e and u.startswith(stem))
            of_stem = sum(k for u, k in everywhere.items() if u.startswith(stem))
            found[e, t] = disclosed, disclosed >= pii.REMOVE or part(e, n_stem, of_stem) >= pii.GENERALISE
    return found


def test_disclosure_equals_a_plain_computation(docs, texts):
    rows = pii.disclosing(docs, pii.scanned(docs)).collect()
    got = {(r.entity, r.term): (r.disclosure, r.removed) for r in rows}
    want = plain(texts)
    assert len(got) == len(rows) and got.keys() == want.keys()
    for key, (disclosure, removed) in want.items():
        assert got[key] == (pytest.approx(disclosure), removed), key
    # Found by the address, and by the domain that both addresses share.
    assert {e for e, _ in want} == {"0:a.lee@corp.org", "0:b.moor@corp.org", "0:corp.org:*"}


def test_terms_are_generalised_or_removed(docs, texts):
    masked = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert masked.keys() == texts.keys()
    # The class of gromble is common; that of quexon gives as much away as the term.
    assert masked[0].split()[2:6] == ["[TERM]", "gro*", "[TERM]", "[TERM]"]
    # Another paragraph of the document, and documents without a mention, stay as they are.
    assert masked[2].endswith("\nfar 1 away zink")
    assert all(masked[i] == (texts[i] or "") for i in texts if "@" not in (texts[i] or ""))


def test_groups_of_values(spark):
    text = "x a@b.org y 10.20.30.40 z 4111 1111 1111 1111 w +1 (743) 555-3824"
    one = pii.scanned(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [m.entities[1] for m in one.mentions] == ["0:b.org:*", "1:10.20:*", "2:411111:*", "3:1743555:*"]
