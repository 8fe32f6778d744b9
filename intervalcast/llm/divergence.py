"""How the terms of sources differ from each other and from their language, with late text.

Terms are runs of letters A-Z (lower-cased) and of all characters beyond ASCII.  A language
keeps the terms that at least ``LEAST_DOCS`` of its documents have.  What is counted,
shuffled, joined and ranked is a digest of fixed width in place of the term; its text stays
behind in a stored table and is joined back for the rows that are put out.

Terms of one digest are found by the smallest and the greatest text stored under it: where
these differ, the digest is split, its occurrences are read again with their texts, and
each text gets a number of its own under the digest.  So counts are exact at any width.

For a group (language, source) and a kept term with ``count`` occurrences there, p = 1 +
floor(10^9 (count + 2) / (N + 2 V)), with V kept terms and N occurrences of them; two p
differ by floor((p - q)^2 / (p + q)).  Over two groups of a language this is summed without
listing the terms both lack: a term that one lacks depends on its count in the other only,
so a histogram of counts serves for these, and terms that both have are corrected for.

A null text, language or source is an empty one; repeated documents count as often as they
are there; documents without terms give their group all the same.  A language without kept
terms has value 0 for all pairs.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, maybe_in

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SMOOTH = 2
WIDTH = 64  # bits of a digest

# Distinct (group, term) held by a task before they are handed on; changes no result.
HELD = 600_000
PENDING = 200_000  # words counted at once; changes no result
LOW = (1 << 32) - 1

# Letters to lower case, other ASCII to blanks; all bytes beyond ASCII belong to terms.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

COUNTED = (
    "lang string, digest bigint, term string, docs bigint, occurrences bigint, "
    "sources array<string>, counts array<bigint>"
)


def digest_of(term: bytes, width: int = WIDTH) -> int:
    """The leading bits of the term's hash, as a signed number."""
    value = xxhash.xxh64_intdigest(term) >> (64 - width)
    return value - 2**64 if value >= 2**63 else value


class Numbers(dict):
    """Numbers of what it was asked for, in the order of the first time."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Held:
    """Counts of a task: for each group its terms, for each language in how many documents.

    Terms are numbered once; what is counted are pairs of a group's (or language's) and a term's
    number in one integer, sorted and added up whenever ``PENDING`` words more are there.
    """

    def __init__(self) -> None:
        self.terms, self.groups, self.langs = Numbers(), Numbers(), Numbers()
        none = np.empty(0, dtype=np.int64)
        self.cells, self.docs = (none, none), (none, none)
        self.pending: list[tuple[int, int, np.ndarray]] = []
        self.waiting = 0

    @property
    def size(self) -> int:
        return len(self.cells[0])

    def add(self, lang: str, source: str, text: str) -> None:
        terms = text.encode().translate(TERM_BYTES).split()
        if terms:
            at = np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms))
            self.pending.append((self.groups[lang, source], self.langs[lang], at))
            self.waiting += len(at)
            if self.waiting > min(PENDING, HELD):
                self.settle()

    def settle(self) -> None:
        if not self.pending:
            return
        groups, langs, parts = zip(*self.pending, strict=True)
        place = np.repeat(np.arange(len(parts)) << 32, [len(part) for part in parts])
        met, n = np.unique(place | np.concatenate(parts), return_counts=True)
        doc, term = met >> 32, met & LOW
        self.cells = summed_up(self.cells, (np.array(groups)[doc] << 32) | term, n)
        self.docs = summed_up(self.docs, (np.array(langs)[doc] << 32) | term, np.ones_like(n))
        self.pending, self.waiting = [], 0

    def rows(self, width: int) -> Iterator[pa.RecordBatch]:
        """A row per language and term.  Sorted, since texts alike lie well together in storage."""
        self.settle()
        names = pa.array(list(self.terms), type=pa.binary())
        rank = np.empty(len(names), dtype=np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        groups = list(self.groups)
        sources = pa.array([source for _, source in groups], type=pa.string())
        lang_of = np.array([self.langs[lang] for lang, _ in groups], dtype=np.int64)
        group, term = self.cells[0] >> 32, self.cells[0] & LOW
        order = np.lexsort((group, rank[term], lang_of[group]))
        group, term, n = group[order], term[order], self.cells[1][order]
        key = (lang_of[group] << 32) | term
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        ends = np.r_[starts, len(key)]
        docs = self.docs[1][np.searchsorted(self.docs[0], key[starts])]
        langs = pa.array(list(self.langs), type=pa.string())
        for at in range(0, len(starts), 50_000):
            first = starts[at : at + 50_000]
            stop = at + len(first)
            cells = slice(int(ends[at]), int(ends[stop]))
            inside = pa.array(ends[at : stop + 1] - ends[at], type=pa.int32())
            texts = names.take(pa.array(term[first]))
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(lang_of[group[first]])),
                    pa.array([digest_of(text, width) for text in texts.to_pylist()], type=pa.int64()),
                    texts.cast(pa.string()),
                    pa.array(docs[at:stop]),
                    pa.array(np.add.reduceat(n[cells], ends[at:stop] - ends[at])),
                    pa.ListArray.from_arrays(inside, sources.take(pa.array(group[cells]))),
                    pa.ListArray.from_arrays(inside, pa.array(n[cells])),
                ],
                names=["lang", "digest", "term", "docs", "occurrences", "sources", "counts"],
            )


def summed_up(known: tuple[np.ndarray, np.ndarray], keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their sums, with more of them."""
    keys, n = np.concatenate([known[0], keys]), np.concatenate([known[1], n])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


def counted(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Of each task, or part of one: documents and occurrences per language and term, and the
    occurrences in each source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held()
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("lang", "source", "text")]
            for lang, source, text in zip(*columns, strict=True):
                held.add(lang.as_py(), source.as_py(), text.as_py())
                if held.size > HELD:
                    yield from held.rows(width)
                    held = Held()
        yield from held.rows(width)

    return docs.select("lang", "source", "text").mapInArrow(run, COUNTED)


def summed(rows: DataFrame, term: list[str], least_docs: int) -> DataFrame:
    """Per group and kept term the occurrences ``n``, and ``total`` in the language.

    One shuffle by language and term, of digests and numbers: what follows stays in place.
    """
    place = Window.partitionBy("lang", *term)
    whole = rows.withColumns({"total": F.sum("occurrences").over(place), "all_docs": F.sum("docs").over(place)})
    cells = F.inline(F.arrays_zip("sources", "counts"))
    kept = whole.filter(F.col("all_docs") >= least_docs).select("lang", *term, "total", cells)
    groups = kept.groupBy("lang", *term, F.col("sources").alias("source"))
    return groups.agg(F.sum("counts").alias("n"), F.max("total").alias("total"))


def split_digests(stored: DataFrame, digests: DataFrame) -> DataFrame:
    """Texts that share one of the digests: digest, term and ``part``, from 1 for each text.

    A digest has one text in all but a few cases, found by its smallest and greatest.
    """
    texts = stored.select("digest", "term")
    ends = maybe_in(texts, digests, "digest").groupBy("digest")
    ends = ends.agg(F.min("term").alias("first"), F.max("term").alias("last"))
    shared = ends.filter(F.col("first") != F.col("last")).select("digest")
    part = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    return texts.join(shared, "digest", "left_semi").distinct().withColumn("part", part)


def kept_terms(stored: DataFrame, least_docs: int) -> DataFrame:
    """Per group and kept term: lang, source, digest, part (0, or which of several texts), n, total."""
    numbers = ["lang", "digest", "docs", "occurrences", "sources", "counts"]
    alone = summed(stored.select(*numbers), ["digest"], least_docs).withColumn("part", F.lit(0))
    alone = materialise(alone, "digests")
    texts = materialise(split_digests(stored, alone.select("digest").distinct()), "split")
    if texts.isEmpty():
        return alone
    parts = stored.join(texts, ["digest", "term"]).select(*numbers, "part")
    again = summed(parts, ["digest", "part"], least_docs)
    alone = alone.join(texts.select("digest").distinct(), "digest", "left_anti")
    return materialise(alone.unionByName(again), "kept")


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a term, exact also where the product leaves 64 bits."""
    whole = total + SMOOTH * kept
    above = count + SMOOTH
    near = F.call_function("div", above * SCALE, whole)
    wide = above.cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    far = F.call_function("div", wide, whole.cast("decimal(20,0)"))
    return F.lit(1).cast("bigint") + F.when(above < 2**63 // SCALE, near).otherwise(far)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language, in both directions.

    ``groups`` has for each group its p of an absent term (``p0``), and V.
    """
    # Terms that only one of the two has, as if the other lacked all of them.
    counts = terms.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    alone = (
        counts.join(other, "lang")
        .filter(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("m") * distance(F.col("p"), F.col("q0"))).alias("alone"), F.sum("m").alias("own"))
    )
    # Terms that both have.
    at = F.struct("source", "p", "p0")
    met = terms.join(groups.select("lang", "source", "p0"), ["lang", "source"])
    lists = met.groupBy("lang", "digest", "part").agg(F.array_sort(F.collect_list(at)).alias("a"))
    each = lists.filter(F.size("a") > 1).select("lang", "a", F.posexplode("a").alias("i", "x"))
    both = each.select("lang", "x", F.explode(F.slice("a", F.col("i") + 2, F.size("a"))).alias("y"))
    x, y, x0, y0 = (F.col(c) for c in ("x.p", "y.p", "x.p0", "y.p0"))
    # What the two histograms have for such a term is taken off again.
    mend = distance(x, y) - distance(x, y0) - distance(x0, y)
    shared = both.groupBy("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b")).agg(
        F.sum(mend).alias("mend"), F.count("*").alias("n_both")
    )
    ways = [
        F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("a", "b"), ("b", "a"))
    ]
    shared = shared.select("lang", "mend", "n_both", F.inline(F.array(*ways)))
    left = groups.select("lang", "source", "p0", "kept")
    all_pairs = left.join(other, "lang").filter(F.col("source") != F.col("item"))
    keys = ["lang", "source", "item"]
    back = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("alone_b"), F.col("own").alias("own_b"))
    found = all_pairs.join(alone, keys, "left").join(back, keys, "left").join(shared, keys, "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("bigint"))
    neither = F.col("kept") - zero("own") - zero("own_b") + zero("n_both")
    value = zero("alone") + zero("alone_b") + zero("mend") + neither * distance(F.col("p0"), F.col("q0"))
    return found.select(*keys, value.alias("value"))


def _terms(terms: DataFrame, stored: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank) of the terms that mark a group.

    Digests are ranked by value; those on the last place, ties included, get their text,
    which settles the order.
    """
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    marked = terms.filter((F.col("n") > 0) & (F.col("p") > F.col("q"))).select(
        "lang", "source", "digest", "part", distance(F.col("p"), F.col("q")).alias("value")
    )
    first = marked.withColumn("place", F.rank().over(group)).filter(F.col("place") <= top).drop("place")
    first = materialise(first, "marked")
    wanted = first.select("digest").distinct()
    texts = stored.select("digest", "term").join(wanted, "digest", "left_semi").distinct()
    part = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    many = F.count("*").over(Window.partitionBy("digest")) > 1
    texts = texts.withColumn("part", F.when(many, part).otherwise(0))
    named = first.join(texts, ["digest", "part"]).withColumnRenamed("term", "item")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.withColumn("rank", place).filter(F.col("rank") <= top)


def divergence(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    width: int = WIDTH,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair`` has all other sources of
    the language, part ``term`` the first ``top`` terms that are likelier in the group."""
    plain = docs.select(
        *(
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
        )
    )
    stored = materialise(counted(plain, width), "terms")
    terms = kept_terms(stored, least_docs)
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    by_term = terms.groupBy("lang", "digest", "part").agg(F.max("total").alias("total"))
    by_lang = by_term.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("n_lang"))
    zero = F.lit(0).cast("bigint")
    groups = plain.select("lang", "source").distinct()
    groups = groups.join(sums, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = groups.select(
        "lang",
        "source",
        *(F.coalesce(F.col(c), zero).alias(c) for c in ("n_group", "kept", "n_lang")),
    )
    p0 = F.when(F.col("kept") > 0, share(zero, F.col("n_group"), F.col("kept"))).otherwise(1)
    groups = materialise(groups.withColumn("p0", p0.cast("bigint")), "groups")
    rated = terms.join(groups.drop("p0"), ["lang", "source"]).select(
        "lang",
        "source",
        "digest",
        "part",
        "n",
        share(F.col("n"), F.col("n_group"), F.col("kept")).alias("p"),
        share(F.col("total"), F.col("n_lang"), F.col("kept")).alias("q"),
    )
    rated = materialise(rated, "rated")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = _pairs(rated, groups).withColumn("rank", place)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(*names)
        .unionByName(_terms(rated, stored, top).withColumn("part", F.lit("term")).select(*names))
    )
