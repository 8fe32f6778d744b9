"""Personal data and the terms that give it away, in DataFrame operations only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers: per kind the
leftmost matches that do not overlap, of which those that fail their check are dropped.  The
patterns here find the same matches as the plain ones, but scan a text once: a run of
characters is entered at its start only, and repetition is possessive or ends at a look ahead.

Information-theoretic sanitisation adds terms.  The protected entities are the values found and
the groups they belong to: the domain of an address, the network of an IP address, the issuer's
digits of a card, a phone number without its last four digits.  For a term t in the paragraph of
mentions of an entity e (``NEAR`` characters to either side, at most), the share of all
occurrences of t in the corpus that are near e estimates P(e|t).  A term discloses the part

    PMI(e; t) / IC(e) = 1 + log P(e|t) / IC(e),   IC(e) = -log(mentions of e / words)

of what there is to know about e.  A term near at least ``SUPPORT`` different mentions that
discloses ``GENERALISE`` or more is masked wherever it occurs in a document that mentions the
entity.  It is generalised to the class of terms with the same first ``STEM`` letters.  From
``REMOVE`` on, or where that class discloses ``GENERALISE`` or more itself, it is removed.
Copies of a paragraph are one mention for the support.

Null counts as empty.  Counts cover all documents; a common entity is counted in parts first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh, materialise, text_or_empty

NEAR = 256  # characters to either side of a mention, at most
SUPPORT = 3
GENERALISE = 0.9
REMOVE = 0.97
STEM = 3  # letters of the class that a generalised term is replaced by
TERM = r"[\p{L}][\p{L}\p{N}_-]{2,63}"
INSIDE = r"[\p{L}\p{N}_-]"


@dataclass(frozen=True)
class Kind:
    """A pattern, what a text that has a match contains, and the check of a match."""

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _small_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), small)


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return F.when(n.between(14, 19), total % 10 == 0).otherwise(False)


def _ten_to_fifteen(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
        r"[A-Za-z0-9.-]*?(?=\.?+(?![A-Za-z0-9.-])|\.\.)",
        r"@[A-Za-z0-9-]",
        lambda match: F.lit(True),
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]",
        _small_parts,
    ),
    Kind(
        "card",
        # Fourteen digits lie ahead: no shorter run passes, nor does the end of one.
        r"(?=[0-9](?:[\x20-]?[0-9]){13})[0-9][0-9\x20-]*?(?=[\x20-]?+(?![0-9\x20-])|[\x20-]{2})",
        r"[0-9](?:[\x20-]?[0-9]){13}",
        _luhn,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _ten_to_fifteen),
]
SPAN = "array<struct<start:int,k:int,end:int,value:string>>"


def spans_of(text: Column, pattern: Column, k: int) -> Column:
    """Spans (start, k, end, value) of all matches; offsets in characters, end exclusive.

    The pieces between matches and the matches themselves, in turn, give the offsets.  The
    last piece has no match behind it.
    """
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, 0).alias("value")
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(held: Column, x: Column) -> Column:
        start = held["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["value"]), F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(k).alias("k"), end.alias("end"), x["value"].alias("value")
        )
        return F.struct(end.alias("at"), F.concat(held["found"], F.array(span)).alias("found"))

    spans = F.aggregate(pairs, begin, step, lambda held: held["found"])
    return F.filter(spans, lambda s: s["value"].isNotNull())


def base_spans(text: Column) -> Column:
    """All valid base spans of a text by start and kind."""

    def of_kind(k: int, kind: Kind) -> Column:
        valid = F.filter(spans_of(text, F.lit(kind.pattern), k), lambda s: kind.valid(s["value"]))
        return F.when(text.rlike(kind.hint), valid).otherwise(F.array().cast(SPAN))

    return F.array_sort(F.concat(*(of_kind(k, kind) for k, kind in enumerate(KINDS))))


def count_of(spans: str, k: int) -> Column:
    """How many spans are of kind k."""
    return F.size(F.filter(spans, lambda s: s["k"] == k)).cast("bigint")


def _group(k: Column, entity: Column) -> Column:
    """What a value shares with others of its kind."""
    return (
        F.when(k == 0, F.substring_index(entity, "@", -1))
        .when(k == 1, F.substring_index(entity, ".", 2))
        .when(k == 2, F.substring(entity, 1, 6))
        .otherwise(F.substr(entity, F.lit(1), F.length(entity) - 4))
    )


def scanned(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stored row per document: id, mark of its text, base spans, mentions with what is near."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("spans", base_spans(F.col("text")))

    def mention(s: Column) -> Column:
        text = F.col("text")
        before = F.substr(text, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR)))
        after = F.substr(text, s["end"] + 1, F.lit(NEAR))
        # The outermost words may be cut.  Only the mention's paragraph counts.
        before = F.when(s["start"] > NEAR, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
        after = F.when(F.length(after) == NEAR, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
        entity = F.when(s["k"] == 0, F.lower(s["value"])).otherwise(_digits(s["value"]))
        entity = F.when(s["k"] == 1, s["value"]).otherwise(entity)
        near = F.concat_ws(" ", F.substring_index(before, "\n", -1), F.substring_index(after, "\n", 1))
        names = F.array(F.concat_ws(":", s["k"], entity), F.concat_ws(":", s["k"], _group(s["k"], entity), F.lit("*")))
        return F.struct(names.alias("entities"), near.alias("near"))

    mentions = F.transform("spans", mention)
    return materialise(rows.select("id", F.xxhash64("text").alias("mark"), "spans", mentions.alias("mentions")), "scanned")


def disclosing(docs: DataFrame, stored: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Stored (entity, term, disclosure, removed): terms at or above GENERALISE."""
    places = stored.select(F.explode("mentions").alias("m")).groupBy("m.entities", "m.near").agg(F.count("*").alias("n"))
    # Equal surroundings are counted together before their terms are taken apart.
    places = materialise(places.select(F.explode("entities").alias("entity"), "near", "n"), "places")
    known = places.groupBy("entity").agg(F.sum("n").alias("n_entity"))
    terms = F.array_distinct(F.regexp_extract_all(F.lower("near"), F.lit(TERM), 0))
    near = places.select("entity", "near", "n", F.explode(terms).alias("term"))
    seen = F.count_distinct(F.xxhash64("near")).alias("support")
    pairs = near.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), seen)
    pairs = materialise(pairs.filter(F.col("support") >= SUPPORT), "pairs")
    if pairs.isEmpty():
        return pairs.select("entity", "term", F.lit(1.0).alias("disclosure"), F.lit(True).alias("removed"))
    text = text_or_empty(text_col)
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)).alias("term"))
    counts = materialise(words.groupBy("term").agg(F.count("*").alias("n_term")), "terms")
    total = docs.agg(F.sum(F.regexp_count(text, F.lit(WORD)))).first()[0] or 1
    information = -F.log(F.col("n_entity") / F.lit(float(total)))

    def part(both: str, all_: str) -> Column:
        given = F.log(F.least(F.col(both) / F.col(all_), F.lit(1.0)))
        return F.when(information > 0, 1 + given / information).otherwise(0.0)

    met = pairs.join(counts, "term").join(known, "entity").withColumn("disclosure", part("n_both", "n_term"))
    met = materialise(met.filter(F.col("disclosure") >= GENERALISE).withColumn("stem", _stem(F.col("term"))), "met")
    # The classes that a term of these would be generalised to.
    stems = met.select("entity", "stem").distinct()
    both = near.select("entity", "n", _stem(F.col("term")).alias("stem")).join(stems, ["entity", "stem"], "left_semi")
    both = both.groupBy("entity", "stem").agg(F.sum("n").alias("stem_both"))
    of_stem = counts.groupBy(_stem(F.col("term")).alias("stem")).agg(F.sum("n_term").alias("stem_all"))
    removed = (F.col("disclosure") >= REMOVE) | (part("stem_both", "stem_all") >= GENERALISE)
    met = met.join(both, ["entity", "stem"]).join(of_stem, "stem")
    return materialise(met.select("entity", "term", "disclosure", removed.alias("removed")), "disclosing")


def _stem(term: Column) -> Column:
    return F.substring(term, 1, STEM)


def all_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, mark, base spans, and term spans.

    The value of a term span is the term; its kind is the number of kinds if it is generalised,
    one more if removed.
    """
    stored = scanned(docs, id_col=id_col, text_col=text_col)
    terms = disclosing(docs, stored, text_col=text_col)
    none = F.array().cast(SPAN)
    if terms.isEmpty():
        return stored.select("id", "mark", "spans", none.alias("terms"))
    named = stored.select("id", "mark", F.explode(F.array_distinct(F.flatten("mentions.entities"))).alias("entity"))
    named = named.distinct().alias("r")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text")).alias("l")
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.mark") == F.col("r.mark"))
    # Of the terms only those that occur in the document, which bounds its pattern.
    texts = materialise(texts.join(named, same, "left_semi"), "mentioning").alias("l")
    own = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), 0))).alias("term")
    tokens = texts.select("id", "mark", own).distinct().join(terms, "term").alias("l")
    tokens = tokens.join(named, same & (F.col("l.entity") == F.col("r.entity")), "left_semi")
    tokens = tokens.groupBy("id", "mark", "term").agg(F.max("removed").alias("removed"))
    tiers = [F.sort_array(F.collect_list(F.when(F.col("removed") == gone, F.col("term")))).alias(name)
             for name, gone in (("general", False), ("gone", True))]
    per_doc = tokens.groupBy("id", "mark").agg(*tiers).alias("r")
    found = texts.join(per_doc, same).select("l.id", "l.mark", "text", "general", "gone")

    def spans(words: str, k: int) -> Column:
        pattern = F.concat(
            F.lit(rf"(?iu)(?<!{INSIDE})(?:"), F.array_join(words, "|"), F.lit(rf")(?!{INSIDE})")
        )
        return F.when(F.size(words) > 0, spans_of(F.col("text"), pattern, k)).otherwise(none)

    both = F.array_sort(F.concat(spans("general", len(KINDS)), spans("gone", len(KINDS) + 1)))
    # Rows that repeat id and text have the same spans.
    found = found.select("id", "mark", both.alias("terms"))
    found = found.groupBy("id", "mark").agg(F.first("terms").alias("terms")).alias("r")
    return stored.alias("l").join(found, same, "left").select(
        "l.id", "l.mark", "l.spans", F.coalesce("terms", none).alias("terms")
    )


def labelled(spans: Column) -> Column:
    """Spans as kind:start:end, by start and kind, joined by commas."""
    names = F.array(*(F.lit(kind.name) for kind in KINDS), F.lit("term"), F.lit("term"))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with [KIND] in place of its spans; overlapping ones are one place.

    Of generalised terms the first letters and a star stay, of removed ones the mark [TERM].
    """
    names = F.array(*(F.lit(f"[{kind.name.upper()}]") for kind in KINDS), F.lit(""), F.lit("[TERM]"))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def put(s: Column) -> Column:
        general = F.concat(_stem(s["value"]), F.lit("*"))
        return F.when(s["k"] == len(KINDS), general).otherwise(F.get(names, s["k"]))

    def step(held: Column, s: Column) -> Column:
        gap = F.substr(text, held["at"] + 1, s["start"] - held["at"])
        out = F.when(s["start"] >= held["at"], F.concat(held["out"], F.array(gap, put(s))))
        return F.struct(out.otherwise(held["out"]).alias("out"), F.greatest(held["at"], s["end"]).alias("at"))

    def finish(held: Column) -> Column:
        rest = F.substr(text, held["at"] + 1, F.length(text))
        return F.array_join(F.concat(held["out"], F.array(rest)), "")

    return F.aggregate(spans, start, step, finish)


def sanitised(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with personal data and disclosing terms masked."""
    found = all_spans(docs, id_col=id_col, text_col=text_col).dropDuplicates(["id", "mark"])
    spans = F.array_sort(F.concat("spans", "terms"))
    names = {k: fresh(docs, f"__{k}") for k in ("id", "mark", "spans")}
    found = found.select("id", "mark", spans.alias("spans")).toDF(*names.values()).alias("r")
    left = docs.withColumns(
        {names["id"]: F.col(id_col).cast("bigint"), names["mark"]: F.xxhash64(text_or_empty(text_col))}
    ).alias("l")
    on = F.col(f"l.{names['id']}").eqNullSafe(F.col(f"r.{names['id']}"))
    met = left.join(found, on & (F.col(f"l.{names['mark']}") == F.col(f"r.{names['mark']}")))
    text = redacted(F.coalesce(F.col(f"l.`{text_col}`").cast("string"), F.lit("")), F.col(names["spans"]))
    return met.select(*(text.alias(c) if c == text_col else F.col(f"l.`{c}`") for c in docs.columns))
