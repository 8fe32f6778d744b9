"""Mixing sources to target weights by temperature, in DataFrame operations only.

A source's share of all tokens (words) is raised to an exponent between 1 (proportional) and
0 (uniform) and normalised.  The exponent is bisected: the smallest one whose weights have at
most a target entropy, or repeat no source more often than a limit.  Each job of the search
evaluates the points of the next ``HALVINGS`` halvings, and only their figures reach the
driver.

The weights are realised by block permutations.  The documents of a source are dealt to
blocks of about ``BLOCK`` by a hash; every epoch over the source takes its blocks in an order
of its own until the source's budget is used.  Running sums go over blocks within ``PARTS``
ranges of that order, and over these ranges, never over all documents of a source.

Without a budget the mixture is the smallest that has every document once.  Null counts as
empty text and as the source named "".  A source without any token has weight 0; its
documents stay when every document does.  An empty table gives an empty mixture.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, materialise, text_or_empty

HALVINGS = 6
ROUNDS = 6
DIGITS = 6  # digits of the exponent that are used
BLOCK = 256  # documents in a block, on average
PARTS = 4096  # ranges of an epoch's order


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for; exactly one is given."""

    max_repeat: float | None = None  # most copies of a source, relative to the least copied
    entropy: float | None = None  # in nats


def hashed(*parts: Column | str) -> Column:
    """32 bits of the MD5 of the parts as text, which any engine can repeat."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts).cast("binary")), 1, 8), 16, 10).cast("bigint")


def text_mark(column: str) -> Column:
    digest = F.md5(text_or_empty(column).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def units(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Stored rows of id, text mark, source, tokens; rows that repeat all are one, counted."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        text_mark(text_col).alias("mark"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("bigint").alias("n_tokens"),
    )
    return materialise(rows.groupBy("source", "id", "mark", "n_tokens").agg(F.count("*").alias("n_rows")), "units")


def exponent(sources: DataFrame, target: Target) -> float:
    """The smallest exponent in [0, 1] that meets the target, 1 if none does.

    ``sources`` has the positive shares (column ``share``).
    """
    if (target.max_repeat is None) == (target.entropy is None):
        raise ValueError("give either max_repeat or entropy")
    low, high, first = 0.0, 1.0, True
    for _ in range(ROUNDS):
        cells = 2**HALVINGS
        points = [low + (high - low) * i / cells for i in range(0 if first else 1, cells)]
        raised = sources.withColumn("alpha", F.explode(F.array(*map(F.lit, points))))
        power = F.pow("share", "alpha")
        rate = F.pow("share", F.col("alpha") - 1)
        figures = raised.groupBy("alpha").agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("share")).alias("e"),
            (F.max(rate) / F.min(rate)).alias("repeat"),
        )
        if target.entropy is not None:
            met = F.log("z") - F.col("alpha") * F.col("e") / F.col("z") <= target.entropy
        else:
            met = F.col("repeat") <= target.max_repeat
        best = figures.filter(met).agg(F.min("alpha")).first()[0]
        if first and best == low:
            return low
        below = [p for p in points if best is None or p < best]
        low, high, first = max(below), high if best is None else best, False
    return round(high, DIGITS)


def weights(unit_rows: DataFrame, target: Target, budget: int | None = None) -> DataFrame:
    """Per source: tokens, documents, weight, quota in tokens."""
    totals = materialise(
        unit_rows.groupBy("source").agg(
            F.sum(F.col("n_tokens") * F.col("n_rows")).alias("tokens"), F.sum("n_rows").alias("n_docs")
        ),
        "sources",
    )
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    alpha = exponent(shares.filter("share > 0"), target)
    raised = shares.withColumn("p", F.when(F.col("share") > 0, F.pow("share", F.lit(alpha))).otherwise(0.0))
    z, most = raised.agg(F.sum("p"), F.max(F.when(F.col("p") > 0, F.col("tokens") / F.col("p")))).first()
    # Without a budget: as many tokens as give every source its own once.
    scale = (most or 0.0) if budget is None else budget / (z or 1.0)
    return raised.select(
        "source",
        "tokens",
        "n_docs",
        F.lit(alpha).alias("alpha"),
        (F.col("p") / F.lit(z or 1.0)).alias("weight"),
        F.round(F.col("p") * F.lit(scale)).cast("bigint").alias("quota"),
    )


def mixture(
    docs: DataFrame,
    target: Target,
    *,
    budget: int | None = None,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """A row per document and epoch that takes it.

    ``start`` counts the source's tokens before it, ``mix_at`` is that as a part of the
    quota: sorted by it, all sources run out together.  ``n_rows`` rows repeat id and text.
    """
    rows = units(docs, id_col, text_col, source_col)
    sources = materialise(weights(rows, target, budget), "weights")
    whole = budget is None
    # Dealing to blocks needs the number of documents of the source.
    blocks_of = F.ceil(F.col("n_docs") / F.lit(BLOCK)).cast("bigint")
    dealt = rows.withColumn("h", hashed(seed, F.col("id"), F.col("mark"))).join(
        sources.select("source", blocks_of.alias("n_blocks")), "source"
    )
    dealt = dealt.withColumn("block", F.shiftright(F.col("h") * F.col("n_blocks"), 32)).drop("n_blocks")
    size = F.col("n_tokens") * F.col("n_rows")
    in_block = Window.partitionBy("source", "block").orderBy("h", "id", "mark")
    before = F.sum(size).over(in_block.rowsBetween(Window.unboundedPreceding, -1))
    dealt = materialise(dealt.withColumn("inside", F.coalesce(before, F.lit(0))), "dealt")

    blocks = dealt.groupBy("source", "block").agg(F.sum(size).alias("size")).join(sources, "source")
    epochs = F.greatest(F.ceil(F.col("quota") / F.greatest("tokens", F.lit(1))), F.lit(1)).cast("int")
    turns = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    turns = turns.withColumn("turn", hashed(seed, F.col("epoch"), F.col("source"), F.col("block")))
    turns = turns.withColumn("part", F.floor(F.col("turn") / F.lit(2**32 // PARTS)))
    parts = turns.groupBy("source", "epoch", "part").agg(F.sum("size").alias("part_size"))
    over_parts = Window.partitionBy("source", "epoch").orderBy("part")
    over_parts = over_parts.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(over_parts), F.lit(0)))
    over_turns = Window.partitionBy("source", "epoch", "part").orderBy("turn", "block")
    over_turns = over_turns.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("size").over(over_turns), F.lit(0))
    turns = turns.withColumn("block_start", inside).join(parts.drop("part_size"), ["source", "epoch", "part"])
    begins = F.col("epoch") * F.col("tokens") + F.col("part_start") + F.col("block_start")
    turns = turns.withColumn("block_start", begins)
    every = (F.col("epoch") == 0) & F.lit(whole)
    turns = turns.filter((F.col("block_start") < F.col("quota")) | every)

    taken = dealt.join(
        turns.select("source", "block", "epoch", "block_start", "weight", "quota"), ["source", "block"]
    ).withColumn("start", F.col("block_start") + F.col("inside"))
    taken = taken.filter((F.col("start") < F.col("quota")) | every)
    return taken.select(
        F.col("id").alias(id_col),
        "mark",
        "source",
        F.round("weight", 9).alias("weight"),
        "quota",
        "epoch",
        "block",
        "n_tokens",
        "n_rows",
        "start",
        F.round(F.col("start") / F.greatest("quota", F.lit(1)), 9).alias("mix_at"),
    )


def mixed(docs: DataFrame, target: Target, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, each as often as the mixture takes it."""
    taken = mixture(docs, target, id_col=id_col, text_col=text_col, **options)
    names = {k: fresh(docs, f"__{k}") for k in ("id", "mark", "copies")}
    copies = taken.groupBy(id_col, "mark").agg(F.count("*").cast("int").alias("copies"))
    copies = copies.toDF(*(names[k] for k in ("id", "mark", "copies"))).alias("r")
    left = docs.withColumns({names["id"]: F.col(id_col).cast("bigint"), names["mark"]: text_mark(text_col)})
    left = left.alias("l")
    on = [F.col(f"l.{names[k]}").eqNullSafe(F.col(f"r.{names[k]}")) for k in ("id", "mark")]
    met = left.join(copies, on)
    again = F.explode(F.sequence(F.lit(1), F.col(f"r.{names['copies']}")))
    return met.select(*(F.col(f"l.`{c}`") for c in docs.columns), again.alias(names["copies"])).drop(names["copies"])
