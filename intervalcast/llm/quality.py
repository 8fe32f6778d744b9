"""Quality rules: a decision list learned from labelled statistics, applied as an expression.

Statistics come from whole texts.  Sequential covering learns the list: a rule for bad
documents grows by the threshold condition with the largest gain on the growing rows, loses
conditions while that helps on the pruning rows, is kept if it is precise there, and the rows
it covers are set aside before the next.  The list becomes one ordered conditional expression.

Fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of their id; rows
without a label, and the fifth that is held out, are not used.  Without both kinds of labels
the list is empty and keeps all.  Null counts as a text without words.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import appended, crc_of

SAMPLE = 20_000
HELD_OUT = 5
CUTS = 48  # thresholds tried for a statistic
CONDITIONS = 4  # most conditions of a rule
RULES = 24  # most rules of a list
PRECISION = 0.9  # least share of bad rows among those a rule covers
SUPPORT = 3  # least bad rows a rule covers

SYMBOLS = "#*$%&|<>"
COUNTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_marks",
]


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    text = text or ""
    data = text.encode()
    words = data.split()
    if not words:
        return (0,) * len(COUNTS)
    lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
    index: dict[bytes, int] = {}
    codes = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    ascii_counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    spaces = int(ascii_counts[[9, 10, 11, 12, 13, 32]].sum())
    return (
        len(words),
        len(text) - spaces,
        int(ascii_counts[list(SYMBOLS.encode())].sum()),
        len(lines),
        len(lines) - len(set(lines)),
        repeated(codes, len(index)),
        len(index),
        int(ascii_counts[65:91].sum()),
        int(ascii_counts[48:58].sum()),
        int(ascii_counts[[33, 63]].sum()),
    )


def repeated(codes: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(codes) < 3:
        return 0
    _, pairs = np.unique(codes[:-2] * distinct + codes[1:-1], return_inverse=True)
    _, which, times = np.unique(pairs * distinct + codes[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(codes), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def statistics(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows with the counts of their texts."""

    def compute(texts: list[str | None]) -> list:
        return list(zip(*map(counts_of, texts), strict=True)) or [[]] * len(COUNTS)

    return appended(docs, [T.StructField(name, T.LongType()) for name in COUNTS], text_col, compute)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def features() -> dict[str, Column]:
    """What rules put thresholds on."""
    return {
        "words": F.col("n_words").cast("double"),
        "chars_per_word": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "word_chars"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "distinct": _share("n_distinct", "n_words"),
        "upper": _share("n_upper", "word_chars"),
        "digits": _share("n_digits", "word_chars"),
        "marks": _share("n_marks", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        value = values[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(values) for c in rule), np.ones(n, dtype=bool))


def _grown(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Conditions with the largest gain in information about bad rows, until all are bad."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < CONDITIONS and bad[inside].any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, best_gain = None, 1e-9
        for name, column in values.items():
            value = column[inside]
            steps = np.unique(value)
            middle = (steps[:-1] + steps[1:]) / 2
            if len(middle) > CUTS:
                middle = middle[np.linspace(0, len(middle) - 1, CUTS).astype(int)]
            if not len(middle):
                continue
            for above in (True, False):
                cut = value[:, None] > middle if above else value[:, None] <= middle
                p = (cut & bad[inside][:, None]).sum(axis=0)
                n = cut.sum(axis=0) - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = p * (np.log(p / (p + n)) - np.log(p0 / (p0 + n0)))
                gain = np.where(p > 0, gain, -np.inf)
                at = int(gain.argmax())
                if gain[at] > best_gain:
                    best, best_gain = Condition(name, above, float(middle[at])), gain[at]
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(values)
    return tuple(rule)


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    met = _covered(rule, values, len(bad))
    p, n = int(bad[met].sum()), int((~bad[met]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def _pruned(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Without its last conditions, as long as that is no worse on the pruning rows."""
    while len(rule) > 1 and _worth(rule[:-1], values, bad) >= _worth(rule, values, bad):
        rule = rule[:-1]
    return rule


def decision_list(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Rules for bad rows in order, learned by sequential covering."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    part = np.arange(len(bad)) % 3 == 2  # every third row prunes
    while len(rules) < RULES:
        grow, prune = left & ~part, left & part
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _grown({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        rule = _pruned(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        met = _covered(rule, values, len(bad)) & left
        hits = int((bad & met).sum())
        if hits < SUPPORT or hits < PRECISION * met.sum():
            break
        rules.append(rule)
        left &= ~met
    return rules


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """The list learned from the labelled documents (``quality`` 1 good, 0 bad)."""
    known = labels.filter(F.col("quality").isNotNull() & (crc_of(id_col) % HELD_OUT != 0))
    known = known.select(F.col(id_col).cast("bigint").alias("id"), F.col("quality").cast("int").alias("quality"))
    known = known.distinct().orderBy(F.xxhash64("id"), "id", "quality").limit(SAMPLE)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    # At most SAMPLE rows of two numbers are broadcast.
    rows = statistics(texts.join(F.broadcast(known), "id")).select(
        "id", "quality", *(column.alias(name) for name, column in features().items())
    )
    rows = rows.orderBy(F.xxhash64("id"), *rows.columns).limit(SAMPLE).toPandas()
    bad = (rows["quality"] == 0).to_numpy(dtype=bool)
    return decision_list({name: rows[name].to_numpy(dtype=float) for name in features()}, bad)


def fired(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    cases = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        met = reduce(lambda a, b: a & b, (c.column() for c in rule))
        cases = F.when(met, F.lit(i)).otherwise(cases)
    return cases


def base_failed() -> Column:
    few = F.col("n_words") < 50
    return few | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, rules: Sequence[Rule], *, text_col: str = "text") -> DataFrame:
    """The rows with counts, ``base_failed``, ``rule`` and ``kept``."""
    rows = statistics(docs, text_col=text_col).withColumns({"base_failed": base_failed(), "rule": fired(rules)})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
