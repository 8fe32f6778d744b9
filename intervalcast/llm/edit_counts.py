"""Token counts that follow edits, without encoding a text again.

A text's pre-tokens are grouped into leaves that end where the pattern always ends a match.
A tree over the leaves holds the characters and tokens below each node.  An edit finds its
leaves by the character sums; edits of the same leaves are made together.  If an edit leaves a
border that is no longer a sure end of a match, the next leaf belongs to the region too.  Only
the region is encoded again, and the sums above its leaves are corrected.

Edits name places of the text as it was, end exclusive, and do not overlap; those beyond the
end are clipped to it, and a null list is none.  Null text counts as empty.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import RANK_FILE, SAFE, encoding, pieces
from .common import appended, fresh

LEAF = 512  # characters of a leaf, about

Edit = tuple[int, int, str]


class Sums:
    """Sums over leaves in a complete binary tree."""

    def __init__(self, values: Sequence[int]):
        self.width = 1 << max(len(values) - 1, 0).bit_length()
        self.nodes = [0] * (2 * self.width)
        self.nodes[self.width : self.width + len(values)] = values
        for i in range(self.width - 1, 0, -1):
            self.nodes[i] = self.nodes[2 * i] + self.nodes[2 * i + 1]

    def total(self) -> int:
        return self.nodes[1]

    def change(self, leaf: int, value: int) -> None:
        i = leaf + self.width
        more = value - self.nodes[i]
        while i:
            self.nodes[i] += more
            i //= 2

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place, and where the leaf starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if place >= start + self.nodes[i] and self.nodes[i + 1]:
                start += self.nodes[i]
                i += 1
        return i - self.width, start


class Counted:
    """A text with the tokens of its leaves."""

    def __init__(self, text: str, encoder: tiktoken.Encoding):
        self.encoder = encoder
        self.leaves = list(pieces(text, LEAF))
        self.chars = Sums([len(x) for x in self.leaves])
        self.tokens = Sums([self._count(x) for x in self.leaves])
        self.encoded = 0  # characters encoded again

    def _count(self, text: str) -> int:
        return len(self.encoder.encode_ordinary(text))

    def _joined(self, left: str, right: str) -> bool:
        """Whether a match may go over the border of two texts."""
        return SAFE.match(left[-1:] + right[:1], 1) is None

    def edit(self, edits: Sequence[Edit]) -> None:
        """All edits, places as in the text before any of them."""
        length = self.chars.total()
        regions: list[tuple[int, int, int, list[Edit]]] = []
        for start, end, text in sorted((min(a, length), min(max(a, b), length), t) for a, b, t in edits):
            first, at = self.chars.find(start)
            last, _ = self.chars.find(max(start, end - 1))
            if regions and first <= regions[-1][1]:
                begun, until, place, own = regions.pop()
                regions.append((begun, max(until, last), place, [*own, (start, end, text)]))
            else:
                regions.append((first, last, at, [(start, end, text)]))
        # From the end, so that places before an edit stay as they are.
        for first, last, at, own in reversed(regions):
            old = "".join(self.leaves[first : last + 1])
            parts, done = [], 0
            for start, end, text in own:
                parts += [old[done : start - at], text]
                done = end - at
            self._replace(first, last, "".join([*parts, old[done:]]))

    def _replace(self, first: int, last: int, text: str) -> None:
        """New text for a range of leaves, with leaves around it that it may join."""
        left, right = first - 1, last + 1
        while left >= 0 and (not self.leaves[left] or not text or self._joined(self.leaves[left], text)):
            text = self.leaves[left] + text
            left -= 1
        while right < len(self.leaves) and (not self.leaves[right] or not text or self._joined(text, self.leaves[right])):
            text += self.leaves[right]
            right += 1
        for leaf in range(left + 1, right):
            now = text if leaf == left + 1 else ""
            self.leaves[leaf] = now
            self.chars.change(leaf, len(now))
            self.tokens.change(leaf, self._count(now) if now else 0)
        self.encoded += len(text)

    def text(self) -> str:
        return "".join(self.leaves)


def recounted(
    docs: DataFrame,
    edits: str | Callable[[str], list[Edit]] = "edits",
    *,
    text_col: str = "text",
    rank_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The rows with tokens before and after their edits, and what was encoded again.

    Edits are a column of arrays of (start, end, text), or what a function finds in a text.
    """
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def counts(rows: list[tuple[str, list[Edit]]]) -> list:
        encoder, _ = encoding(path, pattern)
        out = []
        for text, own in rows:
            counted = Counted(text, encoder)
            before = counted.tokens.total()
            counted.edit(own)
            out.append((before, len(own), counted.tokens.total(), counted.chars.total(), counted.encoded))
        return list(zip(*out, strict=True)) or [[]] * 5

    def found(texts: list[str | None]) -> list:
        return counts([(text or "", edits(text or "")) for text in texts])

    def given(rows: list[dict]) -> list:
        own = [[(e["start"], e["end"], e["text"] or "") for e in row["edits"] or () if e is not None] for row in rows]
        return counts([(row["text"] or "", x) for row, x in zip(rows, own, strict=True)])

    names = ["n_tokens_before", "n_edits", "n_tokens", "n_chars_after", "n_chars_encoded"]
    fields = [T.StructField(name, T.LongType()) for name in names]
    if callable(edits):
        return appended(docs, fields, text_col, found)
    both = fresh(docs, "__both")
    pair = F.struct(F.col(text_col).cast("string").alias("text"), F.col(edits).alias("edits"))
    return appended(docs.withColumn(both, pair), fields, both, given).drop(both)


# What the query edits: long numbers, repeated exclamation marks, runs of blanks.
CLEANED = re.compile(r"[0-9]{4,}|!{2,}|[ \t]{2,}")


def cleaning_edits(text: str) -> list[Edit]:
    """Edits that shorten what CLEANED matches to its first character."""
    return [(match.start(), match.end(), match[0][0]) for match in CLEANED.finditer(text)]
