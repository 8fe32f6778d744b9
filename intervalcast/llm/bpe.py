"""Byte-level BPE with a local rank file: ids of whole texts, and the bytes of ids.

Texts longer than ``CHUNK`` characters are cut where the pattern always ends a match, so the
pieces give the ids of the whole: between a visible character and white space, between
letters and digits, and after a letter before punctuation.  A text without such a place
stays whole.  Ids are kept as little-endian unsigned 32-bit integers, decoding looks up the
raw bytes of each id, so what comes back is exact even where a character is split.

Null counts as empty: no ids, no bytes.  Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import appended

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
CHUNK = 20_000

LETTER = r"A-Za-zЀ-ӿ぀-ヿ一-鿿가-힣"
SAFE = regex.compile(
    rf"(?<=[^\s])(?=[ \n\t])|(?<=[{LETTER}])(?=[0-9.,;:!?、。])|(?<=[0-9])(?=[{LETTER}])"
)


@lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The encoder, and the bytes of every id; read once per worker."""
    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    table = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    own = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return own, table


def pieces(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe places only."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None or cut.start() >= len(text):
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def ids_of(text: str | None, encoder: tiktoken.Encoding) -> list[int]:
    ids: list[int] = []
    for piece in pieces(text or ""):
        ids += encoder.encode_ordinary(piece)
    return ids


def encode(
    docs: DataFrame,
    *,
    text_col: str = "text",
    rank_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The rows with ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32 bits).

    ``rank_path`` must name the file on every executor.
    """
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def compute(texts: list[str | None]) -> list:
        encoder, _ = encoding(path, pattern)
        ids = [np.array(ids_of(text, encoder), dtype="<u4") for text in texts]
        return [[len(x) for x in ids], [x.tobytes() for x in ids]]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return appended(docs, fields, text_col, compute)


def decode(
    encoded: DataFrame,
    *,
    ids_col: str = "ids",
    rank_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The rows with ``decoded``: the raw bytes of their ids.  Null ids give no bytes."""
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def compute(blobs: list[bytes | None]) -> list:
        _, table = encoding(path, pattern)
        return [
            [b"".join(map(table.__getitem__, np.frombuffer(b or b"", dtype="<u4").tolist())) for b in blobs]
        ]

    return appended(encoded, [T.StructField("decoded", T.BinaryType())], ids_col, compute)
