"""Row numbers from keys, so a draw does not depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(
    keys: Sequence[str], buckets: int = 100, *, salt: str = "", portable: bool = False
) -> Column:
    """Bucket 0..buckets-1 of a row, from a hash of its keys.

    The default is Spark's 64-bit hash, which costs next to nothing.  ``portable`` takes the
    first 32 bits of the MD5 of the keys' text, which any SQL engine can repeat but which is
    far slower.  The two give different buckets, and the default also tells key types apart.
    """
    if not portable:
        return F.pmod(F.xxhash64(F.lit(salt), *keys), F.lit(buckets)).cast("int")
    return (_md5_number(keys, salt, 8) % buckets).cast("int")


def in_fraction(
    keys: Sequence[str], fraction: float, *, salt: str = "", portable: bool = False
) -> Column:
    """Whether a row is in the first ``fraction`` of the hash range, for any fraction.

    The hash is compared whole: all its 64 bits, or 60 of the portable one.
    """
    if fraction >= 1.0 or fraction <= 0.0:
        return F.lit(fraction >= 1.0)
    if portable:
        return _md5_number(keys, salt, 15) < F.lit(round(fraction * 2**60))
    return F.xxhash64(F.lit(salt), *keys) < F.lit(round(fraction * 2**64) - 2**63)


def _md5_number(keys: Sequence[str], salt: str, digits: int) -> Column:
    """The first hexadecimal digits of the MD5 of the keys' text, as a number."""
    parts = [F.col(key).cast("string") for key in keys]
    if salt:
        parts.insert(0, F.lit(salt))
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
