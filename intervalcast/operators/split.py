"""Samples and train/test splits.

The seeded draws of Spark depend on the order of rows in their partitions.  The hash
variants depend on the key alone: the same row falls on the same side in every run, on
every cluster, and after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import in_fraction
from .outliers import sigma_bounds

def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample without replacement; the whole table for 1.0 and above."""
    if fraction >= 1.0:
        return df
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(
    df: DataFrame,
    keys: Sequence[str],
    fraction: float,
    *,
    salt: str = "",
    portable: bool = False,
) -> DataFrame:
    """Rows whose key hash falls in the first ``fraction`` of the hash range."""
    if fraction >= 1.0:
        return df
    return df.filter(in_fraction(keys, fraction, salt=salt, portable=portable))


def random_split(df: DataFrame, ratio: float, seed: int) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([ratio, 1 - ratio], seed=seed)
    return train, test


def split_label(
    df: DataFrame,
    keys: Sequence[str],
    ratio: float = 0.8,
    *,
    salt: str = "",
    portable: bool = False,
) -> DataFrame:
    """Adds ``part``: ``train`` for the first ``ratio`` of the key hash, else ``test``."""
    in_train = in_fraction(keys, ratio, salt=salt, portable=portable)
    return df.withColumn("part", F.when(in_train, F.lit("train")).otherwise(F.lit("test")))


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    ratio: float = 0.8,
    *,
    salt: str = "",
    portable: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash."""
    in_train = in_fraction(keys, ratio, salt=salt, portable=portable)
    return df.filter(in_train), df.filter(~in_train)


def train_only_filter(labelled: DataFrame, label: str, sigma: float = 3.0) -> DataFrame:
    """Rows of ``split_label`` without the training outliers; test rows all stay.

    The bounds are fitted on the training rows.  They are one row, so they are broadcast,
    and the table is read twice: for the bounds and for the rows.
    """
    bounds = sigma_bounds(labelled.filter(F.col("part") == "train"), label, sigma)
    undefined = F.col("lo").isNull() | F.col("hi").isNull()
    inside = F.col(label).between(F.col("lo"), F.col("hi"))
    kept = labelled.crossJoin(F.broadcast(bounds)).filter(
        (F.col("part") == "test") | undefined | inside
    )
    return kept.drop("lo", "hi")
