"""Left joins with dimensions, and fan-out over categories.

No join here carries a broadcast hint: the sides come from data and have no size that
could be relied on.  Spark broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold``, at planning time or, with AQE, after the side
was shuffled; above it the join is a shuffle join whose hot partitions AQE splits, or
``spread`` where AQE does not run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SALT = "_salt"


def attach(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    *,
    matched: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """Left equi-join on same-named keys; all facts stay.

    Runs on a static or a streaming left side.  ``matched`` names a flag that tells
    facts with a partner from those without.  Plans with state run without AQE: there
    ``spread`` deals the facts of a key to that many tasks, each with a copy of the
    dimension's row.
    """
    if spread > 1:
        plain = [f.name for f in facts.schema if f.dataType.typeName() not in {"map", "variant"}]
        facts = facts.withColumn(SALT, F.pmod(F.xxhash64(*plain), F.lit(spread)).cast("int"))
        copies = F.explode(F.array(*map(F.lit, range(spread))))
        copied = dimension.withColumn(SALT, copies)
        return attach(facts, copied, [*on, SALT], matched=matched).drop(SALT)
    if matched is None:
        return facts.join(dimension, list(on), "left")
    joined = facts.join(dimension.withColumn(matched, F.lit(True)), list(on), "left")
    return joined.withColumn(matched, F.coalesce(matched, F.lit(False)))


def fan_out(df: DataFrame, name: str, categories: Sequence) -> DataFrame:
    """Each row once per category: a cross join with a literal list, without a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(value) for value in categories])))


def categories_table(df: DataFrame, name: str, categories: Sequence) -> DataFrame:
    """The literal list as a table, in the session of ``df``."""
    return df.sparkSession.createDataFrame([(value,) for value in categories], [name])


def fan_out_by(
    df: DataFrame, owned: DataFrame, on: Sequence[str], *, category: str
) -> DataFrame:
    """Each row once per category its key really has, in place of all categories.

    A key that ``owned`` does not list keeps one row with a null category.
    """
    pairs = owned.select(*on, category).distinct()
    return df.join(pairs, list(on), "left")
