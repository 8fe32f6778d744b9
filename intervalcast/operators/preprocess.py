"""Learned preprocessing as pipeline stages: they are fitted and saved with the model.

Stage order: numbers to double, mean imputation, angle encoding on imputed values,
category index, one-hot vector, assembly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null

FILLED = "_filled"
ENCODED = "_ohe"


@dataclass(frozen=True)
class FeatureSpec:
    """What goes into the feature vector.

    ``numeric``: columns with gaps, filled with their training mean.  ``angles``: degrees,
    result prefix -> column, filled and then encoded.  ``categorical``: indexed by
    frequency and one-hot encoded, with a place of its own for null and unseen values.
    ``order``: the vector's inputs in terms of these names, angle parts as
    ``<prefix>_sin`` and ``<prefix>_cos``; anything else is taken as it is.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    order: tuple[str, ...]
    angles: tuple[tuple[str, str], ...] = ()
    missing_flags: bool = False

    @property
    def gappy(self) -> list[str]:
        return [*self.numeric, *(column for _, column in self.angles)]

    @property
    def inputs(self) -> list[str]:
        def source(name: str) -> str:
            if name in self.numeric:
                return name + FILLED
            return name + ENCODED if name in self.categorical else name

        flags = [f"{name}_missing" for name in self.gappy] if self.missing_flags else []
        return [source(name) for name in self.order] + flags


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _select(*extra: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {', '.join(extra)} FROM __THIS__")


def empty_columns(train: DataFrame, spec: FeatureSpec) -> list[str]:
    """Columns without a single value in the training rows; no mean can fill them."""
    present = train.agg(
        *[F.count(nan_to_null(F.col(n).cast("double"))).alias(n) for n in spec.gappy]
    ).first()
    return [name for name in spec.gappy if present[name] == 0]


def preprocessing_stages(spec: FeatureSpec, empty: Sequence[str] = ()) -> list:
    """The stages for ``spec``; columns in ``empty`` are filled with 0."""
    known = [name for name in spec.gappy if name not in empty]
    # The imputer would cut the mean of an integer column, so it only sees doubles.
    casts = [f"CAST({quoted(n)} AS DOUBLE) AS {quoted(n + '_raw')}" for n in known]
    casts += [f"DOUBLE(0) AS {quoted(n + FILLED)}" for n in empty]
    if spec.missing_flags:
        casts += [f"DOUBLE({quoted(n)} IS NULL) AS {quoted(n + '_missing')}" for n in spec.gappy]

    stages: list = [_select(*casts)] if casts else []
    if known:
        stages.append(
            Imputer(
                inputCols=[n + "_raw" for n in known],
                outputCols=[n + FILLED for n in known],
                strategy="mean",
            )
        )
    turns = []
    for prefix, column in spec.angles:
        angle = f"RADIANS({quoted(column + FILLED)})"
        turns += [f"SIN({angle}) AS {prefix}_sin", f"COS({angle}) AS {prefix}_cos"]
    if turns:
        stages.append(_select(*turns))
    if spec.categorical:
        index = [f"{name}_idx" for name in spec.categorical]
        vectors = [name + ENCODED for name in spec.categorical]
        stages.append(
            StringIndexer(inputCols=list(spec.categorical), outputCols=index, handleInvalid="keep")
        )
        stages.append(OneHotEncoder(inputCols=index, outputCols=vectors, handleInvalid="keep"))
    stages.append(
        VectorAssembler(inputCols=spec.inputs, outputCol="features", handleInvalid="keep")
    )
    return stages


def estimator_pipeline(spec: FeatureSpec, estimator, empty: Sequence[str] = ()) -> Pipeline:
    return Pipeline(stages=[*preprocessing_stages(spec, empty), estimator])


def impute_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill gaps of a joined table with the columns' own means, in place.

    One lazy plan: the means are a single row, and both uses of ``df`` share its shuffles.
    """
    doubles = df.withColumns({name: F.col(name).cast("double") for name in columns})
    means = doubles.agg(*[F.avg(_number(name)).alias(f"_mean_{name}") for name in columns])
    filled = {name: F.coalesce(_number(name), F.col(f"_mean_{name}")) for name in columns}
    joined = doubles.crossJoin(F.broadcast(means)).withColumns(filled)
    return joined.drop(*means.columns)


def _number(name: str) -> Column:
    return nan_to_null(F.col(name))
