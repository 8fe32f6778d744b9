"""Fitting, comparing and tuning tree models."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from itertools import product
from math import sqrt
from multiprocessing.pool import ThreadPool
from statistics import fmean

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import hash_bucket
from .accuracy import METRICS, scores
from .preprocess import FeatureSpec, empty_columns, estimator_pipeline, preprocessing_stages, quoted

# The candidates and grids to compare.
RF_PARAMS = {"maxDepth": 3, "numTrees": 10}
GBT_PARAMS = {"maxDepth": 3, "maxIter": 10}
FULL_GRID = {"maxDepth": [2, 4, 6], "maxIter": [10, 20, 50], "stepSize": [0.05, 0.1, 0.2]}
SMALL_GRID = {"maxDepth": [3, 5], "maxIter": [10, 20], "stepSize": [0.1]}

FOLD, STOP, WEIGHT = "_fold", "_stop", "_weight"

# Searches merge the learning rows of larger tables into cells.  Tree learners cut a column into
# at most so many ranges (their ``maxBins``); columns with few more values are left as they are.
MERGE_FROM = 100_000
BINS = 32


def random_forest(label: str, seed: int | None = None, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, seed=seed, **(RF_PARAMS | params))


def boosted_trees(label: str, seed: int | None = None, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, seed=seed, **params)


def candidates(label: str, seed: int | None = None) -> dict:
    return {
        "random_forest": random_forest(label, seed),
        "gbt": boosted_trees(label, seed, **GBT_PARAMS),
    }


def _gaps(train: DataFrame, spec: FeatureSpec) -> list[str]:
    empty = empty_columns(train, spec)
    if empty:
        warnings.warn(f"no training values in {', '.join(empty)}: filled with 0", stacklevel=3)
    return empty


@contextmanager
def prepared(
    train: DataFrame, spec: FeatureSpec, label: str
) -> Iterator[tuple[PipelineModel, DataFrame]]:
    """Fitted preprocessing and the cached (features, label) rows it gives.

    Whatever is fitted inside shares one preprocessing of the same training rows.
    """
    stages = preprocessing_stages(spec, _gaps(train, spec))
    model = Pipeline(stages=stages).fit(train)
    rows = model.transform(train).select("features", label).persist()
    try:
        yield model, rows
    finally:
        rows.unpersist()


def fit(train: DataFrame, spec: FeatureSpec, estimator) -> PipelineModel:
    """Fit preprocessing and model on the training rows."""
    with prepared(train, spec, estimator.getLabelCol()) as (stages, rows):
        return PipelineModel([*stages.stages, estimator.fit(rows)])


def compare(
    train: DataFrame, test: DataFrame, spec: FeatureSpec, label: str, models: Mapping[str, object]
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit each model and score all on the same test rows.

    Returns the fitted models and a table with one row per model.
    """
    fitted, rows = {}, []
    with prepared(train, spec, label) as (stages, features):
        for name, estimator in models.items():
            fitted[name] = PipelineModel([*stages.stages, estimator.fit(features)])
    for name, model in fitted.items():
        result = scores(model.transform(test), label)
        rows.append((name, *[result[m] for m in METRICS]))
    schema = "model STRING, " + ", ".join(f"{m} DOUBLE" for m in METRICS)
    return fitted, train.sparkSession.createDataFrame(rows, schema)


def grid(estimator, values: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def with_folds(train: DataFrame, keys: Sequence[str], folds: int, seed: int = 2025) -> DataFrame:
    """Adds the fold a row is held out in, by key hash and seed: the same in every run."""
    return train.withColumn(FOLD, hash_bucket(keys, folds, salt=f"fold{seed}"))


def cross_validate(
    train: DataFrame,
    spec: FeatureSpec,
    estimator,
    values: Mapping[str, Sequence],
    label: str,
    *,
    keys: Sequence[str],
    folds: int = 3,
    seed: int = 2025,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """k-fold search for the smallest RMSE with Spark's validator, for any estimator.

    The validator fits the whole pipeline, preprocessing included, once per fold and grid
    point.
    """
    validator = CrossValidator(
        estimator=estimator_pipeline(spec, estimator, _gaps(train, spec)),
        estimatorParamMaps=grid(estimator, values),
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=folds,
        parallelism=parallelism,
        foldCol=FOLD,
    )
    return validator.fit(with_folds(train, keys, folds, seed))


@dataclass(frozen=True)
class Search:
    """Grid points with their RMSE per fold, and the winner fitted on all rows.

    A point that a search by rounds has left out has no RMSE.
    """

    points: list[dict]
    rmse: list[list[float]]
    best: dict
    model: PipelineModel

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per grid point: its parameters, mean RMSE and whether it won."""
        names = sorted(self.best)
        rows = [
            (*[float(point[name]) for name in names], fmean(rmse) if rmse else None, point == self.best)
            for point, rmse in zip(self.points, self.rmse)
        ]
        schema = ", ".join(f"{name} DOUBLE" for name in names) + ", rmse DOUBLE, best BOOLEAN"
        return spark.createDataFrame(rows, schema)


def tune_boosting(
    train: DataFrame,
    spec: FeatureSpec,
    label: str,
    values: Mapping[str, Sequence],
    *,
    keys: Sequence[str],
    folds: int = 3,
    seed: int = 2025,
    parallelism: int = 4,
) -> Search:
    """The k-fold search for boosted trees, with the same results and far fewer fits.

    Preprocessing is fitted once per fold, not once per fold and grid point.  And boosting
    is sequential: the first 10 trees of 50 are the model of 10 iterations, so the longest
    run of each combination gives the errors of all its shorter ones.  Folds and combinations
    run together, on the cells of `Cells`.
    """
    values = dict(values)
    lengths = sorted(values.pop("maxIter"))
    combinations = [dict(zip(values, chosen)) for chosen in product(*values.values())]
    points = [c | {"maxIter": n} for c in combinations for n in lengths]
    rmse: list[list[float]] = [[] for _ in points]
    folded = with_folds(train, keys, folds, seed)

    with ExitStack() as held:
        parts = [held.enter_context(_fold_rows(folded, k, spec, label)) for k in range(folds)]

        def errors(task: tuple[int, int]) -> list[float]:
            fold, number = task
            rows, check, _ = parts[fold]
            longest = _weighted(label, seed, maxIter=lengths[-1], **combinations[number])
            squared = longest.fit(rows).evaluateEachIteration(check, "squared")
            return [sqrt(squared[n - 1]) for n in lengths]

        tasks = list(product(range(folds), range(len(combinations))))
        with ThreadPool(parallelism) as pool:
            run = inheritable_thread_target(train.sparkSession)(errors)
            for (_, number), found in zip(tasks, pool.map(run, tasks, chunksize=1)):
                for place, value in enumerate(found):
                    rmse[number * len(lengths) + place].append(value)

    best = points[min(range(len(points)), key=lambda i: fmean(rmse[i]))]
    return Search(points, rmse, best, _fit_cells(train, spec, label, seed, best))


@dataclass(frozen=True)
class Cells:
    """Preprocessing whose rows can be merged without a change of what a tree learner sees.

    A learner cuts each column into ranges first and then knows of a value only its range.  The
    same is done here over all rows, as a stage of ``stages``: columns of many values become the
    number of their range between quantiles.  Rows with equal features make a cell, of which the
    squared error and the trees depend on the number of labels, their mean and their variance
    only.  A cell is two weighted rows that have these three, or one if all its labels are equal.
    There are so many cells as combinations of ranges at most, however many rows there are.

    Tables of fewer than ``MERGE_FROM`` rows are left as they are, with weight 1.
    """

    stages: PipelineModel
    merges: bool

    @classmethod
    def fit(cls, train: DataFrame, spec: FeatureSpec) -> Cells:
        model = Pipeline(stages=preprocessing_stages(spec, _gaps(train, spec))).fit(train)
        rows = model.transform(train)
        numbers = [name for name in spec.inputs if isinstance(rows.schema[name].dataType, NumericType)]
        if rows.count() < MERGE_FROM:
            return cls(model, False)
        # Splits of a column with few values are between all of them, as the learner has them.
        ranks = [i / BINS for i in range(1, BINS)]
        found = rows.agg(
            F.struct(*(F.approx_count_distinct(quoted(name)).alias(name) for name in numbers)).alias("n"),
            F.struct(*(F.percentile_approx(quoted(name), ranks).alias(name) for name in numbers)).alias("at"),
        ).first()
        cut = {name: sorted(set(found["at"][name])) for name in numbers if found["n"][name] > 2 * BINS}
        if not cut:
            return cls(model, True)
        ends = float("inf")
        ranges = Bucketizer(
            splitsArray=[[-ends, *(x for x in splits if abs(x) < ends), ends] for splits in cut.values()],
            inputCols=list(cut),
            outputCols=[f"{name}_range" for name in cut],
            handleInvalid="error",
        )
        inputs = [f"{name}_range" if name in cut else name for name in spec.inputs]
        assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
        return cls(PipelineModel([*model.stages[:-1], ranges, assembler]), True)

    def rows(self, df: DataFrame, label: str, *keep: str) -> DataFrame:
        """(features, label, the kept columns, weight) of the rows, or of their cells."""
        rows = self.stages.transform(df).select("features", F.col(label).cast("double").alias(label), *keep)
        if not self.merges:
            return rows.withColumn(WEIGHT, F.lit(1.0))
        cells = rows.groupBy("features", *keep).agg(
            F.count("*").alias("n"),
            # A missing label is for the learner to reject.
            F.when(F.count(label) == F.count("*"), F.avg(label)).alias("mean"),
            F.stddev_pop(label).alias("apart"),
        )
        mean, apart, n = F.col("mean"), F.col("apart"), F.col("n").cast("double")
        two = [F.struct(x.alias(label), (n / 2).alias(WEIGHT)) for x in (mean - apart, mean + apart)]
        one = F.array(F.struct(mean.alias(label), n.alias(WEIGHT)))
        # A fit passes over them hundreds of times: as many tasks as cores, not as shuffle partitions.
        cells = cells.coalesce(df.sparkSession.sparkContext.defaultParallelism)
        return cells.select("features", *keep, F.inline(F.when(apart > 0, F.array(*two)).otherwise(one)))


def _weighted(label: str, seed: int | None, **params) -> GBTRegressor:
    return boosted_trees(label, seed, weightCol=WEIGHT, **params)


def _fit_cells(train: DataFrame, spec: FeatureSpec, label: str, seed: int, params: dict) -> PipelineModel:
    """Preprocessing and boosted trees, fitted on the cells of the training rows."""
    cells = Cells.fit(train, spec)
    rows = cells.rows(train, label).persist()
    try:
        return PipelineModel([*cells.stages.stages, _weighted(label, seed, **params).fit(rows)])
    finally:
        rows.unpersist()


@contextmanager
def _fold_rows(
    folded: DataFrame, fold: int, spec: FeatureSpec, label: str, stop: Column | None = None
) -> Iterator[tuple[DataFrame, DataFrame, bool]]:
    """Cached rows to learn from, with the mark of those that tell when to stop; rows held out.

    Preprocessing is fitted on the rows without the mark.  The last value says whether any row
    has it.
    """
    train = folded.filter(F.col(FOLD) != fold)
    marked = train.withColumn(STOP, F.lit(False) if stop is None else stop)
    cells = Cells.fit(train if stop is None else marked.filter(~F.col(STOP)), spec)
    rows = cells.rows(marked, label, STOP).persist()
    check = cells.rows(folded.filter(F.col(FOLD) == fold), label).persist()
    try:
        yield rows, check, stop is not None and not rows.filter(STOP).isEmpty()
    finally:
        rows.unpersist()
        check.unpersist()


def halve_boosting(
    train: DataFrame,
    spec: FeatureSpec,
    label: str,
    values: Mapping[str, Sequence],
    *,
    keys: Sequence[str],
    folds: int = 3,
    seed: int = 2025,
    parallelism: int = 4,
    divisor: int = 3,
    stop_percent: int = 10,
    tolerance: float = 0.01,
) -> Search:
    """The k-fold search for boosted trees by successive halving over the values of ``maxIter``.

    All combinations of the other parameters are grown to the smallest number of trees; of
    these the best 1 / ``divisor`` (rounded up; ties to the earlier one) to the next, and so on.
    A run ends early once the error on ``stop_percent`` percent of its learning rows, chosen by
    key hash, falls by less than ``tolerance`` of itself; the longer points of the combination
    then have the same trees.  Folds and combinations run together.  `tune_boosting` is the
    exact search.
    """
    values = dict(values)
    lengths = sorted(values.pop("maxIter"))
    combinations = [dict(zip(values, chosen)) for chosen in product(*values.values())]
    points = [c | {"maxIter": n} for c in combinations for n in lengths]
    rmse: list[list[float]] = [[] for _ in points]
    trees = [0] * len(points)
    folded = with_folds(train, keys, folds, seed)
    stop = hash_bucket(keys, 100, salt=f"stop{seed}") < stop_percent

    with ExitStack() as held:
        parts = [held.enter_context(_fold_rows(folded, k, spec, label, stop)) for k in range(folds)]

        def errors(task: tuple[int, int, int]) -> tuple[float, int]:
            number, length, fold = task
            rows, check, stops = parts[fold]
            early = {"validationIndicatorCol": STOP, "validationTol": tolerance} if stops else {}
            model = _weighted(label, seed, maxIter=length, **early, **combinations[number]).fit(rows)
            return sqrt(model.evaluateEachIteration(check, "squared")[-1]), model.getNumTrees

        running = list(range(len(combinations)))
        with ThreadPool(parallelism) as pool:
            run = inheritable_thread_target(train.sparkSession)(errors)
            for place, length in enumerate(lengths):
                tasks = [(number, length, fold) for number in running for fold in range(folds)]
                for (number, _, _), (error, grown) in zip(tasks, pool.map(run, tasks, chunksize=1)):
                    at = number * len(lengths) + place
                    rmse[at].append(error)
                    trees[at] = max(trees[at], grown)
                running.sort(key=lambda number: fmean(rmse[number * len(lengths) + place]))
                running = sorted(running[: -(-len(running) // divisor)])

    scored = [i for i, found in enumerate(rmse) if found]
    winner = min(scored, key=lambda i: fmean(rmse[i]))
    grown = points[winner] | {"maxIter": trees[winner]}
    return Search(points, rmse, points[winner], _fit_cells(train, spec, label, seed, grown))
