"""Batch training: frame, split, outlier bounds, comparison, tuning, saved pipeline."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.accuracy import scores
from ..operators.modeling import FULL_GRID, Search, candidates, compare, tune_boosting
from ..operators.outliers import bounds_on_driver, range_filter, sigma_bounds
from ..operators.split import hash_sample, split_label
from ..settings import ModelSettings, Settings
from ..sources.models import save_model
from ..sources.scratch import materialise, use_checkpoints
from . import domain


@dataclass(frozen=True)
class Training:
    """What a training run leaves behind."""

    benchmark: DataFrame
    search: Search
    model: PipelineModel
    scores: dict[str, float]


def prepare(
    frame: DataFrame,
    model: ModelSettings,
    keys: Sequence[str] = domain.GRAIN,
    *,
    portable: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) from the frame.

    Sample and split follow the rows' keys and the seed, so they are the same in every run.  Outlier
    bounds are fitted on the training rows and applied to those only.  The parts are
    written out first, in a folder each: tens of fits read them, and none should repeat the
    resampling, the joins and the split.
    """
    sampled = hash_sample(
        frame, keys, model.sample_fraction, salt=f"sample{model.seed}", portable=portable
    )
    labelled = split_label(
        sampled, keys, model.train_ratio, salt=f"split{model.seed}", portable=portable
    )
    stored = materialise(labelled, "frame", partition_by=["part"])
    train, test = (stored.filter(F.col("part") == part).drop("part") for part in ("train", "test"))
    lo, hi = bounds_on_driver(sigma_bounds(train, model.label_col, model.outlier_sigma))
    return range_filter(train, model.label_col, lo, hi), test


def train_on(
    frame: DataFrame,
    settings: Settings,
    *,
    spec=domain.FEATURES,
    keys: Sequence[str] = domain.GRAIN,
    grid: Mapping[str, Sequence] = FULL_GRID,
    tune: Callable[..., Search] = tune_boosting,
) -> Training:
    """Compare the candidates, tune boosted trees, save and score the winner.

    ``tune`` is the exact search or `halve_boosting`.
    """
    model = settings.model
    use_checkpoints(frame.sparkSession)
    train, test = prepare(frame, model, keys)
    _, benchmark = compare(
        train, test, spec, model.label_col, candidates(model.label_col, model.seed)
    )
    search = tune(
        train, spec, model.label_col, grid, keys=keys, folds=model.cv_folds, seed=model.seed
    )
    best = search.model
    save_model(best, settings.paths.model)
    return Training(benchmark, search, best, scores(best.transform(test), model.label_col))


def train(spark: SparkSession, settings: Settings, **options) -> dict[str, float]:
    """The whole job on the CSV inputs; returns the winner's test scores."""
    return train_on(domain.build_training_frame(spark, settings), settings, **options).scores
