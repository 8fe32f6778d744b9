"""Model queries.  What a fit gives is not for SQL to say; what must hold of it is."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.enrich import attach
from ..operators.modeling import (
    FULL_GRID,
    GBT_PARAMS,
    SMALL_GRID,
    boosted_trees,
    candidates,
    compare,
    fit,
    halve_boosting,
    tune_boosting,
)
from ..operators.resample import interval_of
from ..plans.train import prepare
from ..settings import ModelSettings
from ..sources.models import load_model, save_model
from ..sources.scratch import materialise, new_folder, use_checkpoints
from ..streaming.scoring import score
from .features import SPEC, model_features, model_frame
from .intervals import feed
from .registry import TOTALS_SQL, entities, query, rounded
from .splits import KEY, share_sql
from .streams import events_stream, stored

LABEL = "total"
MODEL = ModelSettings(label_col=LABEL)


# Key hashes that SQL can repeat, where a query's rows depend on the split.
def parts(spark, sf_dir, *, portable=False):
    use_checkpoints(spark)
    return prepare(model_frame(spark, sf_dir), MODEL, KEY, portable=portable)


def usable(*names):
    """Whether numbers are there and finite."""
    return F.every(
        reduce(and_, (F.coalesce(F.abs(name) < F.lit(float("inf")), F.lit(False)) for name in names))
    )


@query(
    """SELECT unnest(['random_forest', 'gbt']) AS model, true AS finite, true AS beats_the_mean"""
)
def bench_models(spark, sf_dir):
    """Random forest and boosted trees on the same split.

    Their errors depend on the fit: whether they are finite and below those of the mean.
    """
    train, test = parts(spark, sf_dir)
    scores = compare(train, test, SPEC, LABEL, candidates(LABEL, MODEL.seed))[1]
    return scores.groupBy("model").agg(
        usable("rmse", "mae", "r2").alias("finite"), F.every(F.col("r2") > 0).alias("beats_the_mean")
    )


def reported(points, finite, *more):
    """The points of a search, and that the smallest error wins.  What holds of all is asked first."""
    lowest, winners = points.agg(F.min("rmse"), F.count_if("best")).first()
    return points.select(
        "maxDepth",
        "maxIter",
        "stepSize",
        *more,
        finite.alias("finite"),
        F.lit(winners == 1).alias("one_winner"),
        (~F.col("best") | (F.col("rmse") == F.lit(lowest))).alias("best_is_smallest"),
    )


@query(
    f"""SELECT CAST(d AS DOUBLE) AS "maxDepth", CAST(i AS DOUBLE) AS "maxIter",
               CAST(s AS DOUBLE) AS "stepSize", true AS finite, true AS one_winner,
               true AS best_is_smallest
        FROM (SELECT unnest({SMALL_GRID["maxDepth"]}) AS d),
             (SELECT unnest({SMALL_GRID["maxIter"]}) AS i),
             (SELECT unnest({SMALL_GRID["stepSize"]}) AS s)"""
)
def tune_gbt(spark, sf_dir):
    """Three folds over the small grid: its points, and that the smallest error wins."""
    train, _ = parts(spark, sf_dir)
    search = tune_boosting(train, SPEC, LABEL, SMALL_GRID, keys=KEY, folds=3, seed=MODEL.seed)
    return reported(search.report(spark), F.col("rmse") < float("inf"))


@query(
    f"""SELECT CAST(d AS DOUBLE) AS "maxDepth", CAST(i AS DOUBLE) AS "maxIter",
               CAST(s AS DOUBLE) AS "stepSize",
               CASE i WHEN 10 THEN 9 WHEN 20 THEN 3 ELSE 1 END AS n_scored,
               true AS finite, true AS one_winner, true AS best_is_smallest
        FROM (SELECT unnest({FULL_GRID["maxDepth"]}) AS d),
             (SELECT unnest({FULL_GRID["maxIter"]}) AS i),
             (SELECT unnest({FULL_GRID["stepSize"]}) AS s)"""
)
def tune_halving(spark, sf_dir):
    """Three folds over the full grid by halving: its points, how many of a length were scored."""
    train, _ = parts(spark, sf_dir)
    search = halve_boosting(train, SPEC, LABEL, FULL_GRID, keys=KEY, folds=3, seed=MODEL.seed)
    scored = F.count("rmse").over(Window.partitionBy("maxIter")).cast("int").alias("n_scored")
    return reported(search.report(spark), F.col("rmse").isNull() | (F.col("rmse") < float("inf")), scored)


def saved_model(spark, train):
    """Boosted trees, fitted, saved and loaded again."""
    folder = new_folder(spark, "model")
    save_model(fit(train, SPEC, boosted_trees(LABEL, MODEL.seed, **GBT_PARAMS)), folder)
    return load_model(folder)


SPLIT_TEXT = (
    f"'split{MODEL.seed}|' || user_id || '|' || event_type || '|' || CAST(interval_start AS VARCHAR)"
)


@query(
    f"""SELECT user_id, event_type, interval_start, round(total, 4) + 0.0 AS total, true AS finite
        FROM ({TOTALS_SQL}) WHERE NOT {share_sql(SPLIT_TEXT, MODEL.train_ratio)}"""
)
def score_batch(spark, sf_dir):
    """The rows of the test part, each with a usable prediction."""
    train, test = parts(spark, sf_dir, portable=True)
    scored = score(test, saved_model(spark, train), [*KEY, LABEL])
    finite = F.coalesce(F.abs("prediction") < F.lit(float("inf")), F.lit(False))
    return rounded(scored.select(*KEY, LABEL, finite.alias("finite")), total=4)


@query("SELECT event_id, ts, user_id, event_type, true AS as_in_batch FROM events")
def stream_score(spark, sf_dir):
    """Every event scored on the stream by the saved model, as its interval is in a batch.

    The feed's interval means are a table that both sides join; features come from the same
    function.
    """
    train, _ = parts(spark, sf_dir)
    model = saved_model(spark, train)
    means = materialise(feed(spark, sf_dir), "feed")
    events = events_stream(spark, sf_dir)
    events = events.withColumn("interval_start", interval_of(events, "ts"))
    described = attach(events, entities(spark, sf_dir), ["user_id"])
    featured = model_features(attach(described, means, ["site_id", "interval_start"]))
    keep = ["event_id", "ts", "user_id", "event_type", "interval_start"]
    streamed = stored(spark, score(featured, model, keep), "scored")
    batch = score(model_frame(spark, sf_dir), model, KEY)
    met = attach(streamed, batch.withColumnRenamed("prediction", "batch_prediction"), KEY)
    same = F.abs(F.col("prediction") - F.col("batch_prediction")) <= 1e-9 * (
        1 + F.abs("prediction")
    )
    return met.select(
        "event_id", "ts", "user_id", "event_type", F.coalesce(same, F.lit(False)).alias("as_in_batch")
    )
