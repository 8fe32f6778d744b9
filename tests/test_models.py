"""Preprocessing, fits and searches."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from intervalcast.operators import modeling
from intervalcast.operators.accuracy import scores
from intervalcast.operators.preprocess import FeatureSpec, empty_columns, preprocessing_stages
from intervalcast.sources.models import load_model, save_model

SPEC = FeatureSpec(
    numeric=("size", "floors"),
    angles=(("wind", "direction"),),
    categorical=("use",),
    order=("size", "floors", "wind_sin", "wind_cos", "use"),
)


@pytest.fixture(scope="module")
def frame(spark):
    """600 rows whose label follows size and use, with gaps in every numeric column."""
    k = F.col("id")
    df = spark.range(600).select(
        k,
        F.when(k % 11 != 0, (k % 50).cast("double")).alias("size"),
        F.when(k % 7 != 0, (k % 4).cast("int")).alias("floors"),
        F.when(k % 13 != 0, (k * 37 % 360).cast("double")).alias("direction"),
        F.element_at(F.array(*map(F.lit, ["school", "office", "shop"])), (k % 3 + 1).cast("int")).alias("use"),
        ((k % 50) * 2 + (k % 3) * 30 + (k * 7919 % 10)).cast("double").alias("label"),
    )
    return df.cache()


def test_vector_layout_and_values(spark, frame):
    model = Pipeline(stages=preprocessing_stages(SPEC)).fit(frame)
    extra = frame.limit(1).withColumns({"use": F.lit("castle"), "floors": F.lit(None).cast("int")})
    known = model.transform(frame.filter("id = 1")).first()
    unseen = model.transform(extra).first()
    assert len(known["features"]) == 4 + 4
    # Index order is by frequency, then by name; the last place is for unseen values.
    assert list(known["features"])[4:] == [1.0, 0.0, 0.0, 0.0]
    assert list(unseen["features"])[4:] == [0.0, 0.0, 0.0, 1.0]
    # The mean of an integer column is not cut.
    mean = frame.agg(F.avg("floors")).first()[0]
    assert unseen["features"][1] == pytest.approx(mean) and mean != int(mean)


def test_angles_are_encoded_after_imputation(frame):
    model = Pipeline(stages=preprocessing_stages(SPEC)).fit(frame)
    rows = model.transform(frame.filter("direction IS NULL")).collect()
    mean = frame.agg(F.avg("direction")).first()[0]
    assert rows and all(r["wind_sin"] == pytest.approx(math.sin(math.radians(mean))) for r in rows)


def test_missing_flags(frame):
    from dataclasses import replace

    flagged = replace(SPEC, missing_flags=True)
    model = Pipeline(stages=preprocessing_stages(flagged)).fit(frame)
    row = model.transform(frame.filter("id = 77")).first()
    assert list(row["features"])[-3:] == [1.0, 1.0, 0.0] and len(row["features"]) == 11


def test_empty_column_is_filled_with_zero(frame):
    bare = frame.withColumn("size", F.lit(None).cast("double"))
    assert empty_columns(bare, SPEC) == ["size"]
    with pytest.warns(UserWarning, match="size"):
        model = modeling.fit(bare, SPEC, GBTRegressor(labelCol="label", maxIter=2, maxDepth=2))
    assert model.transform(frame.limit(5)).filter("prediction IS NULL").count() == 0


def test_candidates_beat_the_mean_and_survive_saving(spark, frame, tmp_path):
    train, test = frame.filter("id % 5 <> 0"), frame.filter("id % 5 = 0")
    fitted, table = modeling.compare(train, test, SPEC, "label", modeling.candidates("label", 1))
    rows = {r["model"]: r for r in table.collect()}
    mean = train.agg(F.avg("label")).first()[0]
    naive = scores(test.withColumn("prediction", F.lit(mean)), "label")
    assert set(rows) == {"random_forest", "gbt"}
    assert all(row["rmse"] < naive["rmse"] for row in rows.values())
    save_model(fitted["gbt"], str(tmp_path / "m"))
    save_model(fitted["gbt"], str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m")).transform(test)
    both = again.select("id", F.col("prediction").alias("p")).join(fitted["gbt"].transform(test), "id")
    assert both.filter("p <> prediction").count() == 0


def test_short_search_equals_the_validator(spark, frame):
    grid = {"maxDepth": [2, 3], "maxIter": [2, 4], "stepSize": [0.1]}
    search = modeling.tune_boosting(frame, SPEC, "label", grid, keys=["id"], folds=2, seed=5)
    validated = modeling.cross_validate(
        frame, SPEC, modeling.boosted_trees("label", 5), grid, "label", keys=["id"], folds=2, seed=5
    )
    theirs = {
        tuple(sorted((p.name, v) for p, v in point.items())): rmse
        for point, rmse in zip(validated.getEstimatorParamMaps(), validated.avgMetrics)
    }
    ours = {tuple(sorted(p.items())): sum(r) / len(r) for p, r in zip(search.points, search.rmse)}
    assert ours == pytest.approx(theirs)
    report = search.report(spark).collect()
    assert len(report) == 4 and sum(r["best"] for r in report) == 1
    assert validated.bestModel.stages[-1].getNumTrees == search.best["maxIter"]


def test_halving_scores_the_points_it_reaches(spark, frame):
    grid = {"maxDepth": [1, 2, 3], "maxIter": [1, 2, 4], "stepSize": [0.3]}
    exact = {"stop_percent": 0, "divisor": 1}
    options = {"keys": ["id"], "folds": 2, "seed": 5}
    whole = modeling.tune_boosting(frame, SPEC, "label", grid, **options)
    # Nothing left out and no early end: the exact search.
    same = modeling.halve_boosting(frame, SPEC, "label", grid, **options, **exact)
    assert same.points == whole.points and same.best == whole.best
    assert [pytest.approx(r) for r in whole.rmse] == same.rmse

    halved = modeling.halve_boosting(frame, SPEC, "label", grid, **options, stop_percent=0, divisor=2)
    reached = {n: [i for i, p in enumerate(halved.points) if p["maxIter"] == n and halved.rmse[i]] for n in (1, 2, 4)}
    assert [len(reached[n]) for n in (1, 2, 4)] == [3, 2, 1]
    for short, long in ((1, 2), (2, 4)):
        # Those grown on are the best of the round before.
        ranked = sorted(reached[short], key=lambda i: sum(whole.rmse[i]))
        assert {i + 1 for i in ranked[: len(reached[long])]} == set(reached[long])
    assert all(halved.rmse[i] == pytest.approx(whole.rmse[i]) for n in reached for i in reached[n])
    report = halved.report(spark).collect()
    assert len(report) == 9 and sum(r["best"] for r in report) == 1
    assert sum(r["rmse"] is not None for r in report) == 6


def test_runs_of_a_search_end_early(frame):
    flat = frame.withColumn("label", F.col("id") % 2 + F.lit(0.0))
    grid = {"maxDepth": [2], "maxIter": [20], "stepSize": [0.3]}
    found = modeling.halve_boosting(flat, SPEC, "label", grid, keys=["id"], folds=2, stop_percent=20)
    assert found.best["maxIter"] == 20 and found.model.stages[-1].getNumTrees < 20


def test_searches_on_cells_equal_those_on_rows(frame, monkeypatch):
    """Rows that are equal but for their labels, in cells of several rows."""
    k = F.col("id")
    rows = frame.withColumns({"size": (k % 5).cast("double"), "direction": (k % 3 * 90).cast("double")})
    grid = {"maxDepth": [2, 3], "maxIter": [3, 9], "stepSize": [0.3]}
    options = {"keys": ["id"], "folds": 2, "seed": 5}
    halving = options | {"stop_percent": 20, "tolerance": 0.2}
    searches = []
    for least in (modeling.MERGE_FROM, 1):
        monkeypatch.setattr(modeling, "MERGE_FROM", least)
        found = modeling.tune_boosting(rows, SPEC, "label", grid, **options)
        searches.append((found, modeling.halve_boosting(rows, SPEC, "label", grid, **halving)))
    for plain, merged in zip(*searches):
        assert plain.best == merged.best and plain.points == merged.points
        assert [pytest.approx(r) for r in plain.rmse] == merged.rmse
        both = plain.model.transform(rows).select("id", F.col("prediction").alias("p"))
        both = both.join(merged.model.transform(rows), "id")
        assert both.filter("abs(p - prediction) > 1e-6").count() == 0
    trees = [halved.model.stages[-1].getNumTrees for _, halved in searches]
    assert trees[0] == trees[1] < 9


def test_learning_rows_of_searches_are_bounded(spark, monkeypatch):
    """Columns with a value of their own in every row: cells stay few, and keep what labels sum to."""
    monkeypatch.setattr(modeling, "MERGE_FROM", 1000)
    spec = FeatureSpec(numeric=("x", "y"), categorical=("use",), order=("x", "y", "use"))
    k, sizes = F.col("id"), []
    for n in (20_000, 80_000):
        df = spark.range(n).select(
            (k * 7919 % n / n).alias("x"),
            (k * 104_729 % n).cast("double").alias("y"),
            F.when(k % 2 == 0, "a").otherwise("b").alias("use"),
            (k % 17 + k * 7919 % n / n).alias("label"),
        )
        cells = modeling.Cells.fit(df, spec)
        rows = cells.rows(df, "label").cache()
        sizes.append(rows.count())
        weight, label = F.col("_weight"), F.col("label")
        sums = rows.agg(F.sum(weight), F.sum(weight * label), F.sum(weight * label * label)).first()
        plain = df.agg(F.count("*"), F.sum("label"), F.sum(label * label)).first()
        assert list(sums) == pytest.approx(list(plain))
        # A learner with the same resolution errs as little on the rows as one that saw them all.
        own = GBTRegressor(labelCol="label", maxIter=3, weightCol="_weight", seed=1).fit(rows)
        theirs = modeling.fit(df, spec, GBTRegressor(labelCol="label", maxIter=3, seed=1))
        errors = [
            scores(model.transform(df), "label")["rmse"]
            for model in (modeling.PipelineModel([*cells.stages.stages, own]), theirs)
        ]
        assert errors[0] == pytest.approx(errors[1], rel=0.01)
    assert max(sizes) <= 2 * 33 * 33 * 2


def test_grids():
    assert math.prod(map(len, modeling.FULL_GRID.values())) == 27
    assert math.prod(map(len, modeling.SMALL_GRID.values())) == 4
