"""Properties of physical plans that matter on large tables."""

import pytest

import check

from intervalcast.queries import REGISTRY

TABLES = "/root/testdata/sf0.001"

# Whole-table statistics, and offsets with one row per partition.
ONE_ROW = {
    "accuracy",
    "angle_features",
    "filter_counts",
    "impute_joined",
    "impute_mean",
    "metric_count",
    "metric_lag",
    "metric_live_filled",
    "metric_throughput",
    "null_counts",
    "preview",
    "random_split",
    "sample_rows",
    "sigma_bounds",
    "sigma_filter",
    "time_order",
    "train_only_filter",
}
LISTED = {"messages", "envelope_round_trip"}
RUNS_AT_ONCE = {
    "bench_models",
    "tune_gbt",
    "score_batch",
    "stream_progress",
    "day_quantiles",
    "numeric_summary",
    "numeric_summary_infinite",
}
BATCH = [n for n in REGISTRY if not n.startswith("stream") and n not in RUNS_AT_ONCE]


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_products_no_sorted_aggregates(spark, capsys, name):
    plan = plan_of(REGISTRY[name].build(spark, TABLES), capsys)
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "SortAggregate"):
        assert operator not in plan
    # Lists are only built for messages of a fixed length.
    assert ("ObjectHashAggregate" in plan) <= (name in LISTED)
    assert ("SinglePartition" in plan) <= (name in ONE_ROW | LISTED)


def test_bounds_of_the_training_rows_take_two_scans(spark, capsys):
    plan = plan_of(REGISTRY["train_only_filter"].build(spark, TABLES), capsys)
    assert plan.count("FileScan parquet") == 2


def test_scans_read_what_is_used(spark, capsys):
    plan = plan_of(REGISTRY["training_frame"].build(spark, TABLES), capsys)
    assert "props" not in plan and "event_id" not in plan and "c_name" not in plan
    assert "EqualTo(event_type,view)" in plan


def test_larger_sides_are_shuffled_with_the_same_result(spark, capsys):
    query = REGISTRY["training_frame"]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = query.build(spark, TABLES)
        plan = plan_of(df, capsys)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert check.differences(df, check.connect(TABLES), query.sql) == []
    finally:
        spark.conf.set(key, before)
