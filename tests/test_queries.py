"""Every registered query against its SQL on the smallest tables."""

import pytest

pytest.importorskip("duckdb")

import check

from intervalcast.queries import REGISTRY
from __spark_entry__ import entry

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(TABLES)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_equal_to_sql(spark, duck, name):
    query = REGISTRY[name]
    assert check.differences(query.build(spark, TABLES), duck, query.sql) == []


def test_every_query_has_its_sql():
    assert [n for n, q in REGISTRY.items() if not q.sql] == []


def test_entry(spark):
    df = entry(spark)
    keys = ["user_id", "event_type", "interval_start"]
    assert df.count() == df.select(*keys).distinct().count() > 0


@pytest.mark.parametrize("name", ["stream_window_complete", "training_frame", "time_order"])
def test_tables_of_many_files(spark, tmp_path, duck, name):
    """A table may be a folder of files, as on a cluster, in place of a single file."""
    for table in ("events", "customer"):
        rows = spark.read.parquet(f"{TABLES}/{table}.parquet")
        rows.repartition(5).write.parquet(str(tmp_path / f"{table}.parquet"))
    query = REGISTRY[name]
    assert check.differences(query.build(spark, str(tmp_path)), duck, query.sql) == []
