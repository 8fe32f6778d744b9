"""Lines of CSV files that do not fit."""

from pyspark.sql import functions as F

from intervalcast.plans import domain
from intervalcast.schemas import METERS
from intervalcast.settings import Paths, Settings
from intervalcast.sources.tables import accepted_rows, rejected_lines, screened_csv

HEADER = "building_id,meter_type,ts,value,row_id"
GOOD = ["1,e,2022-01-01 00:00:00,1.5,0", "2,,2022-01-01 00:00:00,,1", '3,"c,d",2022-01-01 00:00:00,2.0,2']
BAD = {
    "x,e,2022-01-01 00:00:00,1.5,3": ["building_id"],
    "4,e,yesterday,much,4": ["ts", "value"],
    "5,e,2022-01-01 00:00:00": ["value", "row_id"],
    "6,e,2022-01-01 00:00:00,1.5,5,more": [],
}


def test_accepted_and_rejected_are_all_lines(spark, tmp_path):
    for i, lines in enumerate((GOOD[:2] + list(BAD)[:2], GOOD[2:] + list(BAD)[2:], [])):
        (tmp_path / f"{i}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    rows = screened_csv(spark, str(tmp_path), METERS)
    sound, bad = accepted_rows(rows), rejected_lines(rows).collect()
    assert sound.columns == METERS.names
    assert {(r.row_id, r.meter_type, r.value) for r in sound.collect()} == {(0, "e", 1.5), (1, None, None), (2, "c,d", 2.0)}
    assert {r.line: r.empty for r in bad} == BAD
    assert all(r.file.endswith(".csv") and r.block_start == 0 for r in bad)
    # Whatever is selected, damaged lines are told apart; the cells that were read are there.
    assert rows.agg(F.count_if(F.col("reject").isNull())).first()[0] == accepted_rows(rows).select("row_id").count() == 3
    assert rows.filter("reject IS NOT NULL AND building_id = 4 AND meter_type = 'e'").count() == 1


def test_inputs_of_the_plan(spark, tmp_path):
    settings = Settings(paths=Paths(data_root=f"{tmp_path}/data", artifact_root=f"{tmp_path}/out"))
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "meters.csv").write_text("\n".join([HEADER, *GOOD, *BAD]) + "\n")
    for name, columns in (("building_information", 10), ("weather", 8)):
        (tmp_path / "data" / f"{name}.csv").write_text(",".join("c" * columns) + "\n1,2\n")
    counts = domain.screen_inputs(spark, settings, f"{tmp_path}/quarantine").collect()
    assert {tuple(r) for r in counts} == {("meters", 3, 4), ("buildings", 0, 1), ("weather", 0, 1)}
    kept = spark.read.parquet(f"{tmp_path}/quarantine")
    assert kept.filter("input = 'meters'").count() == 4 and kept.count() == 6
