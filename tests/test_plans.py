"""Physical plans keep the shape that large inputs need."""

import os

import pytest
from pyspark.sql import functions as F

from pitwall import testdata as td
from pitwall.operators.latest import latest_by
from pitwall.plans import build, dashboards, marts, staging
from pitwall.registry import QUERIES, lap_table, stints
from pitwall.session import materialise, scratch_scope


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_table(spark, sf, tmp_path):
    path = str(tmp_path / "raw_laps")
    td.raw_laps(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def test_latest_prunes_copies_before_the_shuffle(spark, sf, tmp_path):
    text = plan(staging.laps(raw_table(spark, sf, tmp_path)))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange") == 1
    before, after = text.split("Exchange")
    assert "Final" in before and "Partial" in after


def test_session_filter_reaches_the_scan(spark, sf, tmp_path):
    laps = staging.laps(raw_table(spark, sf, tmp_path)).filter(F.col("session_key") == 11230)
    assert "EqualTo(session_key,11230)" in plan(laps)


def test_pace_scans_only_its_columns(spark, sf):
    text = plan(marts.driver_pace(lap_table(spark, sf)))
    assert "ReadSchema: struct<session_key:bigint,driver_number:bigint,lap_number:bigint,lap_time_ms:bigint>" in text
    assert text.count("Exchange") == 1


def test_clean_air_shuffles_sessions_once_after_the_join(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(marts.clean_air_pace(lap_table(spark, sf), stints(spark, sf)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_join = text.split("SortMergeJoin")[0]
    assert above_join.count("Exchange") == 1 and "REPARTITION_BY_COL" in above_join
    assert above_join.count("Window [") == 2


def test_live_scans_one_session(spark, sf):
    laps = lap_table(spark, sf)
    text = plan(dashboards.live_state(laps, stints(spark, sf), marts.driver_pace(laps)))
    scans = [line for line in text.splitlines() if "FileScan" in line and "lap_number" in line]
    assert scans and all("session_key" in line.split("DataFilters")[1].split("=")[0] for line in scans)


def test_scratch_scope_deletes_its_tables(spark):
    with scratch_scope(spark):
        table = materialise(spark.range(3), "t")
        path = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_nested_scans_are_pruned(spark, sf, warehouse, long_plans, rows):
    warehouse.append("raw", "ergast_results", td.raw_results(spark, sf), "b")
    warehouse.append("raw", "ergast_qualifying", td.raw_qualifying(spark, sf), "b")
    warehouse.append("raw", "ergast_driverstandings", td.raw_standings(spark, sf), "b")
    for model in build.MODELS[:5]:
        if model.reads is None:
            continue
        narrow = model.build(warehouse.source(*model.source, model.reads))
        text = plan(narrow)
        schema = next(line.split("ReadSchema:")[1] for line in text.splitlines() if "ReadSchema" in line)
        assert schema.count("round") == 1 and "limit" not in schema
        assert ("Results" in schema) == (model.name in ("stg_ergast__results", "stg_ergast__qualifying"))
        assert ("raceName" in schema) == (model.name == "stg_ergast__races")
        assert rows(narrow) == rows(model.build(warehouse.source(*model.source)))
        assert text.count("Exchange") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_row_udfs_in_models(spark, sf):
    laps = lap_table(spark, sf)
    pace = marts.driver_pace(laps)
    for df in (pace, marts.clean_air_pace(laps, stints(spark, sf)), dashboards.live_state(laps, stints(spark, sf), pace)):
        assert "Python" not in plan(df)


def test_running_over_one_key_with_many_copies(spark):
    """A third of the rows are copies of one key: the partial limit keeps one per task."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) as k", "id % 7 as o", "id as v").repartition(4)
    latest = latest_by(df, ["k"], ["o"])
    assert latest.count() == 20_001
    assert latest.filter("k = 0").first().o == 6


def test_race_selector_reaches_every_scan(spark, sf, tmp_path):
    from pitwall.registry import fct_lap

    fct_lap(spark, sf).write.parquet(str(tmp_path / "laps"))
    laps = spark.read.parquet(str(tmp_path / "laps"))
    marts.driver_pace(laps).write.parquet(str(tmp_path / "pace"))
    view = dashboards.race_deep_dive(laps, spark.read.parquet(str(tmp_path / "pace")))
    text = plan(dashboards.select_race(view, "2026 Australian GP"))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("EqualTo(session_key,11234)" in line for line in scans)


def test_lines_are_parsed_once(spark, sf):
    from pitwall.registry import _parsed
    from pitwall.sources.lake import split_quarantine

    good, _ = split_quarantine(_parsed(spark, sf))
    assert "parse_json" not in plan(good).lower() and "parsejson" not in plan(good).lower()
