"""Build of all relations from raw tables, and its test gate."""

import pytest
from pyspark.sql import functions as F

from pitwall import testdata as td
from pitwall.plans import build, checks
from pitwall.plans.checks import CHECKS
from pitwall.session import materialise
from pitwall.sources import audit

# Natural key of every relation.
GRAIN = {
    "stg_ergast__races": ["season", "round"],
    "stg_ergast__results": ["season", "round", "driver_id"],
    "stg_ergast__qualifying": ["season", "round", "driver_id"],
    "stg_ergast__drivers": ["driver_id"],
    "stg_ergast__driver_standings": ["season", "driver_id"],
    "stg_openf1__laps": ["session_key", "driver_number", "lap_number"],
    "stg_openf1__stints": ["session_key", "driver_number", "stint_number"],
    "dim_driver": ["driver_id"],
    "dim_race": ["race_id"],
    "fct_driver_race_summary": ["race_id", "driver_id"],
    "fct_lap": ["session_key", "driver_number", "lap_number"],
    "fct_driver_pace": ["session_key", "driver_number"],
    "fct_clean_air_pace": ["session_key", "driver_number", "compound"],
    "vw_dashboard_overview": ["race_id", "driver_id"],
    "vw_dashboard_race": ["session_key", "driver_number", "lap_number"],
    "vw_dashboard_live": ["session_key", "driver_number"],
    "vw_dashboard_pace_by_compound": ["session_key", "driver_number", "compound"],
}


@pytest.fixture
def raw(spark, sf, warehouse):
    warehouse.append("raw", "ergast_results", td.raw_results(spark, sf), "b")
    warehouse.append("raw", "ergast_qualifying", td.raw_qualifying(spark, sf), "b")
    warehouse.append("raw", "ergast_drivers", td.raw_drivers(spark, sf), "b")
    warehouse.append("raw", "ergast_driverstandings", td.raw_standings(spark, sf), "b")
    warehouse.append("raw", "openf1_laps", td.raw_laps(spark, sf), "b", warehouse.partition_of("openf1", "laps"))
    stints = td.raw_stints(spark, sf).withColumn("ingest_ts", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    warehouse.append("raw", "openf1_stints", stints, "b", warehouse.partition_of("openf1", "stints"))
    return warehouse


def test_fifty_declared_tests():
    assert sum(len(c.not_null) for c in CHECKS.values()) == 45
    assert sum(len(c.unique) for c in CHECKS.values()) == 3
    assert sum(len(c.relationships) for c in CHECKS.values()) == 2
    assert [m.name for m in build.MODELS] == list(dict.fromkeys(m.name for m in build.MODELS))
    assert set(CHECKS) == {m.name for m in build.MODELS} == set(GRAIN)


def test_full_build_serves_every_session(spark, raw, rows):
    result = build.run(spark, raw)
    assert len(result.relations) == 17 and len(result.checks) == 50
    other = spark.newSession()
    for model in build.MODELS:
        df = other.table(raw.relation(model.layer, model.name))
        assert df.count() > 0, model.name
        assert checks.duplicates(df, GRAIN[model.name]).isEmpty(), model.name
    assert other.sql(f"SELECT count(*) FROM {raw.relation('marts', 'vw_dashboard_live')}").first()[0] > 0
    # a second build adds a version, the third drops the first
    for versions in (2, 2):
        build.run(spark, raw, build.MODELS[5:6] + build.MODELS[10:11])
        assert len(raw.versions("marts", "fct_lap")) == versions
    assert raw.table("marts", "fct_lap").count() > 0
    log = audit.audit_log(raw).filter("service = 'build' and event = 'model_built'")
    assert rows(log.groupBy("event").count()) == [("model_built", 21)]
    counted = log.filter("target_table = 'fct_lap'").select("output_rows").distinct().collect()
    assert [r[0] for r in counted] == [raw.table("marts", "fct_lap").count()]


def test_views_give_the_rows_of_the_build(spark, raw, rows):
    result = build.run(spark, raw)
    built = {}
    for model in build.MODELS:
        inputs = [built[n] for n in model.needs]
        if model.source:
            inputs.insert(0, raw.source(*model.source, model.reads))
        built[model.name] = result.relations[model.name] if model.materialized == build.TABLE else model.build(*inputs)
        if model.materialized == build.VIEW:
            served = result.relations[model.name]
            assert served.columns == built[model.name].columns, model.name
            assert [f.dataType for f in served.schema] == [f.dataType for f in built[model.name].schema], model.name
            assert rows(served) == rows(built[model.name]), model.name


def test_views_follow_the_raw_tables(spark, raw):
    build.run(spark, raw)
    before = raw.table("staging", "stg_openf1__laps").count()
    lap = raw.appended("raw", "openf1_laps").filter("lap_duration is not null and not coalesce(is_pit_out_lap, false)")
    one = materialise(lap.drop("load_batch").limit(1).withColumn("lap_number", F.lit(9999).cast("long")), "one_lap")
    raw.append("raw", "openf1_laps", one, "later")
    assert raw.table("staging", "stg_openf1__laps").count() == before + 1


def test_staging_runs_once_per_build(spark, raw, monkeypatch):
    from pitwall import session

    written, real = [], session.materialise

    def note(df, name):
        written.append(name)
        return real(df, name)

    monkeypatch.setattr(session, "materialise", note)
    build.run(spark, raw)
    staged = [m.name for m in build.MODELS if m.source]
    assert [n for n in written if n in staged] == staged


def test_failed_test_blocks_dependants(spark, raw):
    build.run(spark, raw)
    kept = raw.table("marts", "dim_driver").count()
    # an amended copy of the drivers breaks the unique test
    changed = F.transform("DriverTable.Drivers", lambda d: d.withField("code", F.lit("XXX")))
    pages = materialise(raw.source("ergast", "drivers"), "pages")
    raw.append("raw", "ergast_drivers", pages.withColumn("DriverTable", F.col("DriverTable").withField("Drivers", changed)), "c")
    with pytest.raises(build.CheckFailure) as failure:
        build.run(spark, raw)
    assert "stg_ergast__drivers.driver_id unique" in str(failure.value)
    assert failure.value.skipped == ["dim_driver", "vw_dashboard_overview"]
    assert raw.table("marts", "fct_clean_air_pace").count() > 0
    # the mart of the build before is still served
    assert raw.table("marts", "dim_driver").count() == kept
    log = audit.audit_log(raw).filter("event in ('model_failed', 'model_skipped')").collect()
    assert {(r.target_table, r.reason) for r in log} == {
        ("stg_ergast__drivers", "driver_id unique"), ("dim_driver", None), ("vw_dashboard_overview", None),
    }


def test_failed_write_leaves_the_mart(spark, warehouse):
    warehouse.replace("marts", "t", spark.range(3))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        warehouse.replace("marts", "t", broken)
    assert warehouse.table("marts", "t").count() == 3
    with pytest.raises(LookupError):
        warehouse.table("marts", "unknown")
    with pytest.raises(KeyError):
        warehouse.source("other", "table")


def test_loads_are_replaced_folded_and_widened(spark, warehouse, rows):
    part = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "id % 3 as session_key")
    warehouse.append("raw", "t", part(0, 6), "b'0", ("session_key",))
    warehouse.append("raw", "t", part(0, 4), "b'0")
    warehouse.append("raw", "t", part(0, 0), "empty")
    assert warehouse.appended("raw", "t").count() == 4
    for i in range(1, 9):
        warehouse.append("raw", "t", part(10 * i, 10 * i + 3).withColumn("more", F.lit(1.5)), f"b-{i}")
    before = rows(warehouse.appended("raw", "t"), "id", "session_key", "more")
    assert warehouse.fold("raw", "t", least=4, but="b-8") == 8
    assert [b[:5] for b in warehouse.loads("raw", "t")] == ["b-8", "fold1"]
    assert rows(warehouse.appended("raw", "t"), "id", "session_key", "more") == before
    pruned = warehouse.appended("raw", "t").filter("session_key = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_key" in pruned


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k long, v string")
    assert rows(checks.not_null(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(checks.unique(df, ["k"])) == [("k", 1)]
    parent = spark.createDataFrame([("a",)], "v string")
    assert rows(checks.relationships(df, "v", parent, "v")) == [("v", 1)]
