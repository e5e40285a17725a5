"""Staging, mart and dashboard relations on micro-fixtures."""

import pytest
from pyspark.sql import functions as F

from pitwall import testdata as td
from pitwall.operators.medians import group_medians
from pitwall.plans import dashboards, marts, staging

LAPS = (
    "session_key long, meeting_key long, driver_number long, lap_number long, date_start string, lap_duration double,"
    " is_pit_out_lap boolean, ingest string"
)
STINTS = (
    "session_key long, meeting_key long, driver_number long, stint_number long, lap_start long, lap_end long,"
    " compound string, tyre_age_at_start long"
)


def raw_laps(spark, data):
    df = spark.createDataFrame(data, LAPS)
    zeros = {c: F.lit(30.0) for c in ("duration_sector_1", "duration_sector_2", "duration_sector_3")}
    speeds = {c: F.lit(300).cast("long") for c in ("i1_speed", "i2_speed", "st_speed")}
    times = {"date_start": F.col("date_start").cast("timestamp"), "ingest_ts": F.col("ingest").cast("timestamp")}
    return df.withColumns(zeros | speeds | times).drop("ingest")


def lap(n, seconds=90.0, driver=1, session=1, start="2026-03-08 04:00:00", pit_out=False, ingest="2026-03-08 04:05:00"):
    return (session, 7, driver, n, start, seconds, pit_out, ingest)


def fct(spark, data):
    return marts.fct_lap(staging.laps(raw_laps(spark, data)))


def test_laps_filter(spark, rows):
    raw = raw_laps(spark, [lap(1, pit_out=True), lap(2), lap(3, pit_out=None), lap(4, None)])
    assert rows(staging.laps(raw), "lap_number") == [(2,), (3,)]


def test_replayed_lap_later_start_wins(spark, rows):
    raw = raw_laps(spark, [lap(1, 90.0, start="2026-03-08 04:00:00"), lap(1, 91.0, start="2026-03-08 04:00:01")])
    assert rows(staging.laps(raw), "lap_time_ms") == [(91_000,)]


def test_amended_lap_later_fetch_wins(spark, rows):
    raw = raw_laps(spark, [lap(1, 95.0, ingest="2026-03-08 04:06:00"), lap(1, 90.0, ingest="2026-03-08 04:07:00")])
    assert rows(staging.laps(raw), "lap_time_ms") == [(90_000,)]


def test_laps_without_fetch_time(spark, rows):
    raw = raw_laps(spark, [lap(1, 90.0), lap(1, 90.0)]).drop("ingest_ts")
    assert staging.laps(raw).count() == 1


def test_loading_twice_changes_nothing(spark, sf, rows):
    from pitwall import testdata as td

    pairs = [
        (staging.laps, td.raw_laps), (staging.stints, td.raw_stints), (staging.races, td.raw_results),
        (staging.results, td.raw_results), (staging.qualifying, td.raw_qualifying),
        (staging.drivers, td.raw_drivers), (staging.driver_standings, td.raw_standings),
    ]
    for build, raw in pairs:
        once = raw(spark, sf)
        assert rows(build(once)) == rows(build(once.unionByName(once)))


def test_open_and_closed_stint_copy(spark, rows):
    raw = spark.createDataFrame([(1, 7, 1, 1, 1, None, "SOFT", 0), (1, 7, 1, 1, 1, 12, "SOFT", 0)], STINTS)
    assert rows(staging.stints(raw), "lap_end", "total_laps") == [(12, 12)]


def test_stint_without_compound_goes(spark):
    raw = spark.createDataFrame([(1, 7, 1, 1, 1, 12, None, 0)], STINTS)
    assert staging.stints(raw).count() == 0


def test_open_stint_has_no_clean_air(spark):
    laps = fct(spark, [lap(n) for n in range(1, 6)])
    stints = staging.stints(spark.createDataFrame([(1, 7, 1, 1, 1, None, "SOFT", 0)], STINTS))
    assert marts.clean_air_pace(laps, stints).count() == 0


def test_clean_air_pace(spark):
    # two drivers, same stint; lap 3 of driver 1 is an outlier
    data = [lap(n, 90.0, driver=1) for n in (1, 2, 4)] + [lap(3, 200.0, driver=1)]
    data += [lap(n, 91.0, driver=2) for n in (1, 2, 3, 4)] + [lap(n, 92.0, driver=3) for n in (1, 2, 3, 4)]
    stints = spark.createDataFrame([(1, 7, d, 1, 1, 4, "SOFT", 0) for d in (1, 2, 3)], STINTS)
    pace = {r.driver_number: r for r in marts.clean_air_pace(fct(spark, data), staging.stints(stints)).collect()}
    assert pace[1].clean_air_laps == 2 and pace[2].clean_air_laps == 3
    # laps 2 and 4 of 4: 90,000 - 60 and 90,000; the lower middle one counts
    assert pace[1].median_corrected_ms == 89_940
    assert pace[1].median_corrected_s == 89.94
    # field: 89,940 90,000 90,940 90,970 91,000 91,940 91,970 92,000
    assert pace[1].pace_ratio == 89_940 / 90_970


def test_pace_ratio_of_the_field(spark):
    data = [lap(n, 90.0 + d, driver=d) for n in (1, 2, 3) for d in (1, 2, 3)]
    pace = {r.driver_number: r for r in marts.driver_pace(fct(spark, data)).collect()}
    assert pace[2].pace_ratio == 1.0
    assert pace[1].pace_ratio < 1.0 < pace[3].pace_ratio
    assert pace[1].laps == 3 and pace[1].median_lap_ms == 91_000


def test_pace_with_large_groups_is_the_same(spark, sf, rows):
    from pitwall.registry import lap_table, stints

    laps = lap_table(spark, sf)
    assert rows(marts.driver_pace(laps)) == rows(marts.driver_pace(laps, hot_rows=10))
    tyres = stints(spark, sf)
    assert rows(marts.clean_air_pace(laps, tyres)) == rows(marts.clean_air_pace(laps, tyres, hot_rows=10))


def test_clean_air_with_very_many_stints(spark, rows):
    laps = fct(spark, [lap(n, 90.0 + d, driver=d) for n in range(1, 41) for d in (1, 2, 3)])
    many = [(1, 7, d, s, 2 * s - 1, 2 * s, "SOFT", 0) for d in (1, 2, 3) for s in range(1, 21)]
    one = [(1, 7, d, 1, 0, 40, "SOFT", 0) for d in (1, 2, 3)]
    counts = [
        rows(marts.clean_air_pace(laps, staging.stints(spark.createDataFrame(s, STINTS)), hot_rows=h), "clean_air_laps")
        for s in (many, one) for h in (10, 1000)
    ]
    assert counts == [[(20,)] * 3, [(20,)] * 3, [(40,)] * 3, [(40,)] * 3]


def results(spark, data):
    schema = (
        "season long, round long, driver_id string, constructor_id string, position long, grid long, points long,"
        " laps long, status string"
    )
    return spark.createDataFrame(data, schema)


def test_amended_result_parity_and_latest_mode(spark, rows):
    page = "named_struct('Races', array(named_struct('season', 2026L, 'round', 1L, 'Results', array({})))) as RaceTable"
    result = (
        "named_struct('position', 1L, 'points', {}L, 'grid', 1L, 'laps', 50L, 'status', 'Finished',"
        " 'Driver', named_struct('driverId', 'ver'), 'Constructor', named_struct('constructorId', 'rb'))"
    )
    one = spark.range(1).selectExpr(page.format(result.format(25)), "timestamp'2026-03-09 06:00:00' as ingest_ts")
    two = spark.range(1).selectExpr(page.format(result.format(18)), "timestamp'2026-03-10 06:00:00' as ingest_ts")
    both = one.unionByName(two)
    assert rows(staging.results(both), "points") == [(18,), (25,)]
    assert rows(staging.results(both, latest_by_key=True), "points") == [(18,)]
    with pytest.raises(ValueError):
        staging.results(both.drop("ingest_ts"), latest_by_key=True)


def test_latest_team_and_left_joins(spark, rows):
    raced = results(spark, [(2025, 9, "ver", "old", 1, 1, 25, 50, "F"), (2026, 1, "ver", "new", 1, 1, 25, 50, "F")])
    drivers = spark.createDataFrame(
        [("ver", "VER", 1, "Max", "V", None, "NL", "u"), ("xxx", None, None, None, "X", None, None, None)],
        "driver_id string, code string, permanent_number long, given_name string, family_name string,"
        " date_of_birth date, nationality string, driver_url string",
    )
    dim = marts.dim_driver(drivers, raced)
    assert rows(dim, "driver_id", "full_name", "latest_constructor_id") == [("ver", "Max V", "new"), ("xxx", None, None)]


def test_overview(spark, rows):
    raced = results(
        spark,
        [(2026, r, "ver", "rb", p, 3, pts, 50, "F") for r, p, pts in ((1, 1, 25), (2, 2, 18), (3, None, 0))],
    )
    quali = spark.createDataFrame([(2026, 1, "ver", 2)], "season long, round long, driver_id string, qualifying_position long")
    summary = marts.driver_race_summary(raced, quali)
    assert rows(summary, "race_id", "qualifying_position") == [("2026-1", 2), ("2026-2", None), ("2026-3", None)]
    dim_driver = spark.createDataFrame(
        [("ver", "VER", "Max V", "NL", "rb")],
        "driver_id string, code string, full_name string, nationality string, latest_constructor_id string",
    )
    dim_race = spark.createDataFrame(
        [], "race_id string, race_name string, race_date date, country string, circuit_name string"
    )
    view = dashboards.overview(summary, dim_driver, dim_race)
    assert rows(view, "round", "is_win", "is_podium", "grid_to_finish", "cumulative_points", "race_name") == [
        (1, 1, 1, 2, 25, None),
        (2, 0, 1, 1, 43, None),
        (3, 0, 0, None, 43, None),
    ]
    assert rows(dashboards.championship(summary, dim_driver)) == [(2026, "ver", "Max V", 43)]


def live(spark, as_of, stint_end=99):
    data = [lap(n, 80.0 + n, driver=1, start=f"2026-03-08 04:{n:02d}:00") for n in range(1, 9)]
    data += [lap(1, 100.0, driver=2, session=1, start="2026-03-08 04:01:00"), lap(1, session=0, start="2026-03-01 04:00:00")]
    laps = fct(spark, data)
    stints = staging.stints(
        spark.createDataFrame(
            [(1, 7, 1, 1, 1, 5, "SOFT", 0), (1, 7, 1, 2, 6, stint_end, "HARD", 0)], STINTS
        )
    )
    view = dashboards.live_state(laps, stints, marts.driver_pace(laps), F.lit(as_of).cast("timestamp"))
    return {r.driver_number: r for r in view.collect()}


def test_live_state(spark):
    state = live(spark, "2026-03-08 06:07:59")
    assert set(state) == {1, 2}
    one, two = state[1], state[2]
    assert (one.latest_lap_number, one.compound, one.current_stint, one.tire_age_laps) == (8, "HARD", 2, 3)
    assert one.last_5_laps_avg_ms == 86_000.0
    assert one.is_live_proxy is True and two.is_live_proxy is False
    assert (two.compound, two.tire_age_laps) == (None, None)
    assert one.session_label == "Session #1" and one.driver_label == "VER"


def test_live_state_open_stint_and_future(spark):
    state = live(spark, "2026-03-08 03:00:00", stint_end=None)
    assert state[1].compound is None and state[1].tire_age_laps is None
    assert state[1].is_live_proxy is True


def test_live_state_without_laps(spark):
    laps = fct(spark, [lap(1)]).limit(0)
    stints = staging.stints(spark.createDataFrame([], STINTS))
    assert dashboards.live_state(laps, stints, marts.driver_pace(laps)).count() == 0


def test_outlier_flag_and_selector(spark, rows):
    laps = fct(spark, [lap(1, 100.0), lap(2, 100.0), lap(3, 125.0), lap(4, 126.0), lap(1, session=11234)])
    view = dashboards.race_deep_dive(laps, marts.driver_pace(laps))
    flags = rows(view.filter("session_key = 1"), "lap_number", "is_outlier_lap")
    assert flags == [(1, False), (2, False), (3, False), (4, True)]
    assert rows(dashboards.select_race(view, "2026 Australian GP"), "session_key") == [(11234,)]


def test_field_medians_are_not_shared(spark):
    """Per lap number over all laps, per lap number over stint laps, and per session differ."""
    data = [lap(n, 90.0 + d + n, driver=d) for n in range(1, 5) for d in (1, 2, 3, 4)]
    laps = fct(spark, data)
    assert group_medians(laps, ["session_key"], {"m": "lap_time_ms"}).first().m == 95_000
    stints = staging.stints(spark.createDataFrame([(1, 7, 4, 1, 1, 4, "SOFT", 0)], STINTS))
    # driver 4 alone on a known stint: its own median, so no outliers and ratio 1
    assert [r.pace_ratio for r in marts.clean_air_pace(laps, stints).collect()] == [1.0]


def test_tasks_of_entries_follow_the_number_of_orders(spark, tmp_path, monkeypatch, rows):
    orders = "id as o_orderkey, id % 97 as o_custkey, 'O' as o_orderstatus, double(id % 13) as o_totalprice"
    spark.range(3000).selectExpr(*orders.split(", ")).write.parquet(str(tmp_path / "orders.parquet"))
    whole = rows(td.raw_results(spark, str(tmp_path)).selectExpr("total", "offset", "to_json(sort_array(RaceTable.Races.round))"))
    monkeypatch.setattr(td, "ORDERS_PER_TASK", 100)
    assert ", 31), REPARTITION_BY_NUM" in td.entries(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert rows(td.raw_results(spark, str(tmp_path)).selectExpr("total", "offset", "to_json(sort_array(RaceTable.Races.round))")) == whole
