"""Serving relations for the season, race, live and compound pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import flag, grid_delta, inclusive_span, is_outlier, minutes_since, to_seconds
from pitwall.functions.labels import session_keys, with_driver_label, with_session_label
from pitwall.operators.hot import HOT_ROWS
from pitwall.operators.joins import current_stints, enrich, keep_latest_session, latest_session
from pitwall.operators.latest import last_n_avg, latest_by, max_by_group
from pitwall.operators.medians import group_medians
from pitwall.operators.nested import project
from pitwall.operators.running import running_sum

LIVE_MINUTES = 120


def overview(summary: DataFrame, dim_driver: DataFrame, dim_race: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Season page: one row per (race, driver) with points up to that round."""
    # the running sum comes first, on rows that are not yet widened by the dimensions
    fact = running_sum(summary, ["driver_id", "season"], ["round"], "points", "cumulative_points", hot_rows)
    drivers = dim_driver.select(
        "driver_id", F.col("code").alias("driver_code"), "full_name", "nationality", "latest_constructor_id"
    )
    races = dim_race.select("race_id", "race_name", "race_date", "country", "circuit_name")
    position = F.col("position")
    wide = enrich(enrich(fact, drivers, ["driver_id"]), races, ["race_id"])
    return wide.select(
        "race_id", "season", "round", "driver_id", "constructor_id", "grid", "position", "qualifying_position",
        "points", "status", "laps",
        "driver_code", "full_name", "nationality", "latest_constructor_id",
        "race_name", "race_date", "country", "circuit_name",
        flag(position == 1).alias("is_win"),
        flag(position <= 3).alias("is_podium"),
        grid_delta(F.col("grid"), position).alias("grid_to_finish"),
        "cumulative_points",
    )


def championship(summary: DataFrame, dim_driver: DataFrame) -> DataFrame:
    """Championship table: points per (season, driver), summed before the names are joined."""
    points = summary.groupBy("season", "driver_id").agg(F.sum("points").alias("points"))
    named = enrich(points, dim_driver.select("driver_id", "full_name"), ["driver_id"])
    return named.select("season", "driver_id", "full_name", "points")


def race_deep_dive(
    laps: DataFrame,
    pace: DataFrame,
    hot_rows: int = HOT_ROWS,
    driver_names: DataFrame | None = None,
    session_names: DataFrame | None = None,
) -> DataFrame:
    """Race page: one row per (session, driver, lap)."""
    median = group_medians(laps, ["session_key"], {"session_median_ms": "lap_time_ms"}, hot_rows=hot_rows)
    per_driver = pace.select("session_key", "driver_number", "pace_ratio", "median_lap_ms")
    wide = enrich(enrich(laps, median, ["session_key"]), per_driver, ["session_key", "driver_number"])
    wide = wide.select(
        "session_key",
        "driver_number",
        "lap_number",
        "lap_time_ms",
        to_seconds(F.col("lap_time_ms")).alias("lap_time_s"),
        to_seconds(F.col("sector_1_ms")).alias("sector_1_s"),
        to_seconds(F.col("sector_2_ms")).alias("sector_2_s"),
        to_seconds(F.col("sector_3_ms")).alias("sector_3_s"),
        "i1_speed",
        "i2_speed",
        "st_speed",
        "lap_started_at",
        "meeting_key",
        "pace_ratio",
        to_seconds(F.col("median_lap_ms")).alias("driver_median_lap_s"),
        is_outlier(F.col("lap_time_ms"), F.col("session_median_ms")).alias("is_outlier_lap"),
    )
    columns = wide.columns
    labelled = with_session_label(with_driver_label(wide, driver_names), session_names)
    return labelled.select(*columns, "driver_label", "session_label")


def select_race(view: DataFrame, session_label: str, session_names: DataFrame | None = None) -> DataFrame:
    """The race selector of the race page.

    The label is turned into session keys, which reach the scans. Pass the
    ``session_names`` that the view was made with, if it was.
    """
    if session_names is None:
        return view.filter(F.col("session_key").isin(session_keys(session_label)))
    return view.filter(F.col("session_label") == session_label)


def live_state(
    laps: DataFrame,
    stints: DataFrame,
    pace: DataFrame,
    as_of: Column | None = None,
    driver_names: DataFrame | None = None,
    session_names: DataFrame | None = None,
) -> DataFrame:
    """Live page: one row per driver of the session with the newest lap."""
    as_of = F.current_timestamp() if as_of is None else as_of
    keys = ["session_key", "driver_number"]
    newest = latest_session(laps)
    current = keep_latest_session(laps, newest)
    drivers = max_by_group(current, keys, latest_lap_number="lap_number", latest_lap_started_at="lap_started_at")
    running = current_stints(drivers, keep_latest_session(stints, newest)).select(
        *keys, "stint_number", "compound", "lap_start"
    )
    stint = latest_by(running, keys, ["stint_number"])
    last_5 = last_n_avg(current, keys, "lap_number", "lap_time_ms", "last_5_laps_avg_ms")
    ratio = keep_latest_session(pace.select(*keys, "pace_ratio"), newest)
    wide = with_session_label(with_driver_label(enrich(drivers, [stint, last_5, ratio], keys), driver_names), session_names)
    return wide.select(
        "session_key",
        "session_label",
        "driver_number",
        "driver_label",
        "latest_lap_number",
        "latest_lap_started_at",
        "compound",
        F.col("stint_number").alias("current_stint"),
        inclusive_span(F.col("lap_start"), F.col("latest_lap_number")).alias("tire_age_laps"),
        "last_5_laps_avg_ms",
        "pace_ratio",
        (minutes_since(F.col("latest_lap_started_at"), as_of) < LIVE_MINUTES).alias("is_live_proxy"),
    )


def pace_by_compound(
    clean_air: DataFrame, driver_names: DataFrame | None = None, session_names: DataFrame | None = None
) -> DataFrame:
    """Compound page: clean-air pace with display labels."""
    labelled = with_session_label(with_driver_label(clean_air, driver_names), session_names)
    return project(
        labelled,
        ["session_key", "session_label", "driver_number", "driver_label", "compound", "clean_air_laps",
         "median_corrected_ms", "median_corrected_s", "pace_ratio"],
    )
