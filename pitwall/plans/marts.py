"""Dimensions, facts and pace metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import FUEL_MS_PER_LAP, fuel_corrected, full_name, race_id, safe_divide, to_seconds
from pitwall.operators.hot import HOT_ROWS, fits
from pitwall.operators.joins import drop_outliers, enrich, laps_in_stint
from pitwall.operators.latest import latest_by
from pitwall.operators.medians import group_medians, median_element_over, median_of_group, with_group_median
from pitwall.operators.nested import project
from pitwall.operators.sketches import ACCURACY, merge_sketches, sketch_groups, sketch_median, sketch_rows
from pitwall.session import materialise

LAP_COLUMNS = [
    "session_key", "driver_number", "lap_number", "lap_time_ms", "sector_1_ms", "sector_2_ms", "sector_3_ms",
    "i1_speed", "i2_speed", "st_speed", "lap_started_at", "meeting_key",
]


def dim_driver(drivers: DataFrame, results: DataFrame) -> DataFrame:
    """One row per driver, with the constructor of the latest race."""
    raced = results.select("driver_id", "season", "round", F.col("constructor_id").alias("latest_constructor_id"))
    team = latest_by(raced, ["driver_id"], ["season", "round"]).select("driver_id", "latest_constructor_id")
    return enrich(drivers, team, ["driver_id"]).select(
        "driver_id",
        "code",
        "permanent_number",
        "given_name",
        "family_name",
        full_name(F.col("given_name"), F.col("family_name")).alias("full_name"),
        "date_of_birth",
        "nationality",
        "latest_constructor_id",
    )


def dim_race(races: DataFrame) -> DataFrame:
    return races.select(
        race_id(F.col("season"), F.col("round")).alias("race_id"),
        "season", "round", "race_name", "circuit_id", "circuit_name", "country", "race_date", "race_url",
    )


def driver_race_summary(results: DataFrame, qualifying: DataFrame) -> DataFrame:
    """One row per (race, driver): result and qualifying position."""
    grid = qualifying.select("season", "round", "driver_id", "qualifying_position")
    return enrich(results, grid, ["season", "round", "driver_id"]).select(
        race_id(F.col("season"), F.col("round")).alias("race_id"),
        "season", "round", "driver_id", "constructor_id", "grid", "position", "points", "laps", "status",
        "qualifying_position",
    )


def fct_lap(staged_laps: DataFrame) -> DataFrame:
    return project(staged_laps, LAP_COLUMNS)


_PACE_COLUMNS = ["session_key", "driver_number", "lap_number", "lap_time_ms"]


def driver_pace(laps: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Median lap and pace ratio per (session, driver).

    The ratio compares each lap with the field's median for that lap number,
    so 1.0 is the pace of the field. ``laps`` is also counted: pass a table, not
    a long plan.
    """
    timed, limit = laps.select(*_PACE_COLUMNS), hot_rows
    if fits(timed, ["session_key"], hot_rows):
        # every session fits a task: one shuffle serves the window and the aggregate
        timed, limit = timed.repartition("session_key"), None
    per_lap = with_group_median(timed, ["session_key", "lap_number"], "lap_time_ms", "field_median_ms", limit)
    per_lap = per_lap.filter(F.col("field_median_ms") > 0).select(
        "session_key", "driver_number", "lap_time_ms", (F.col("lap_time_ms") / F.col("field_median_ms")).alias("ratio")
    )
    return group_medians(
        per_lap,
        ["session_key", "driver_number"],
        {"median_lap_ms": "lap_time_ms", "pace_ratio": "ratio"},
        count_as="laps",
        hot_rows=limit,
        sized_by=timed,
    )


def clean_air_laps(
    on_tyres: DataFrame, fuel_ms_per_lap: int = FUEL_MS_PER_LAP, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Fuel-corrected laps on a known compound, without out-laps and outliers.

    The outlier bound uses the median of the laps that matched a stint.
    """
    judged = with_group_median(on_tyres, ["session_key", "lap_number"], "lap_time_ms", "session_median_ms", hot_rows)
    corrected = fuel_corrected(F.col("lap_time_ms"), F.col("session_max_lap"), F.col("lap_number"), fuel_ms_per_lap)
    return drop_outliers(judged, "lap_time_ms", "session_median_ms").select(
        "session_key", "driver_number", "compound", corrected.alias("corrected_ms")
    )


def driver_and_field_median(clean: DataFrame, value: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Medians of one input at two grains, the field's next to the driver's.

    With ``hot_rows=None`` the sessions are co-located and fit a task: the field
    is a window over the same rows, and neither grain shuffles again.
    """
    driver, field = ["session_key", "driver_number", "compound"], ["session_key", "compound"]
    if hot_rows is None:
        both = clean.withColumn("_field", median_element_over(clean, value, field))
        return both.groupBy(*driver).agg(
            F.count(F.lit(1)).alias("clean_air_laps"),
            median_of_group(value).alias("median_corrected_ms"),
            F.min("_field").alias("field_median_ms"),
        )
    per_driver = group_medians(
        clean, driver, {"median_corrected_ms": value}, count_as="clean_air_laps", hot_rows=hot_rows
    )
    per_field = group_medians(clean, field, {"field_median_ms": value}, hot_rows=hot_rows)
    return enrich(per_driver, per_field, field)


def clean_air_pace(
    laps: DataFrame, stints: DataFrame, fuel_ms_per_lap: int = FUEL_MS_PER_LAP, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Clean-air pace per (session, driver, compound). ``laps`` is a table, as in driver_pace."""
    timed = laps.select(*_PACE_COLUMNS)
    on_tyres = laps_in_stint(timed, stints)
    # a lap matches at most as many stints as its driver has
    per_driver = stints.groupBy("session_key", "driver_number").agg(F.count(F.lit(1)).alias("stints"))
    copies = per_driver.agg(F.max("stints")).first()[0] or 1
    if fits(timed, ["session_key"], hot_rows // copies):
        clean = clean_air_laps(on_tyres.repartition("session_key"), fuel_ms_per_lap, None)
        both = driver_and_field_median(clean, "corrected_ms", None)
    else:
        on_tyres = materialise(on_tyres, "laps_in_stint")
        clean = materialise(clean_air_laps(on_tyres, fuel_ms_per_lap, hot_rows), "clean_air")
        both = driver_and_field_median(clean, "corrected_ms", hot_rows)
    return both.select(
        "session_key",
        "driver_number",
        "compound",
        "clean_air_laps",
        "median_corrected_ms",
        to_seconds(F.col("median_corrected_ms")).alias("median_corrected_s"),
        safe_divide(F.col("median_corrected_ms"), F.col("field_median_ms")).alias("pace_ratio"),
    )


PACE_GRAIN = ["session_key", "driver_number", "compound"]


def pace_sketches(
    laps: DataFrame, stints: DataFrame, fuel_ms_per_lap: int = FUEL_MS_PER_LAP, accuracy: int = ACCURACY
) -> DataFrame:
    """Sketches of fuel-corrected laps per (session, driver, compound), to be stored per load."""
    on_tyres = laps_in_stint(laps.select(*_PACE_COLUMNS), stints)
    clean = clean_air_laps(on_tyres, fuel_ms_per_lap)
    return sketch_groups(clean, PACE_GRAIN, "corrected_ms", accuracy=accuracy)


def sketch_pace(sketches: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """Clean-air pace from stored sketches: those of a driver, and of the field by merging its drivers'.

    ``sketches`` may hold several rows per driver, one for each load.
    """
    driver = merge_sketches(sketches, PACE_GRAIN, accuracy=accuracy)
    field = merge_sketches(driver, ["session_key", "compound"], "_field", accuracy)
    both = enrich(driver, field, ["session_key", "compound"])
    median = sketch_median("sketch")
    return both.select(
        *PACE_GRAIN,
        sketch_rows("sketch").alias("clean_air_laps"),
        median.alias("median_corrected_ms"),
        to_seconds(median).alias("median_corrected_s"),
        safe_divide(median, sketch_median("_field")).alias("pace_ratio"),
    )
