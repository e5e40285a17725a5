"""Staging relations: flat, de-duplicated rows of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import first_or_null, inclusive_span, not_true, to_ms
from pitwall.operators.latest import distinct_rows, latest_by
from pitwall.operators.nested import flatten_pages, require_keys, unnest

RACE = {
    "season": "race.season",
    "round": "race.round",
    "race_name": "race.raceName",
    "race_date": "race.date",
    "circuit_id": "race.Circuit.circuitId",
    "circuit_name": "race.Circuit.circuitName",
    "country": "race.Circuit.Location.country",
    "race_url": "race.url",
}
RESULT = {
    "season": "season",
    "round": "round",
    "driver_id": "result.Driver.driverId",
    "constructor_id": "result.Constructor.constructorId",
    "position": "result.position",
    "grid": "result.grid",
    "points": "result.points",
    "laps": "result.laps",
    "status": "result.status",
}
QUALIFYING = {
    "season": "season",
    "round": "round",
    "driver_id": "entry.Driver.driverId",
    "constructor_id": "entry.Constructor.constructorId",
    "qualifying_position": "entry.position",
    "q1_time": "entry.Q1",
    "q2_time": "entry.Q2",
    "q3_time": "entry.Q3",
}
DRIVER = {
    "driver_id": "driver.driverId",
    "code": "driver.code",
    "permanent_number": "driver.permanentNumber",
    "given_name": "driver.givenName",
    "family_name": "driver.familyName",
    "date_of_birth": "driver.dateOfBirth",
    "nationality": "driver.nationality",
    "driver_url": "driver.url",
}

# The leaves of the raw pages that each relation needs. Spark does not prune an
# exploded array by itself, so the raw tables are read under these schemas.
_ID_FIELDS = "Driver: STRUCT<driverId STRING>, Constructor: STRUCT<constructorId STRING>"
RACES_READ = (
    "RaceTable STRUCT<Races: ARRAY<STRUCT<season BIGINT, round BIGINT, raceName STRING, date DATE, url STRING,"
    " Circuit: STRUCT<circuitId STRING, circuitName STRING, Location: STRUCT<country STRING>>>>>"
)
RESULTS_READ = (
    "RaceTable STRUCT<Races: ARRAY<STRUCT<season BIGINT, round BIGINT, Results: ARRAY<STRUCT<position BIGINT,"
    f" points BIGINT, grid BIGINT, laps BIGINT, status STRING, {_ID_FIELDS}>>>>>"
)
QUALIFYING_READ = (
    "RaceTable STRUCT<Races: ARRAY<STRUCT<season BIGINT, round BIGINT, QualifyingResults: ARRAY<STRUCT<"
    f"position BIGINT, Q1 STRING, Q2 STRING, Q3 STRING, {_ID_FIELDS}>>>>>"
)
STANDINGS_READ = (
    "StandingsTable STRUCT<StandingsLists: ARRAY<STRUCT<season BIGINT, round BIGINT, DriverStandings: ARRAY<STRUCT<"
    "position BIGINT, points BIGINT, wins BIGINT, Driver: STRUCT<driverId STRING>,"
    " Constructors: ARRAY<STRUCT<constructorId STRING>>>>>>>"
)


def _dedupe(flat: DataFrame, keys: list[str], latest_by_key: bool) -> DataFrame:
    """Whole-row distinct, or the copy from the newest load per key.

    Distinct keeps both rows when a value was amended between two loads.
    """
    if not latest_by_key:
        return distinct_rows(flat.drop("ingest_ts"))
    return latest_by(flat, keys, ["ingest_ts"]).drop("ingest_ts")


def _carry(pages: DataFrame, latest_by_key: bool) -> list[str]:
    if latest_by_key and "ingest_ts" not in pages.columns:
        raise ValueError("latest_by_key needs an ingest_ts column")
    return ["ingest_ts"] if latest_by_key else []


def _race_entries(pages: DataFrame, entries: str, alias: str, carry: list[str]) -> DataFrame:
    races = unnest(pages, "RaceTable.Races", "race", carry)
    flat = races.select(
        *carry, F.col("race.season").alias("season"), F.col("race.round").alias("round"), f"race.{entries}"
    )
    return unnest(flat, entries, alias, [*carry, "season", "round"])


def races(pages: DataFrame, latest_by_key: bool = False) -> DataFrame:
    """One row per (season, round)."""
    carry = _carry(pages, latest_by_key)
    flat = flatten_pages(unnest(pages, "RaceTable.Races", "race", carry), RACE | {c: c for c in carry})
    return _dedupe(require_keys(flat, "season", "round"), ["season", "round"], latest_by_key)


def results(pages: DataFrame, latest_by_key: bool = False) -> DataFrame:
    """One row per (season, round, driver)."""
    carry = _carry(pages, latest_by_key)
    flat = flatten_pages(_race_entries(pages, "Results", "result", carry), RESULT | {c: c for c in carry})
    keys = ["season", "round", "driver_id"]
    return _dedupe(require_keys(flat, *keys), keys, latest_by_key)


def qualifying(pages: DataFrame, latest_by_key: bool = False) -> DataFrame:
    """One row per (season, round, driver)."""
    carry = _carry(pages, latest_by_key)
    flat = flatten_pages(_race_entries(pages, "QualifyingResults", "entry", carry), QUALIFYING | {c: c for c in carry})
    keys = ["season", "round", "driver_id"]
    return _dedupe(require_keys(flat, *keys), keys, latest_by_key)


def drivers(pages: DataFrame, latest_by_key: bool = False) -> DataFrame:
    """One row per driver."""
    carry = _carry(pages, latest_by_key)
    flat = flatten_pages(unnest(pages, "DriverTable.Drivers", "driver", carry), DRIVER | {c: c for c in carry})
    return _dedupe(require_keys(flat, "driver_id"), ["driver_id"], latest_by_key)


def driver_standings(pages: DataFrame) -> DataFrame:
    """The standing after the latest round, one row per (season, driver)."""
    lists = unnest(pages, "StandingsTable.StandingsLists", "list")
    entries = lists.select(
        F.col("list.season").alias("season"),
        F.col("list.round").alias("round"),
        F.explode("list.DriverStandings").alias("ds"),
    )
    flat = entries.select(
        "season",
        "round",
        F.col("ds.Driver.driverId").alias("driver_id"),
        first_or_null(F.col("ds.Constructors"), "constructorId").alias("constructor_id"),
        F.col("ds.position").alias("position"),
        F.col("ds.points").alias("points"),
        F.col("ds.wins").alias("wins"),
    )
    # the latest row per key leaves no copies, so a distinct before it would only add a shuffle
    return latest_by(flat, ["season", "driver_id"], ["round"])


def valid_laps(raw: DataFrame) -> DataFrame:
    """Timed laps that did not start in the pit lane."""
    return require_keys(raw, "lap_duration").filter(not_true(F.col("is_pit_out_lap")))


def laps(raw: DataFrame) -> DataFrame:
    """One row per (session, driver, lap): the newest copy of a valid lap.

    Copies of a lap share ``date_start``; the fetch time decides between them
    where the raw table has it.
    """
    carry = ["ingest_ts"] if "ingest_ts" in raw.columns else []
    typed = valid_laps(raw).select(
        "session_key",
        "driver_number",
        "lap_number",
        to_ms(F.col("lap_duration")).alias("lap_time_ms"),
        to_ms(F.col("duration_sector_1")).alias("sector_1_ms"),
        to_ms(F.col("duration_sector_2")).alias("sector_2_ms"),
        to_ms(F.col("duration_sector_3")).alias("sector_3_ms"),
        "i1_speed",
        "i2_speed",
        "st_speed",
        F.col("date_start").alias("lap_started_at"),
        "meeting_key",
        *carry,
    )
    return latest_by(typed, ["session_key", "driver_number", "lap_number"], ["lap_started_at", *carry]).drop(*carry)


def stints(raw: DataFrame) -> DataFrame:
    """One row per (session, driver, stint) with a known compound."""
    carry = ["ingest_ts"] if "ingest_ts" in raw.columns else []
    typed = require_keys(raw, "compound").select(
        "session_key",
        "driver_number",
        "stint_number",
        "compound",
        "lap_start",
        "lap_end",
        inclusive_span(F.col("lap_start"), F.col("lap_end")).alias("total_laps"),
        "tyre_age_at_start",
        "meeting_key",
        *carry,
    )
    return latest_by(typed, ["session_key", "driver_number", "stint_number"], ["lap_end", *carry]).drop(*carry)
