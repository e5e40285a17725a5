"""The staging and page relations as SQL text, for permanent views.

Any session on the same metastore reads them. ``{raw}``, ``{staging}`` and
``{marts}`` stand for the databases. A build computes the same relations as
DataFrames; the tests compare both, row by row.
"""

from __future__ import annotations

from pitwall.functions.columns import OUTLIER_FACTOR
from pitwall.functions.labels import DRIVER_CODES, SESSION_NAMES
from pitwall.plans.dashboards import LIVE_MINUTES
from pitwall.plans.staging import DRIVER, QUALIFYING, RACE, RESULT


def _label(column: str, names: dict[int, str], prefix: str) -> str:
    pairs = ", ".join(f"{k}L, '{v}'" for k, v in names.items())
    return f"coalesce(try_element_at(map({pairs}), {column}), concat('{prefix}', {column}))"


def _columns(paths: dict[str, str]) -> str:
    return ", ".join(f"{path} AS {name}" for name, path in paths.items())


def _newest(keys: str, order: str, columns: str, rows: str) -> str:
    """One row per key, the first by ``order``, all descending with NULLs last."""
    sort = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in order.split(","))
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {sort}) AS _rn FROM ({rows})"
    return f"SELECT {columns} FROM ({ranked}) WHERE _rn = 1"


def _entries(table: str, entries: str, alias: str, paths: dict[str, str]) -> str:
    return f"""
        SELECT DISTINCT {_columns(paths)} FROM (
            SELECT season, round, explode(entries) AS {alias} FROM (
                SELECT race.season AS season, race.round AS round, race.{entries} AS entries
                FROM (SELECT explode(RaceTable.Races) AS race FROM {{raw}}.{table})))
        WHERE season IS NOT NULL AND round IS NOT NULL AND {alias}.Driver.driverId IS NOT NULL"""


def _ms(seconds: str) -> str:
    return f"CAST(round({seconds} * 1000D) AS BIGINT)"


_DRIVER_LABEL = _label("driver_number", DRIVER_CODES, "#")
_SESSION_LABEL = _label("session_key", SESSION_NAMES, "Session #")
_LAP_REST = "lap_time_ms, sector_1_ms, sector_2_ms, sector_3_ms, i1_speed, i2_speed, st_speed"
_STINT_REST = "compound, lap_start, total_laps, tyre_age_at_start, meeting_key"
_SUMMARY_REST = "race_id, constructor_id, grid, position, points, laps, status, qualifying_position"
_NEWEST_SESSION = """(
            SELECT session_key FROM (SELECT session_key, max(lap_started_at) AS newest FROM {marts}.fct_lap GROUP BY session_key)
            ORDER BY newest DESC NULLS LAST, session_key DESC LIMIT 1)"""

VIEWS = {
    "stg_ergast__races": f"""
        SELECT DISTINCT {_columns(RACE)} FROM (SELECT explode(RaceTable.Races) AS race FROM {{raw}}.ergast_results)
        WHERE race.season IS NOT NULL AND race.round IS NOT NULL""",
    "stg_ergast__results": _entries("ergast_results", "Results", "result", RESULT),
    "stg_ergast__qualifying": _entries("ergast_qualifying", "QualifyingResults", "entry", QUALIFYING),
    "stg_ergast__drivers": f"""
        SELECT DISTINCT {_columns(DRIVER)} FROM (SELECT explode(DriverTable.Drivers) AS driver FROM {{raw}}.ergast_drivers)
        WHERE driver.driverId IS NOT NULL""",
    "stg_ergast__driver_standings": _newest(
        "season, driver_id",
        "round, constructor_id, position, points, wins",
        "season, round, driver_id, constructor_id, position, points, wins",
        """
            SELECT season, round, ds.Driver.driverId AS driver_id, get(ds.Constructors, 0).constructorId AS constructor_id,
                   ds.position AS position, ds.points AS points, ds.wins AS wins
            FROM (SELECT list.season AS season, list.round AS round, explode(list.DriverStandings) AS ds
                  FROM (SELECT explode(StandingsTable.StandingsLists) AS list FROM {raw}.ergast_driverstandings))""",
    ),
    "stg_openf1__laps": _newest(
        "session_key, driver_number, lap_number",
        f"lap_started_at, ingest_ts, {_LAP_REST}, meeting_key",
        f"session_key, driver_number, lap_number, {_LAP_REST}, lap_started_at, meeting_key",
        f"""
            SELECT session_key, driver_number, lap_number, {_ms("lap_duration")} AS lap_time_ms,
                   {_ms("duration_sector_1")} AS sector_1_ms, {_ms("duration_sector_2")} AS sector_2_ms,
                   {_ms("duration_sector_3")} AS sector_3_ms, i1_speed, i2_speed, st_speed,
                   date_start AS lap_started_at, meeting_key, ingest_ts
            FROM {{raw}}.openf1_laps WHERE lap_duration IS NOT NULL AND NOT coalesce(is_pit_out_lap, false)""",
    ),
    "stg_openf1__stints": _newest(
        "session_key, driver_number, stint_number",
        f"lap_end, ingest_ts, {_STINT_REST}",
        "session_key, driver_number, stint_number, compound, lap_start, lap_end, total_laps, tyre_age_at_start, meeting_key",
        """
            SELECT session_key, driver_number, stint_number, compound, lap_start, lap_end,
                   lap_end - lap_start + 1 AS total_laps, tyre_age_at_start, meeting_key, ingest_ts
            FROM {raw}.openf1_stints WHERE compound IS NOT NULL""",
    ),
    "vw_dashboard_overview": f"""
        SELECT f.race_id, f.season, f.round, f.driver_id, f.constructor_id, f.grid, f.position, f.qualifying_position,
               f.points, f.status, f.laps,
               d.code AS driver_code, d.full_name, d.nationality, d.latest_constructor_id,
               r.race_name, r.race_date, r.country, r.circuit_name,
               if(f.position = 1, 1, 0) AS is_win, if(f.position <= 3, 1, 0) AS is_podium,
               f.grid - f.position AS grid_to_finish, f.cumulative_points
        FROM (SELECT *, sum(points) OVER (PARTITION BY driver_id, season ORDER BY round, {_SUMMARY_REST}
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_points
              FROM {{marts}}.fct_driver_race_summary) f
        LEFT JOIN {{marts}}.dim_driver d ON d.driver_id = f.driver_id
        LEFT JOIN {{marts}}.dim_race r ON r.race_id = f.race_id""",
    "vw_dashboard_race": f"""
        SELECT l.session_key, l.driver_number, l.lap_number, l.lap_time_ms, l.lap_time_ms / 1000D AS lap_time_s,
               l.sector_1_ms / 1000D AS sector_1_s, l.sector_2_ms / 1000D AS sector_2_s, l.sector_3_ms / 1000D AS sector_3_s,
               l.i1_speed, l.i2_speed, l.st_speed, l.lap_started_at, l.meeting_key, p.pace_ratio,
               p.median_lap_ms / 1000D AS driver_median_lap_s,
               l.lap_time_ms > {OUTLIER_FACTOR}D * m.session_median_ms AS is_outlier_lap,
               {_DRIVER_LABEL.replace("driver_number", "l.driver_number")} AS driver_label,
               {_SESSION_LABEL.replace("session_key", "l.session_key")} AS session_label
        FROM {{marts}}.fct_lap l
        LEFT JOIN (SELECT session_key, CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY lap_time_ms) AS BIGINT) AS session_median_ms
                   FROM {{marts}}.fct_lap GROUP BY session_key) m ON m.session_key = l.session_key
        LEFT JOIN {{marts}}.fct_driver_pace p ON p.session_key = l.session_key AND p.driver_number = l.driver_number""",
    "vw_dashboard_live": f"""
        WITH cars AS (
            SELECT session_key, driver_number, max(lap_number) AS latest_lap_number, max(lap_started_at) AS latest_lap_started_at
            FROM {{marts}}.fct_lap WHERE session_key = {_NEWEST_SESSION} GROUP BY session_key, driver_number
        ), tyres AS (
            SELECT session_key, driver_number, stint_number, compound, lap_start FROM (
                SELECT s.*, row_number() OVER (
                           PARTITION BY s.session_key, s.driver_number
                           ORDER BY s.stint_number DESC NULLS LAST, s.compound DESC NULLS LAST, s.lap_start DESC NULLS LAST) AS _rn
                FROM {{staging}}.stg_openf1__stints s JOIN cars c
                  ON s.session_key = c.session_key AND s.driver_number = c.driver_number
                 AND c.latest_lap_number BETWEEN s.lap_start AND s.lap_end
                WHERE s.session_key = {_NEWEST_SESSION}) WHERE _rn = 1
        ), recent AS (
            SELECT session_key, driver_number, avg(lap_time_ms) AS last_5_laps_avg_ms FROM (
                SELECT session_key, driver_number, lap_time_ms, row_number() OVER (
                           PARTITION BY session_key, driver_number
                           ORDER BY lap_number DESC NULLS LAST, lap_time_ms DESC NULLS LAST) AS _rn
                FROM {{marts}}.fct_lap WHERE session_key = {_NEWEST_SESSION}) WHERE _rn <= 5 GROUP BY session_key, driver_number
        )
        SELECT c.session_key, {_SESSION_LABEL.replace("session_key", "c.session_key")} AS session_label,
               c.driver_number, {_DRIVER_LABEL.replace("driver_number", "c.driver_number")} AS driver_label,
               c.latest_lap_number, c.latest_lap_started_at, t.compound, t.stint_number AS current_stint,
               c.latest_lap_number - t.lap_start + 1 AS tire_age_laps, r.last_5_laps_avg_ms, p.pace_ratio,
               timestampdiff(MINUTE, c.latest_lap_started_at, current_timestamp()) < {LIVE_MINUTES} AS is_live_proxy
        FROM cars c
        LEFT JOIN tyres t ON t.session_key = c.session_key AND t.driver_number = c.driver_number
        LEFT JOIN recent r ON r.session_key = c.session_key AND r.driver_number = c.driver_number
        LEFT JOIN {{marts}}.fct_driver_pace p ON p.session_key = c.session_key AND p.driver_number = c.driver_number""",
    "vw_dashboard_pace_by_compound": f"""
        SELECT session_key, {_SESSION_LABEL} AS session_label, driver_number, {_DRIVER_LABEL} AS driver_label, compound,
               clean_air_laps, median_corrected_ms, median_corrected_s, pace_ratio
        FROM {{marts}}.fct_clean_air_pace""",
}


def text_of(name: str, databases: dict[str, str]) -> str:
    """The SQL of a view over the databases of a warehouse, by layer."""
    quoted = {layer: f"`{database}`" for layer, database in databases.items()}
    return VIEWS[name].format(**quoted)
