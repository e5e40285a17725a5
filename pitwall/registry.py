"""Every relation and operator as a query over the driver's test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall import testdata as td
from pitwall.functions.columns import ingest_ts, median_element, minutes_since, to_seconds, trunc_second
from pitwall.functions.labels import with_driver_label, with_session_label
from pitwall.operators.joins import laps_in_stint, latest_session, orphans, with_session_max
from pitwall.operators.latest import count_rows, last_n_avg, max_by_group, top_n
from pitwall.operators.medians import group_medians, with_group_median
from pitwall.plans import checks, dashboards, marts, staging
from pitwall.plans.views import text_of
from pitwall.session import materialise, materialise_observed, scratch_dir
from pitwall.sources import selection
from pitwall.sources.lake import (
    detect,
    file_summary,
    land_pages,
    landed_pages,
    parse,
    pending_files,
    route,
    split_quarantine,
    typed,
)
from pitwall.sources.schemas import schema_for
from pitwall.sources.warehouse import Warehouse, expire_quarantine
from pitwall.streaming.alerts import alerts
from pitwall.streaming.live import refresh_live

Query = Callable[[SparkSession, str], DataFrame]

LIVE_AS_OF = "2024-01-31 00:30:00"
GATE_AS_OF = "2024-01-16 12:00:00"
GATE_HOURS = 24 * 10
RETENTION_AS_OF = "2024-02-10 00:00:00"


def _ts(text: str):
    return F.lit(text).cast("timestamp")


# --- relations ---


def races(spark, sf):
    return staging.races(td.raw_results(spark, sf))


def results(spark, sf):
    return staging.results(td.raw_results(spark, sf))


def qualifying(spark, sf):
    return staging.qualifying(td.raw_qualifying(spark, sf))


def drivers(spark, sf):
    return staging.drivers(td.raw_drivers(spark, sf))


def standings(spark, sf):
    return staging.driver_standings(td.raw_standings(spark, sf))


def laps(spark, sf):
    return staging.laps(td.raw_laps(spark, sf))


def stints(spark, sf):
    return staging.stints(td.raw_stints(spark, sf))


def fct_lap(spark, sf):
    return marts.fct_lap(laps(spark, sf))


def lap_table(spark, sf):
    """fct_lap as the table that its consumers read."""
    return materialise(fct_lap(spark, sf), "fct_lap")


def dim_driver(spark, sf):
    return marts.dim_driver(drivers(spark, sf), results(spark, sf))


def dim_race(spark, sf):
    return marts.dim_race(races(spark, sf))


def race_summary(spark, sf):
    return marts.driver_race_summary(results(spark, sf), qualifying(spark, sf))


def driver_pace(spark, sf):
    return marts.driver_pace(lap_table(spark, sf))


def clean_air_pace(spark, sf):
    return marts.clean_air_pace(lap_table(spark, sf), materialise(stints(spark, sf), "stints"))


def pace_by_compound(spark, sf):
    return dashboards.pace_by_compound(clean_air_pace(spark, sf))


def overview(spark, sf):
    summary = materialise(race_summary(spark, sf), "race_summary")
    return dashboards.overview(summary, dim_driver(spark, sf), dim_race(spark, sf))


def championship(spark, sf):
    return dashboards.championship(race_summary(spark, sf), dim_driver(spark, sf))


def race_deep_dive(spark, sf):
    table = lap_table(spark, sf)
    return dashboards.race_deep_dive(table, marts.driver_pace(table))


def race_selector(spark, sf):
    return dashboards.select_race(race_deep_dive(spark, sf), "2026 Australian GP")


def live_state(spark, sf):
    table = lap_table(spark, sf)
    return dashboards.live_state(table, stints(spark, sf), marts.driver_pace(table), _ts(LIVE_AS_OF))


# --- selection, routing, audit ---


def active_sessions(spark, sf):
    return selection.active_sessions(td.sessions(spark, sf), _ts(GATE_AS_OF), GATE_HOURS)


def backfill_session(spark, sf):
    return selection.select_sessions(td.raw_laps(spark, sf), [11230, 11234])


def route_paths(spark, sf):
    routed = route(td.lake_objects(spark, sf))
    return routed.withColumn("fetched_at", ingest_ts(F.col("object_key")))


def select_slice(spark, sf):
    season = F.regexp_extract("object_key", r"season=(\d+)-", 1).try_cast("bigint")
    objects = route(td.lake_objects(spark, sf)).withColumn("season", season)
    wanted = selection.select_slice(objects, season=2024, endpoints=" results, ,driverStandings,")
    return wanted.select("object_key", "endpoint", "season")


def sanitize(spark, sf):
    segments = {f"segments_sector_{i}": F.array("i1_speed", F.lit(None), "st_speed") for i in (1, 2, 3)}
    return selection.sanitize(td.raw_laps(spark, sf).withColumns(segments), "laps")


def page_audit(spark, sf):
    return selection.page_audit(td.page_log(spark, sf))


def missing_pages(spark, sf):
    return selection.missing_pages(td.page_log(spark, sf))


def accepted_lines(spark, sf):
    """Rows of the files without a bad line, under the contract types."""
    schema = schema_for("openf1", "laps")
    good, _ = split_quarantine(_parsed(spark, sf))
    return typed(good, schema).drop("ingest_ts")


def _parsed(spark, sf):
    """The lines, parsed once; several consumers read what they need of them."""
    return materialise(parse(td.lake_lines(spark, sf), schema_for("openf1", "laps")).drop("value"), "parsed")


def rejected_lines(spark, sf):
    """All lines of the files with a bad one."""
    _, bad = split_quarantine(_parsed(spark, sf))
    return bad.select("object_key", "file_reason", F.col("reason").alias("line_reason"), "event_id")


def lake_files(spark, sf):
    files = file_summary(parse(td.lake_lines(spark, sf), schema_for("openf1", "laps")))
    return files.select("object_key", "lines", "reason")


def strict_lines(spark, sf):
    """Stint lines of the files in which no text is an object or a list."""
    schema = schema_for("openf1", "stints")
    parsed = materialise(parse(td.stint_lines(spark, sf), schema).drop("value"), "parsed")
    good, _ = split_quarantine(parsed)
    return good.select("object_key", "event_id", "record.compound", "record.lap_start", "record.lap_end")


def drifted_lines(spark, sf):
    """Files of an endpoint without a contract, judged by the columns that its first files give."""
    lines = td.weather_lines(spark, sf)
    parsed = materialise(parse(lines, detect(lines, None), strict=True).drop("value"), "parsed")
    return file_summary(parsed).select("object_key", "lines", "reason")


def unfinished_files(spark, sf):
    """Objects that a load has not finished, by an audit log that knows a third of them as loaded and a third as missed."""
    objects = td.lake_objects(spark, sf)
    event = F.when(F.col("event_id") % 3 == 0, "loaded").otherwise("load_miss")
    audit = objects.filter("event_id % 3 < 2").select("object_key", event.alias("event"))
    return pending_files(objects.select("object_key").distinct(), audit)


def landed_page_audit(spark, sf):
    """Pages of all seasons landed in a lake, some lost on the way, and audited by what lies there."""
    root = f"{scratch_dir(spark)}/pitwall/lake-{uuid.uuid4().hex}"
    pages = td.raw_results(spark, sf).dropDuplicates(["RaceTable", "offset"])
    season = F.col("RaceTable.season")
    landed = pages.filter((F.col("offset") == 0) | ((season + F.expr("offset div 100")) % 5 != 3))
    land_pages(landed, root, "ergast", "results", _ts(GATE_AS_OF), pages_per_file=1, season=season)
    return materialise(selection.page_audit(landed_pages(spark, root, "ergast")), "page_audit")


@contextmanager
def _warehouse(spark):
    """A warehouse with databases of its own, dropped at the end."""
    warehouse = Warehouse(spark, f"{scratch_dir(spark)}/pitwall/warehouse-{uuid.uuid4().hex}", f"q{uuid.uuid4().hex}")
    try:
        yield warehouse
    finally:
        for layer in ("raw", "staging", "marts"):
            spark.sql(f"DROP DATABASE IF EXISTS `{warehouse.database(layer)}` CASCADE")


def live_incremental(spark, sf):
    """The live page after three loads, each of which extends the state and refreshes the page."""
    with _warehouse(spark) as warehouse:
        rows, parts = materialise(td.raw_laps(spark, sf), "raw_laps"), warehouse.partition_of("openf1", "laps")
        warehouse.append("raw", "openf1_stints", td.raw_stints(spark, sf), "load-0-stints", parts)
        for load in range(3):
            part = rows.filter(F.col("lap_number") % 3 == load)
            warehouse.append("raw", "openf1_laps", part, f"load-{load}-laps", parts)
            live = refresh_live(warehouse, _ts(LIVE_AS_OF), f"load-{load}")
        return materialise(live, "live_state")


def served_race(spark, sf):
    """The race page as another session reads it from the catalog."""
    with _warehouse(spark) as warehouse:
        table, _ = warehouse.replace("marts", "fct_lap", fct_lap(spark, sf), ("session_key", "driver_number"))
        warehouse.replace("marts", "fct_driver_pace", marts.driver_pace(table))
        databases = {layer: warehouse.database(layer) for layer in ("raw", "staging", "marts")}
        warehouse.view("marts", "vw_dashboard_race", text_of("vw_dashboard_race", databases))
        page = spark.newSession().table(warehouse.relation("marts", "vw_dashboard_race"))
        return spark.read.schema(page.schema).parquet(_written(page))


def _written(df):
    """Where a relation of another session is written."""
    path = f"{scratch_dir(df.sparkSession)}/pitwall/page-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def sketch_pace(spark, sf):
    """Clean-air pace from sketches that two loads of sessions have stored."""
    table, tyres = lap_table(spark, sf), materialise(stints(spark, sf), "stints")
    loads = [marts.pace_sketches(table.filter(F.col("session_key") % 2 == n), tyres) for n in range(2)]
    return marts.sketch_pace(materialise(loads[0].unionByName(loads[1]), "sketches"))


def quarantine_retention(spark, sf):
    return expire_quarantine(td.quarantined(spark, sf), RETENTION_AS_OF, 30)


def alert_times(spark, sf):
    return alerts(td.audit_log(spark, sf), td.SERVICES)


# --- operators on their own ---


def session_list(spark, sf):
    return max_by_group(laps(spark, sf), ["session_key"], last_lap="lap_number", last_start="lap_started_at")


def lap_counts(spark, sf):
    return count_rows(laps(spark, sf), ["session_key", "driver_number"], "laps")


def newest_session(spark, sf):
    return latest_session(laps(spark, sf))


def last_five_laps(spark, sf):
    return last_n_avg(
        laps(spark, sf), ["session_key", "driver_number"], "lap_number", "lap_time_ms", "last_5_laps_avg_ms"
    )


def fastest_laps(spark, sf):
    rows = laps(spark, sf).select("session_key", "driver_number", "lap_number", "lap_time_ms")
    order = [F.col(c).asc_nulls_last() for c in ("lap_time_ms", "driver_number", "lap_number")]
    return top_n(rows, ["session_key"], order, 3)


def laps_on_stint(spark, sf):
    rows = laps(spark, sf).select("session_key", "driver_number", "lap_number", "lap_time_ms")
    return laps_in_stint(rows, stints(spark, sf), ["compound", "stint_number"], skip_first=False)


def race_distance(spark, sf):
    rows = with_session_max(laps(spark, sf).select("session_key", "driver_number", "lap_number"))
    return rows.withColumn("laps_to_go", F.col("session_max_lap") - F.col("lap_number"))


def field_median(spark, sf):
    rows = lap_table(spark, sf).select("session_key", "driver_number", "lap_number", "lap_time_ms")
    return with_group_median(rows, ["session_key", "lap_number"], "lap_time_ms", "field_median_ms")


def session_median(spark, sf):
    return group_medians(lap_table(spark, sf), ["session_key"], {"session_median_ms": "lap_time_ms"})


def stint_length_median(spark, sf):
    known = stints(spark, sf).groupBy("session_key", "compound")
    return known.agg(median_element(F.col("total_laps")).alias("median_laps"))


def lap_clock(spark, sf):
    started = F.col("lap_started_at")
    return laps(spark, sf).select(
        "session_key",
        "driver_number",
        "lap_number",
        trunc_second(started).alias("started_second"),
        minutes_since(started, _ts(LIVE_AS_OF)).alias("minutes_ago"),
        to_seconds(F.col("lap_time_ms")).alias("lap_time_s"),
    )


def labelled_cars(spark, sf):
    cars = td.timed_events(spark, sf).select("session_key", "driver_number").distinct()
    names = spark.createDataFrame([(3, "Three"), (4, "Four")], "number long, name string")
    return with_session_label(with_driver_label(cars, names))


def amended_results(spark, sf):
    """An amended copy of every page landed later: the newest copy per key wins."""
    pages = td.raw_results(spark, sf).withColumn("ingest_ts", _ts("2024-01-01 06:00:00"))
    races_ = F.transform(
        "RaceTable.Races",
        lambda race: race.withField(
            "Results", F.transform(race["Results"], lambda r: r.withField("points", r["points"] + 1))
        ),
    )
    amended = pages.withColumn("RaceTable", F.col("RaceTable").withField("Races", races_))
    later = amended.withColumn("ingest_ts", _ts("2024-01-02 06:00:00"))
    return staging.results(pages.unionByName(later), latest_by_key=True)


# --- data tests ---


def check_not_null(spark, sf):
    rows = td.raw_laps(spark, sf)
    return checks.not_null(rows, ["session_key", "lap_duration", "is_pit_out_lap", "ingest_ts"])


def check_unique(spark, sf):
    return checks.duplicates(td.raw_laps(spark, sf), ["session_key", "driver_number", "lap_number"])


def check_relationships(spark, sf):
    """Drivers that took part in no race."""
    return orphans(drivers(spark, sf), "driver_id", results(spark, sf), "driver_id")


def check_models(spark, sf):
    """The declared tests of the season models, one row per test."""
    models = {"dim_driver": dim_driver, "dim_race": dim_race, "fct_driver_race_summary": race_summary}
    ref, seen = {}, {}
    for name, model in models.items():
        ref[name], seen[name] = materialise_observed(model(spark, sf), name, checks.null_counts(checks.CHECKS[name].not_null))
    parts = [checks.run_checks(df, name, checks.CHECKS[name], ref.__getitem__, seen[name]) for name, df in ref.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES: dict[str, Query] = {
    "unnest_races": races,
    "unnest_results": results,
    "unnest_qualifying": qualifying,
    "unnest_drivers": drivers,
    "standings_latest": standings,
    "laps_clean": laps,
    "stints_clean": stints,
    "dim_driver": dim_driver,
    "dim_race": dim_race,
    "race_summary": race_summary,
    "fct_lap": fct_lap,
    "driver_pace": driver_pace,
    "clean_air_pace": clean_air_pace,
    "pace_by_compound": pace_by_compound,
    "overview": overview,
    "championship": championship,
    "race_deep_dive": race_deep_dive,
    "race_selector": race_selector,
    "live_state": live_state,
    "active_sessions": active_sessions,
    "select_slice": select_slice,
    "backfill_session": backfill_session,
    "sanitize": sanitize,
    "route_paths": route_paths,
    "page_audit": page_audit,
    "missing_pages": missing_pages,
    "accepted_lines": accepted_lines,
    "rejected_lines": rejected_lines,
    "lake_files": lake_files,
    "quarantine_retention": quarantine_retention,
    "alert_times": alert_times,
    "session_list": session_list,
    "lap_counts": lap_counts,
    "newest_session": newest_session,
    "last_five_laps": last_five_laps,
    "fastest_laps": fastest_laps,
    "laps_on_stint": laps_on_stint,
    "race_distance": race_distance,
    "field_median": field_median,
    "session_median": session_median,
    "stint_length_median": stint_length_median,
    "lap_clock": lap_clock,
    "labelled_cars": labelled_cars,
    "amended_results": amended_results,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_relationships": check_relationships,
    "check_models": check_models,
    "strict_lines": strict_lines,
    "drifted_lines": drifted_lines,
    "unfinished_files": unfinished_files,
    "landed_page_audit": landed_page_audit,
    "live_incremental": live_incremental,
    "served_race": served_race,
    "sketch_pace": sketch_pace,
}
