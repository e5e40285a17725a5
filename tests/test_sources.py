"""Landing, routing, loading, quarantine, audit and selection."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pitwall.functions.columns import ingest_ts
from pitwall.sources import lake, selection
from pitwall.sources.audit import audit_log
from pitwall.sources.schemas import CONTRACTS, schema_for, sql_type
from pitwall.sources.warehouse import expire_quarantine, layer_name

STAMP = "20260308T060000Z"


def put(root, key, *lines):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines))


def lap(n, **other):
    return {"session_key": 1, "driver_number": 44, "lap_number": n, "lap_duration": 90.5,
            "date_start": "2026-03-08T04:00:00.123000+00:00", "is_pit_out_lap": False, **other}


def laps_key(name, session=1):
    return f"raw/source=openf1/endpoint=laps/session={session}/{name}-{STAMP}.ndjson"


@pytest.fixture
def lake_root(tmp_path):
    root = tmp_path / "lake"
    root.mkdir()
    return root


def test_schema_registry(spark):
    assert len(CONTRACTS) == 7
    assert schema_for("ergast", "driverStandings") == schema_for("ergast", "driverstandings")
    assert schema_for("openf1", "weather") is None
    results = schema_for("ergast", "results")
    race = results["RaceTable"].dataType["Races"].dataType.elementType
    assert race["Results"].dataType.elementType["points"].dataType.simpleString() == "bigint"
    standing = schema_for("ergast", "driverstandings")["StandingsTable"].dataType["StandingsLists"].dataType.elementType
    assert standing["DriverStandings"].dataType.elementType["positionText"].dataType.simpleString() == "bigint"


def test_layer_names():
    assert layer_name(" staging ") == "f1_staging"
    assert layer_name(None, "dev") == "dev"


def test_file_level_quarantine(spark, lake_root, warehouse, rows):
    put(lake_root, laps_key("good"), lap(1), lap(2, lap_duration="91.25", driver_number="44"), "", lap(3, unknown=[1, None]))
    put(lake_root, laps_key("broken"), lap(4), "not json", lap(5))
    put(lake_root, laps_key("unfit"), lap(6), lap(7, lap_number="R"))
    summary = lake.load_batch(spark, str(lake_root), warehouse, "b1")
    assert summary == {
        "endpoints": ["laps"], "files_loaded": 1, "files_quarantined": 2, "files_skipped": 0, "rows_loaded": 3,
    }
    loaded = warehouse.source("openf1", "laps")
    assert rows(loaded, "lap_number", "lap_duration", "driver_number") == [(1, 90.5, 44), (2, 91.25, 44), (3, 90.5, 44)]
    assert loaded.first().ingest_ts == dt.datetime(2026, 3, 8, 6, 0, 0)
    assert loaded.first().date_start == dt.datetime(2026, 3, 8, 4, 0, 0, 123000)
    assert dict(loaded.dtypes)["lap_number"] == "bigint"

    held = spark.read.parquet(warehouse.path("raw", "raw_quarantine"))
    assert rows(held.groupBy("reason").count()) == [("malformed_json", 3), ("type_mismatch", 2)]
    assert {r.object_key for r in held.collect()} == {
        "raw_quarantine/" + laps_key("broken"), "raw_quarantine/" + laps_key("unfit"),
    }
    audit = audit_log(warehouse)
    assert rows(audit, "event", "severity", "output_rows", "reason", "schema_source") == [
        ("loaded", "INFO", 3, None, "file"),
        ("quarantined", "ERROR", 0, "malformed_json", "file"),
        ("quarantined", "ERROR", 0, "type_mismatch", "file"),
    ]


def test_repeating_a_batch_changes_nothing(spark, lake_root, warehouse, rows):
    put(lake_root, laps_key("a"), lap(1))
    put(lake_root, laps_key("b"), "oops")
    for _ in range(2):
        lake.load_batch(spark, str(lake_root), warehouse, "b1")
    assert warehouse.source("openf1", "laps").count() == 1
    assert spark.read.parquet(warehouse.path("raw", "raw_quarantine")).count() == 1
    assert audit_log(warehouse).count() == 2
    lake.load_batch(spark, str(lake_root), warehouse, "b2")
    put(lake_root, laps_key("c"), lap(2))
    lake.load_batch(spark, str(lake_root), warehouse)
    assert warehouse.source("openf1", "laps").count() == 2
    assert spark.read.parquet(warehouse.path("raw", "raw_quarantine")).count() == 1
    assert audit_log(warehouse).count() == 3


def test_file_that_vanishes_once_read_is_loaded(spark, lake_root, warehouse, rows, monkeypatch):
    put(lake_root, laps_key("a"), lap(1))
    put(lake_root, laps_key("b"), lap(2))
    real = lake.file_summary

    def vanish(parsed):
        (lake_root / laps_key("a")).unlink(missing_ok=True)
        return real(parsed)

    monkeypatch.setattr(lake, "file_summary", vanish)
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    assert rows(audit_log(warehouse), "event", "severity", "output_rows") == [("loaded", "INFO", 1)] * 2
    assert warehouse.source("openf1", "laps").count() == 2


def test_pages_with_quoted_numbers(spark, lake_root, warehouse, rows):
    page = {
        "total": "21", "limit": "100", "offset": "0",
        "RaceTable": {"season": "2026", "Races": [
            {"season": "2026", "round": "1", "raceName": "A", "date": "2026-03-08",
             "Circuit": {"circuitId": "c", "Location": {"lat": "-37.8", "long": "144.9", "country": "AU"}},
             "Results": [{"position": "1", "points": "25", "Driver": {"driverId": "ver", "dateOfBirth": "1997-09-30"}}]},
            {"season": "2026", "round": "2", "Results": []},
        ]},
    }
    bad = json.loads(json.dumps(page))
    bad["RaceTable"]["Races"][0]["Results"][0]["points"] = "12.5 pts"
    folder = "raw/source=ergast/endpoint=results/dt=2026-03-08/"
    put(lake_root, f"{folder}season=2026-page0-{STAMP}.ndjson", page)
    put(lake_root, f"{folder}season=2026-page100-{STAMP}.ndjson", bad)
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    pages = warehouse.source("ergast", "results")
    assert rows(pages, "total", "offset") == [(21, 0)]
    race = F.col("RaceTable.Races")[0]
    assert rows(pages, race["Circuit"]["Location"]["lat"], race["Results"][0]["points"]) == [(-37.8, 25)]
    from pitwall.plans import staging

    assert rows(staging.races(pages), "round") == [(1,), (2,)]
    assert rows(staging.results(pages), "round", "driver_id") == [(1, "ver")]


def test_autodetect_without_contract(spark, lake_root, warehouse, rows):
    put(lake_root, f"raw/source=openf1/endpoint=weather/session=1/{STAMP}.ndjson", {"temp": 21.5, "rain": False}, {"temp": 22.0})
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    table = warehouse.appended("raw", "openf1_weather")
    assert rows(table, "temp", "rain") == [(21.5, False), (22.0, None)]
    assert rows(audit_log(warehouse), "schema_source") == [("autodetect",)]


def test_skipped_objects(spark, lake_root, warehouse, rows):
    put(lake_root, "raw_quarantine/raw/source=openf1/endpoint=laps/x.ndjson", "x")
    put(lake_root, "state/x.json", "{}")
    put(lake_root, laps_key("a"), lap(1))
    summary = lake.load_batch(spark, str(lake_root), warehouse, "b1")
    assert summary["files_skipped"] == 2 and summary["files_loaded"] == 1
    skipped = audit_log(warehouse).filter("event = 'skipped'")
    assert rows(skipped, "reason") == [("path_unrecognized",), ("quarantine_prefix",)]


def test_vanished_file_is_a_quarantine_miss(spark, lake_root, warehouse, rows, monkeypatch):
    put(lake_root, laps_key("a"), "oops")
    real = lake.quarantine

    def vanish(bad, *args):
        real(bad.filter("false"), *args)

    monkeypatch.setattr(lake, "quarantine", vanish)
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    assert rows(audit_log(warehouse), "event", "severity") == [("quarantine_miss", "ERROR")]


def test_land_rows_and_load_back(spark, lake_root, warehouse, rows):
    fetched = F.lit("2026-03-08 06:00:00").cast("timestamp")
    data = spark.createDataFrame([lap(n, session_key=s) for s in (1, 2) for n in (1, 2, 3)])
    data = data.withColumn("segments_sector_1", F.array(F.lit(1), F.lit(None)))
    lake.land_rows(data, str(lake_root), "openf1", "laps", fetched)
    files = sorted(lake_root.rglob("*.json"))
    assert [f.parent.parent.name for f in files] == ["session=1", "session=2"]
    assert "segments_sector_1" not in files[0].read_text()
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    loaded = warehouse.source("openf1", "laps")
    assert loaded.count() == 6 and loaded.first().ingest_ts == dt.datetime(2026, 3, 8, 6, 0, 0)


def test_poll_lands_active_sessions_only(spark, lake_root):
    laps = spark.createDataFrame([lap(n, session_key=s) for s in (1, 2, 3) for n in (1, 2)])
    stints = spark.createDataFrame([(1, 44, 1)], "session_key long, driver_number long, stint_number long")
    sessions = spark.createDataFrame(
        [(1, "2026-03-08 05:00:00", None), (2, "2026-03-08 05:00:00", "2026-03-08 05:30:00"), (3, "2026-03-08 05:30:00", None)],
        "session_key long, s string, e string",
    )
    sessions = sessions.select(
        "session_key", F.col("s").cast("timestamp").alias("date_start"), F.col("e").cast("timestamp").alias("date_end")
    )
    feeds, at = {"laps": laps, "stints": stints}, dt.datetime(2026, 3, 8, 6, 0, 0)
    assert lake.land_poll(feeds, sessions, str(lake_root), at) == {
        "endpoints": ["laps", "stints"], "sessions": 2, "files_written": 3, "rows_written": 5,
    }
    later = dt.datetime(2026, 3, 8, 12, 0, 0)
    assert lake.land_poll(feeds, sessions, str(lake_root), later) is None
    assert lake.land_poll(feeds, sessions, str(lake_root), later, session_keys=[2])["rows_written"] == 2
    assert lake.landing_summary(spark, str(lake_root), dt.datetime(2020, 1, 1))["files_written"] == 0


def test_land_no_rows_writes_no_file(spark, lake_root):
    fetched = F.lit("2026-03-08 06:00:00").cast("timestamp")
    lake.land_rows(spark.createDataFrame([lap(1)]).limit(0), str(lake_root), "openf1", "laps", fetched)
    assert not list(lake_root.rglob("*.json"))


def test_land_pages_one_file_each(spark, lake_root):
    fetched = F.lit("2026-03-08 06:00:00").cast("timestamp")
    pages = spark.range(3).coalesce(1).selectExpr("id * 100 as offset", "'21' as total")
    for _ in range(2):
        lake.land_pages(pages, str(lake_root), "ergast", "results", fetched)
    files = list(lake_root.rglob("*.json"))
    assert len(files) == 6
    assert {f.parent.name for f in files} == {f"fetch={STAMP}"}
    assert {f.parent.parent.parent.name + "/" + f.parent.parent.name for f in files} == {
        f"season=all/page={n}" for n in (0, 100, 200)
    }
    assert all(len(f.read_text().splitlines()) == 1 for f in files)


# --- selection ---


def test_active_sessions(spark, rows):
    now = F.lit("2026-03-08 06:00:00.5").cast("timestamp")
    data = [
        ("ended", "2026-03-08 04:30:00", "2026-03-08 05:59:59"),
        ("running", "2026-03-08 05:00:00", "2026-03-08 06:00:00"),
        ("open", "2026-03-08 06:00:00.9", None),
        ("future", "2026-03-08 06:00:01", None),
        ("early", "2026-03-08 03:59:59", None),
        ("no start", None, None),
    ]
    df = spark.createDataFrame(data, "session_key string, s string, e string").select(
        "session_key", F.col("s").cast("timestamp").alias("date_start"), F.col("e").cast("timestamp").alias("date_end")
    )
    assert rows(selection.active_sessions(df, now), "session_key") == [("no start",), ("open",), ("running",)]
    assert selection.gate(df.filter("session_key = 'ended'"), now) is None
    assert selection.gate(df, now).count() == 3


def test_select_slice_defaults(spark, rows):
    year = dt.datetime.now(dt.timezone.utc).year
    df = spark.createDataFrame([("results", year), ("laps", year), ("results", year - 1)], "endpoint string, season long")
    assert rows(selection.select_slice(df)) == [("results", year)]
    assert rows(selection.select_slice(df, season=year - 1, endpoints=" results ,, ")) == [("results", year - 1)]


def test_page_audit(spark, rows):
    data = [
        ("a", "250", 0), ("a", "250", 100), ("b", "200", 0), ("b", "200", 100), ("c", None, 0), ("d", "n/a", 0),
        ("e", "0", 0), ("f", "101", 100),
    ]
    pages = spark.createDataFrame(data, "season string, total string, offset long")
    pages = pages.selectExpr("'s' as source", "'e' as endpoint", "*")
    assert rows(selection.missing_pages(pages), "season", "missing_offset") == [("a", 200), ("f", 0)]
    audit = selection.page_audit(pages)
    assert rows(audit, "season", "expected", "landed", "missing", "first_missing_offset") == [
        ("a", 3, 2, 1, 200), ("b", 2, 2, 0, None), ("c", 1, 1, 0, None), ("d", 1, 1, 0, None), ("e", 1, 1, 0, None),
        ("f", 2, 1, 1, 0),
    ]


def test_page_audit_of_a_very_long_walk(spark):
    schema = "source string, endpoint string, season long, total string, offset long"
    pages = spark.createDataFrame([("s", "e", 1, "5000000", 100)], schema)
    assert selection.missing_pages(pages).count() == 49_999


def test_quarantine_retention(spark, lake_root, warehouse, rows):
    df = spark.createDataFrame([("2026-01-01 00:00:00",), ("2026-01-02 12:00:00",)], "t string")
    df = df.select(F.col("t").cast("timestamp").alias("quarantined_at"))
    assert expire_quarantine(df, "2026-02-01 00:00:00").count() == 1
    for day in ("2026-01-01", "2026-01-30"):
        put(lake_root, laps_key(day), "oops")
        lines = lake.read_lines(spark, str(lake_root), str(lake_root))
        lake.load_lines(lines, warehouse, f"b-{day}", F.lit(day).cast("timestamp"))
    assert warehouse.purge_quarantine(dt.date(2026, 2, 5)) == 1
    held = spark.read.parquet(warehouse.path("raw", "raw_quarantine"))
    assert rows(held, "quarantined_on") == [(dt.date(2026, 1, 30),)]


def test_object_key(spark):
    for root, path in [
        ("/data/lake", "file:///data/lake/raw/x"), ("file:/data/lake/", "file:///data/lake/raw/x"),
        ("s3a://bucket/lake", "s3a://bucket/lake/raw/x"),
    ]:
        assert spark.range(1).select(lake.object_key(F.lit(path), root)).first()[0] == "raw/x"


@pytest.mark.parametrize("zone", ["UTC", "Europe/Madrid", "America/New_York"])
def test_stamps_are_utc_in_any_session(spark, lake_root, zone):
    # the second instant is an hour that Madrid's clocks skip
    instants = [dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc), dt.datetime(2024, 3, 31, 2, 30, tzinfo=dt.timezone.utc)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for instant in instants:
            fetched = F.timestamp_seconds(F.lit(int(instant.timestamp())))
            lake.land_pages(spark.range(1), str(lake_root), "ergast", "results", fetched)
            lake.land_rows(spark.range(1).selectExpr("id as session_key"), str(lake_root), "openf1", "weather", fetched)
            summary = lake.landing_summary(spark, str(lake_root), instant)
            assert (summary["files_written"], summary["rows_written"]) == (2, 2)
            key = F.lit(f"raw/source=ergast/endpoint=results/x-{instant:%Y%m%dT%H%M%SZ}.ndjson")
            assert spark.range(1).select(F.unix_seconds(ingest_ts(key))).first()[0] == int(instant.timestamp())
        days = {p.name for p in (lake_root / "raw/source=ergast/endpoint=results").iterdir() if p.is_dir()}
        assert days == {"dt=2024-01-01", "dt=2024-03-31"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_table_without_contract_keeps_its_first_types(spark, lake_root, warehouse, rows):
    key = f"raw/source=openf1/endpoint=weather/session=1/{{}}-{STAMP}.ndjson"
    put(lake_root, key.format("first"), {"a": 1, "b": {"c": [1.5]}})
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    put(lake_root, key.format("text"), {"a": "text"})
    put(lake_root, key.format("more"), {"a": "2", "b": {"c": [2, 3]}, "new": True})
    summary = lake.load_batch(spark, str(lake_root), warehouse, "b2")
    assert (summary["files_loaded"], summary["files_quarantined"]) == (1, 1)
    table = warehouse.appended("raw", "openf1_weather")
    assert rows(table, "a", "b.c", "new") == [(1, [1.5], None), (2, [2.0, 3.0], True)]


@pytest.mark.parametrize("files_per_load", [1, 2, 10_000])
def test_new_fields_are_kept_or_their_file_rejected(spark, lake_root, warehouse, rows, monkeypatch, files_per_load):
    monkeypatch.setattr(lake, "FILES_PER_LOAD", files_per_load)
    key = f"raw/source=openf1/endpoint=weather/session=1/{{}}-{STAMP}.ndjson"
    put(lake_root, key.format("a"), "broken", {"temp": 19})
    put(lake_root, key.format("b"), {"temp": 20, "wind": {"speed": 1.5}, "gone": None})
    put(lake_root, key.format("c"), {"temp": 21, "rain": False}, {"temp": 22, "gone": "back"})
    put(lake_root, key.format("d"), {"temp": 23, "wind": {"speed": 2, "gust": 3}})
    put(lake_root, key.format("e"), {"temp": 24, "wind": 7})
    put(lake_root, key.format("f"), {"temp": 25, "rain": "a bit", "late": [1, 2]})
    lake.load_batch(spark, str(lake_root), warehouse)
    table = warehouse.appended("raw", "openf1_weather")
    assert rows(table, "temp", "rain", "wind.speed", "gone") == [
        (20, None, 1.5, None), (21, False, None, None), (22, None, None, "back"),
    ]
    held = warehouse.appended("raw", "raw_quarantine").select("moved_from", "reason").distinct()
    assert rows(held.select(F.regexp_extract("moved_from", r"/(\w)-", 1), "reason")) == [
        ("a", "malformed_json"), ("d", "type_mismatch"), ("e", "type_mismatch"), ("f", "type_mismatch"),
    ]


def test_types_of_variants():
    kinds = {
        "BIGINT": "bigint", "DECIMAL(3,1)": "double", "DECIMAL(1,0)": "bigint", "DECIMAL(25,0)": "decimal(38,0)",
        "OBJECT<OBJECT: BIGINT, `a OBJECT b`: ARRAY<VOID>, c: VARIANT>": "struct<OBJECT:bigint,a OBJECT b:array<string>,c:string>",
    }
    assert {k: sql_type(k).simpleString() for k in kinds} == kinds
    assert sql_type("VOID") is None


def test_nodes_of_the_wrong_kind_are_rejected(spark, lake_root, warehouse, rows):
    stint = {"session_key": 1, "driver_number": 44, "stint_number": 1, "lap_start": 1, "lap_end": 9, "compound": "SOFT"}
    key = f"raw/source=openf1/endpoint=stints/session=1/{{}}-{STAMP}.ndjson"
    for name, value in (("object", {"x": 1}), ("list", ["SOFT"]), ("number", 5), ("null", None)):
        put(lake_root, key.format(name), {**stint, "compound": value})
    put(lake_root, key.format("line"), stint, "[1]")
    folder = "raw/source=ergast/endpoint=results/dt=2026-03-08/"
    put(lake_root, f"{folder}season=2026-page0-{STAMP}.ndjson", {"total": "1", "RaceTable": []})
    put(lake_root, f"{folder}season=2026-page100-{STAMP}.ndjson", {"total": "1", "RaceTable": {"Races": {"round": 1}}})
    lake.load_batch(spark, str(lake_root), warehouse, "b1")
    assert rows(warehouse.source("openf1", "stints"), "compound") == [("5",), (None,)]
    held = warehouse.appended("raw", "raw_quarantine").select("moved_from", "reason").distinct()
    assert [r[1] for r in rows(held)] == ["type_mismatch"] * 2 + ["malformed_json"] + ["type_mismatch"] * 2


def test_blank_files_are_finished(spark, lake_root, warehouse, rows):
    put(lake_root, laps_key("blank"), "", "  ")
    (lake_root / laps_key("empty")).write_text("")  # no reader lists it
    put(lake_root, laps_key("good"), lap(1))
    assert lake.load_batch(spark, str(lake_root), warehouse)["files_skipped"] == 1
    assert rows(audit_log(warehouse), "event", "reason") == [("loaded", None), ("skipped", "no_lines")]
    again = lake.load_batch(spark, str(lake_root), warehouse)
    assert again == {"endpoints": [], "files_loaded": 0, "files_quarantined": 0, "files_skipped": 0, "rows_loaded": 0}


def test_file_that_vanishes_before_it_is_read(spark, lake_root, warehouse, monkeypatch):
    put(lake_root, laps_key("a"), lap(1))
    put(lake_root, laps_key("b"), lap(2))
    real = lake._read_present

    def vanish(spark_, paths, root):
        (lake_root / laps_key("a")).unlink(missing_ok=True)
        return real(spark_, paths, root)

    monkeypatch.setattr(lake, "_read_present", vanish)
    assert lake.load_batch(spark, str(lake_root), warehouse)["rows_loaded"] == 1
    assert audit_log(warehouse).count() == 1


def test_landing_writes_the_audit_and_pages_are_audited(spark, lake_root, warehouse, rows):
    fetched = F.lit("2026-03-08 06:00:00").cast("timestamp")
    pages = spark.createDataFrame([("250", 0), ("250", 200)], "total string, offset long")
    for season in (2025, 2026):
        lake.land_pages(pages.limit(1 if season == 2025 else 2), str(lake_root), "ergast", "results", fetched, season=season, warehouse=warehouse)
    landed = lake.landed_pages(spark, str(lake_root), "ergast")
    assert rows(selection.select_slice(landed, season=2026), "season", "offset") == [(2026, 0), (2026, 200)]
    missing = [("results", 2025, 100), ("results", 2025, 200), ("results", 2026, 100)]
    assert rows(selection.missing_pages(landed), "endpoint", "season", "missing_offset") == missing
    assert rows(selection.page_audit(landed), "season", "expected", "missing") == [(2025, 3, 2), (2026, 3, 1)]
    assert rows(audit_log(warehouse), "event", "service", "endpoint", "output_rows") == [
        ("landed", "landing", "results", 1), ("landed", "landing", "results", 2),
    ]


def test_loads_read_the_audit_of_their_days_only(spark, warehouse):
    plan = lake.finished_files(warehouse, ["20260308"])
    assert plan.count() == 0
    lake.write_events(warehouse, "loader", [{"event": "loaded", "severity": "INFO", "object_key": laps_key("a")}])
    text = lake.finished_files(warehouse, ["20260308"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_day" in text or "PartitionFilters: [(key_day" in text or "key_day" in text.split("PartitionFilters")[1].split("]")[0]


def test_an_audit_reads_the_landed_pages_once(spark, lake_root, rows):
    fetched = F.lit("2026-03-08 06:00:00").cast("timestamp")
    pages = spark.createDataFrame([("250", 0), ("250", 200)], "total string, offset long")
    lake.land_pages(pages, str(lake_root), "ergast", "results", fetched, season=2026)
    audit = selection.page_audit(lake.landed_pages(spark, str(lake_root), "ergast"))
    assert "text" not in audit._jdf.queryExecution().executedPlan().toString()
    assert rows(audit, "season", "expected", "landed", "missing", "first_missing_offset") == [(2026, 3, 2, 1, 100)]
