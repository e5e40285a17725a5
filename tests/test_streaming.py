"""Streams give the rows of the batch computation."""

import datetime as dt
import json
import random
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitwall.plans import staging
from pitwall.sources import lake
from pitwall.sources.audit import audit_log
from pitwall.streaming.alerts import PERIOD_SECONDS, alert_stream, alerts, rate_limit
from pitwall.streaming.ingest import compact_latest, dedupe_replays, newest_copies, read_latest, stream_lake, upsert_latest
from pitwall.streaming.live import LIVE_TABLE, STARTS, live_from_raw, live_refresher, refresh_live

AUDIT = "service string, severity string, logged_at timestamp"


def put_laps(root, stamp, laps):
    path = root / f"raw/source=openf1/endpoint=laps/session=1/{stamp}.ndjson"
    path.parent.mkdir(parents=True, exist_ok=True)
    rows = [
        {"session_key": 1, "driver_number": d, "lap_number": n, "lap_duration": s, "is_pit_out_lap": False,
         "date_start": f"2026-03-08T04:{n:02d}:00+00:00", "meeting_key": 7}
        for d, n, s in laps
    ]
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def put_stints(root, stamp, end):
    path = root / f"raw/source=openf1/endpoint=stints/session=1/{stamp}.ndjson"
    path.parent.mkdir(parents=True, exist_ok=True)
    row = {"session_key": 1, "driver_number": 44, "stint_number": 1, "lap_start": 1, "lap_end": end, "compound": "SOFT"}
    path.write_text(json.dumps(row) + "\n")


@pytest.fixture
def lake_root(tmp_path):
    root = tmp_path / "lake"
    root.mkdir()
    return root


def run_stream(spark, root, warehouse, tmp_path, **options):
    query = stream_lake(spark, str(root), warehouse, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination(120)
    assert query.exception() is None


def test_stream_equals_batch_and_loads_each_file_once(spark, lake_root, new_warehouse, tmp_path, rows):
    streamed = new_warehouse("streamed")
    put_laps(lake_root, "20260308T040100Z", [(44, 1, 90.0)])
    (lake_root / "other.txt").write_text("x\n")
    run_stream(spark, lake_root, streamed, tmp_path)
    put_laps(lake_root, "20260308T040200Z", [(44, 1, 90.0), (44, 2, 91.0)])
    bad = lake_root / "raw/source=openf1/endpoint=laps/session=1/bad.ndjson"
    bad.write_text('{"session_key": 1}\n{"lap_number": "R"}\n')
    run_stream(spark, lake_root, streamed, tmp_path, max_files=1)
    run_stream(spark, lake_root, streamed, tmp_path)

    batched = new_warehouse("batched")
    lake.load_batch(spark, str(lake_root), batched, "b")
    s, b = (w.source("openf1", "laps").drop("object_key") for w in (streamed, batched))
    assert rows(s) == rows(b) and s.count() == 3
    assert rows(staging.laps(s), "lap_number", "lap_time_ms") == [(1, 90_000), (2, 91_000)]
    event = ["event", "reason", "output_rows"]
    assert rows(audit_log(streamed), *event) == rows(audit_log(batched), *event)


def test_late_file_counts_at_the_next_build(spark, lake_root, warehouse, tmp_path, rows):
    put_laps(lake_root, "20260308T050000Z", [(44, 9, 90.0)])
    run_stream(spark, lake_root, warehouse, tmp_path)
    put_laps(lake_root, "20260301T040000Z", [(44, 1, 95.0)])
    run_stream(spark, lake_root, warehouse, tmp_path)
    assert rows(staging.laps(warehouse.source("openf1", "laps")), "lap_number") == [(1,), (9,)]


def test_live_refresh(spark, lake_root, warehouse, tmp_path):
    as_of = F.lit("2026-03-08 04:30:00").cast("timestamp")
    options = {"after": live_refresher(warehouse, as_of)}
    put_laps(lake_root, "20260308T040100Z", [(44, 1, 90.0)])
    run_stream(spark, lake_root, warehouse, tmp_path, **options)
    with pytest.raises(LookupError):
        warehouse.table("marts", LIVE_TABLE)
    put_stints(lake_root, "20260308T040200Z", 30)
    run_stream(spark, lake_root, warehouse, tmp_path, **options)
    assert warehouse.table("marts", LIVE_TABLE).first().latest_lap_number == 1
    put_laps(lake_root, "20260308T040300Z", [(44, 1, 90.0), (44, 2, 91.0)])
    run_stream(spark, lake_root, warehouse, tmp_path, **options)
    state = warehouse.table("marts", LIVE_TABLE).first()
    assert (state.latest_lap_number, state.compound, state.tire_age_laps) == (2, "SOFT", 2)
    assert state.is_live_proxy is True


def test_live_from_raw_equals_the_full_computation(spark, sf, rows):
    from pitwall import testdata as td
    from pitwall.registry import LIVE_AS_OF, live_state

    as_of = F.lit(LIVE_AS_OF).cast("timestamp")
    live = live_from_raw(td.raw_laps(spark, sf), td.raw_stints(spark, sf), as_of)
    assert rows(live) == rows(live_state(spark, sf))


KEYS, ORDER = ["session_key", "driver_number", "lap_number"], ["date_start", "ingest_ts"]


def raw_parts(spark, sf, tmp_path, parts=3):
    """The raw laps as a stream that arrives in several files."""
    from pitwall import testdata as td

    df = td.raw_laps(spark, sf)
    path = str(tmp_path / "raw")
    df.repartition(parts).write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return spark.read.parquet(path), stream


def test_upsert_latest_equals_batch(spark, sf, warehouse, tmp_path, rows):
    from pitwall.operators.latest import latest_by

    batch, stream = raw_parts(spark, sf, tmp_path)

    def sink(df, batch_id):
        for _ in range(2):  # a repeated batch changes nothing
            upsert_latest(df, batch_id, warehouse, "laps", KEYS, ORDER)

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c"))
    query.trigger(availableNow=True).start().awaitTermination(120)
    expected = rows(latest_by(batch, KEYS, ORDER))
    assert rows(read_latest(warehouse, "laps", KEYS, ORDER)) == expected
    assert compact_latest(warehouse, "laps", KEYS, ORDER) > 1
    assert rows(read_latest(warehouse, "laps", KEYS, ORDER)) == expected
    assert compact_latest(warehouse, "laps", KEYS, ORDER) == 1


@pytest.mark.parametrize("watermark", [None, "40 days"])
def test_dedupe_replays(spark, sf, tmp_path, rows, watermark):
    batch, stream = raw_parts(spark, sf, tmp_path)
    once = dedupe_replays(stream, KEYS, watermark=watermark)
    name = "replays_" + ("all" if watermark is None else "late")
    query = once.writeStream.format("memory").queryName(name).outputMode("append")
    query.trigger(availableNow=True).start().awaitTermination(120)
    assert rows(spark.table(name), *KEYS) == rows(batch.select(*KEYS).distinct())


# --- alerts ---


def test_fire_times():
    fire_times = rate_limit(PERIOD_SECONDS)
    assert fire_times(range(0, 1000, 100)) == [0, 300, 600, 900]
    assert fire_times([100, 299, 300], last=0) == [300]


@given(st.lists(st.integers(0, 5000), unique=True).map(sorted), st.integers(1, 700))
def test_fire_times_are_greedy(seconds, period):
    fired = rate_limit(period)(seconds)
    assert all(b - a >= period for a, b in zip(fired, fired[1:]))
    assert all(any(0 <= s - f < period for f in fired) for s in seconds)


def audit_rows(seconds, service="loader", severity="ERROR"):
    start = dt.datetime(2026, 3, 8, 6, 0, 0)
    return [(service, severity, start + dt.timedelta(seconds=s)) for s in seconds]


def test_alerts_batch(spark):
    data = audit_rows([0, 0.5, *range(100, 1000, 100)]) + audit_rows([50], "somebody-else") + audit_rows([60], severity="INFO")
    data += audit_rows([1000], severity="CRITICAL")
    fired = alerts(spark.createDataFrame(data, AUDIT), ["loader"])
    assert sorted(r.fired_at.minute for r in fired.collect()) == [0, 5, 10, 15]


def test_alerts_carry_over_midnight(spark):
    start = 17 * 3600 + 3600 - 20
    seconds = [*range(start - 1000, start + 1500, 7), start + 86_400, start + 3 * 86_400]
    fired = alerts(spark.createDataFrame(audit_rows(seconds), AUDIT), ["loader"])
    base = dt.datetime(2026, 3, 8, 6)
    got = sorted(int((r.fired_at - base).total_seconds()) for r in fired.collect())
    assert got == rate_limit(PERIOD_SECONDS)(sorted(seconds))


def run_alerts(spark, path, out, checkpoint, **options):
    stream = spark.readStream.schema(AUDIT).option("maxFilesPerTrigger", 1).parquet(path)
    query = alert_stream(stream, ["loader"], **options).writeStream.format("parquet").option("path", out)
    query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None


END = 40 * 86_400


@pytest.mark.parametrize("parts", [1, 6])
def test_alert_stream_equals_batch_for_any_split(spark, tmp_path, rows, parts):
    """Rows come late by up to the watermark; the last row moves the watermark over all others."""
    rng = random.Random(parts)
    seconds = [*range(0, 1500, 7), 70_000, *range(86_000, 88_000, 13), 3 * 86_400, 3 * 86_400 + 299, 3 * 86_400 + 300]
    arrival = sorted(seconds * 2, key=lambda s: s + rng.random() * 600)
    path = str(tmp_path / "audit")
    size = -(-len(arrival) // parts)
    for part in [*(arrival[i : i + size] for i in range(0, len(arrival), size)), [END], [END]]:
        spark.createDataFrame(audit_rows(part), AUDIT).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)
    run_alerts(spark, path, str(tmp_path / "fired"), str(tmp_path / "c"), watermark="10 minutes")
    batch = alerts(spark.createDataFrame(audit_rows(seconds), AUDIT), ["loader"])
    fired = spark.read.parquet(str(tmp_path / "fired"))
    assert fired.count() > 10
    assert rows(fired) == rows(batch)


def test_alert_stream_keeps_its_state_between_runs(spark, tmp_path):
    path = str(tmp_path / "audit")
    for seconds in ([0, 100, 200, 250, 300, 400], [599, 600, 900], [END], [END]):
        spark.createDataFrame(audit_rows(seconds), AUDIT).coalesce(1).write.mode("append").parquet(path)
        run_alerts(spark, path, str(tmp_path / "fired"), str(tmp_path / "c"))
    fired = spark.read.parquet(str(tmp_path / "fired"))
    assert sorted(r.fired_at.minute for r in fired.collect()) == [0, 5, 10, 15]


# --- newest copy ---


def run_newest(spark, stream, tmp_path, warehouse, keys, order, **options):
    def sink(df, batch_id):
        upsert_latest(df, batch_id, warehouse, "laps", keys, order)

    query = newest_copies(stream, keys, order, **options).writeStream.foreachBatch(sink).outputMode("update")
    query = query.option("checkpointLocation", str(tmp_path / "c"))
    if "ttl_ms" not in options:
        query = query.trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        return query.recentProgress
    # state with a time to live is looked after all the time, so such a query never comes to an end
    query, seen = query.start(), {}
    for _ in range(240):
        seen.update({p["batchId"]: p for p in query.recentProgress})
        if sum(p["numInputRows"] for p in seen.values()) >= 3 * 333_334 and max(seen) >= 3:
            break
        time.sleep(0.5)
    query.stop()
    return list(seen.values())


def test_newest_copies_equal_the_batch(spark, sf, warehouse, tmp_path, rows):
    from pitwall.operators.latest import latest_by

    batch, stream = raw_parts(spark, sf, tmp_path)
    run_newest(spark, stream, tmp_path, warehouse, KEYS, ORDER)
    expected = latest_by(batch, KEYS, ORDER)
    found = read_latest(warehouse, "laps", KEYS, ORDER)
    assert rows(found.select(*expected.columns)) == rows(expected)
    assert rows(staging.laps(found)) == rows(staging.laps(expected))


def test_newest_copies_keep_one_row_per_key(spark, warehouse, tmp_path):
    """A million replays of 50 keys in three batches."""
    path = str(tmp_path / "raw")
    for part in range(3):
        frame = spark.range(333_334).selectExpr("id % 50 as k", f"timestamp_seconds((id * 7919 + {part}) % 100003) as ts", "id % 11 as v")
        frame.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("k long, ts timestamp, v long").option("maxFilesPerTrigger", 1).parquet(path)
    progress = run_newest(spark, stream, tmp_path, warehouse, ["k"], ["ts"], ttl_ms=3_600_000)
    kept = [o["numRowsTotal"] for p in progress for o in p["stateOperators"]]
    assert max(kept) == 50
    from pitwall.operators.latest import latest_by

    found = read_latest(warehouse, "laps", ["k"], ["ts"]).select("k", "ts", "v")
    assert sorted(found.collect()) == sorted(latest_by(spark.read.parquet(path), ["k"], ["ts"]).select("k", "ts", "v").collect())


# --- layout and live state ---


def test_loads_of_a_stream_stay_bounded(spark, lake_root, warehouse, tmp_path):
    for n in range(7):
        put_laps(lake_root, f"20260308T04{n:02d}00Z", [(44, n, 90.0)])
    archive = tmp_path / "archive"
    run_stream(spark, lake_root, warehouse, tmp_path, max_files=1, fold_every=3, archive=str(archive))
    assert warehouse.source("openf1", "laps").count() == 7
    for name in ("openf1_laps", "load_audit"):
        warehouse.fold("raw", name, least=2)
        assert len(warehouse.loads("raw", name)) == 1
    assert len(list(warehouse_files(warehouse, "openf1_laps"))) == 1
    # finished files have left the lake, the last batch is still there
    assert len(list(archive.rglob("*.ndjson"))) >= 5


def warehouse_files(warehouse, name):
    from pathlib import Path

    return Path(warehouse.path("raw", name)).rglob("*.parquet")


def test_live_reads_one_session(spark, sf, warehouse, rows):
    from pitwall import testdata as td
    from pitwall.registry import LIVE_AS_OF, live_state

    laps, as_of = td.raw_laps(spark, sf), F.lit(LIVE_AS_OF).cast("timestamp")
    warehouse.append("raw", "openf1_stints", td.raw_stints(spark, sf), "stream-0-openf1-stints", ("session_key",))
    for n in range(2):
        part = laps.filter(F.col("lap_number") % 2 == n)
        warehouse.append("raw", "openf1_laps", part, f"stream-{n}-openf1-laps", ("session_key",))
        live = refresh_live(warehouse, as_of, f"stream-{n}")
    assert rows(live) == rows(live_state(spark, sf))
    starts = warehouse.table("staging", STARTS)
    assert starts.count() == 2 * laps.select("session_key").distinct().count()
    raw_laps, raw_stints = (warehouse.source("openf1", name) for name in ("laps", "stints"))
    from pitwall.operators.joins import keep_latest_session, latest_session

    for table in (raw_laps, raw_stints):
        plan = keep_latest_session(table, latest_session(starts))._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "date_start" in line or "FileScan" in line and "lap_end" in line)
        assert "session_key" in scan.split("PartitionFilters: [")[1].split("]")[0] and "ubquery" in scan.split("PartitionFilters: [")[1]


def test_a_refresh_lists_the_files_of_one_session(spark, warehouse, monkeypatch):
    from pitwall.streaming import live as module

    lap = "session_key, session_key as meeting_key, 44L as driver_number, 1L as lap_number, 90.0D as lap_duration, false as is_pit_out_lap"
    more = ", ".join(f"1.0D as {c}" for c in ("duration_sector_1", "duration_sector_2", "duration_sector_3"))
    more += ", " + ", ".join(f"1L as {c}" for c in ("i1_speed", "i2_speed", "st_speed"))
    laps = spark.range(5).selectExpr("id as session_key").selectExpr(*f"{lap}, {more}".split(", "), "timestamp_seconds(session_key) as date_start")
    stint = "session_key, session_key as meeting_key, 44L as driver_number, 1L as stint_number, 1L as lap_start, 9L as lap_end"
    stints = spark.range(5).selectExpr("id as session_key").selectExpr(*stint.split(", "), "'SOFT' as compound", "0L as tyre_age_at_start")
    warehouse.append("raw", "openf1_laps", laps, "b", ("session_key",))
    warehouse.append("raw", "openf1_stints", stints, "b", ("session_key",))
    read, real = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, name: read.extend(df.inputFiles()) or real(df, name))
    raw_laps, raw_stints = (warehouse.source("openf1", name) for name in ("laps", "stints"))
    found = live_from_raw(raw_laps, raw_stints, F.lit("1970-01-01").cast("timestamp"), module.session_starts(raw_laps))
    assert [(r.session_key, r.compound) for r in found.collect()] == [(4, "SOFT")]
    assert read and all("session_key=4/" in path for path in read)
    none = live_from_raw(raw_laps, raw_stints, F.lit("1970-01-01").cast("timestamp"), module.session_starts(raw_laps.limit(0)))
    assert none.collect() == []
