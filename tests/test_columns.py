"""Hand-computed cases of the column helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwall.functions import columns as c
from pitwall.functions.labels import DRIVER_CODES, SESSION_NAMES, with_driver_label, with_session_label


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("seconds, ms", [(0.0919996, 92), (0.0915, 92), (91.9996, 92000), (-0.0005, -1), (None, None)])
def test_to_ms_rounds_half_away_from_zero(spark, seconds, ms):
    assert value(spark, c.to_ms(F.lit(seconds).cast("double"))) == ms


def test_to_seconds_is_double(spark):
    assert value(spark, c.to_seconds(F.lit(91500))) == 91.5


@pytest.mark.parametrize("flag, kept", [(True, False), (False, True), (None, True)])
def test_not_true(spark, flag, kept):
    assert value(spark, c.not_true(F.lit(flag).cast("boolean"))) is kept


@pytest.mark.parametrize("position, win, podium", [(None, 0, 0), (1, 1, 1), (3, 0, 1), (4, 0, 0)])
def test_flags(spark, position, win, podium):
    p = F.lit(position).cast("long")
    assert value(spark, c.flag(p == 1)) == win
    assert value(spark, c.flag(p <= 3)) == podium


def test_grid_delta_propagates_null(spark):
    assert value(spark, c.grid_delta(F.lit(5), F.lit(2))) == 3
    assert value(spark, c.grid_delta(F.lit(5), F.lit(None).cast("long"))) is None


def test_inclusive_span(spark):
    assert value(spark, c.inclusive_span(F.lit(9), F.lit(14))) == 6
    assert value(spark, c.inclusive_span(F.lit(9), F.lit(None).cast("long"))) is None


def test_first_or_null(spark):
    df = spark.createDataFrame(
        [([("a",), ("b",)],), ([],), (None,)], "teams array<struct<constructorId string>>"
    )
    found = [r.v for r in df.select(c.first_or_null(F.col("teams"), "constructorId").alias("v")).collect()]
    assert found == ["a", None, None]


def test_outlier_bound(spark):
    assert value(spark, c.is_outlier(F.lit(125), F.lit(100))) is False
    assert value(spark, c.is_outlier(F.lit(126), F.lit(100))) is True
    assert value(spark, c.is_outlier(F.lit(126), F.lit(None).cast("long"))) is None


def test_fuel_correction(spark):
    assert value(spark, c.fuel_corrected(F.lit(90_000), F.lit(50), F.lit(3))) == 88_590
    assert value(spark, c.fuel_corrected(F.lit(90_000), F.lit(50), F.lit(3), 10)) == 89_530


def test_safe_divide(spark):
    assert value(spark, c.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, c.safe_divide(F.lit(1), F.lit(0))) is None


def test_names_and_ids(spark):
    assert value(spark, c.full_name(F.lit("Max"), F.lit("V"))) == "Max V"
    assert value(spark, c.full_name(F.lit(None).cast("string"), F.lit("V"))) is None
    assert value(spark, c.race_id(F.lit(2026), F.lit(3))) == "2026-3"


@pytest.mark.parametrize(
    "ago, minutes", [("7199.9", 119), ("7200", 120), ("-60", -1), ("0", 0)]
)
def test_minutes_since_truncates(spark, ago, minutes):
    now = F.lit("2026-03-08 06:00:00").cast("timestamp")
    started = now - F.expr(f"make_dt_interval(0, 0, 0, {ago})")
    assert value(spark, c.minutes_since(started, now)) == minutes


def test_trunc_second_and_ingest_ts(spark):
    at = value(spark, c.trunc_second(F.lit("2026-03-08 06:00:00.987").cast("timestamp")))
    assert at == dt.datetime(2026, 3, 8, 6, 0, 0)
    path = "raw/source=openf1/endpoint=laps/session=1/20260308T060001Z.ndjson"
    assert value(spark, c.ingest_ts(F.lit(path))) == dt.datetime(2026, 3, 8, 6, 0, 1)
    assert value(spark, c.ingest_ts(F.lit("raw/x.ndjson"))) is None


@pytest.mark.parametrize(
    "key, expected",
    [
        (
            "raw/source=ergast/endpoint=driverStandings/dt=2026-01-01/a.ndjson",
            ("ergast", "driverStandings", "ergast_driverstandings", None),
        ),
        ("raw_quarantine/raw/source=ergast/endpoint=results/a", (None, None, None, "quarantine_prefix")),
        ("other/x", (None, None, None, "path_unrecognized")),
        ("state/raw/source=a/endpoint=b/c", (None, None, None, "path_unrecognized")),
        ("raw/source=a/endpoint=b", (None, None, None, "path_unrecognized")),
    ],
)
def test_lake_path_parts(spark, key, expected):
    parts = c.lake_path_parts(F.lit(key))
    row = spark.range(1).select(*[v.alias(k) for k, v in parts.items()]).first()
    assert (row.source, row.endpoint, row.target_table, row.skip_reason) == expected


def test_labels(spark, rows):
    df = spark.createDataFrame([(1, 5), (99, 11234)], "driver_number long, session_key long")
    labelled = with_session_label(with_driver_label(df))
    assert rows(labelled, "driver_label", "session_label") == [
        ("#99", "2026 Australian GP"),
        ("VER", "Session #5"),
    ]
    assert len(DRIVER_CODES) == 25 and len(SESSION_NAMES) == 9


def test_labels_from_a_table(spark, rows):
    df = spark.createDataFrame([(1,), (99,)], "driver_number long")
    names = spark.createDataFrame([(99, "NEW")], "n long, label string")
    assert rows(with_driver_label(df, names), "driver_number", "driver_label") == [(1, "#1"), (99, "NEW")]


def test_median_element_ignores_nulls(spark):
    df = spark.createDataFrame([(10,), (20,), (30,), (45,), (None,)], "x long")
    assert df.agg(c.median_element(F.col("x")).alias("m")).first().m == 20
