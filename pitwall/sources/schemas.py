"""The schema contract of the raw tables.

One schema per (source, endpoint). A pair without one is read with inferred
types. The field lists are fixed values.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DRIVER = (
    "STRUCT<driverId STRING, code STRING, permanentNumber BIGINT, givenName STRING, familyName STRING,"
    " dateOfBirth DATE, nationality STRING, url STRING>"
)
_CONSTRUCTOR = "STRUCT<constructorId STRING, name STRING, nationality STRING, url STRING>"
_LOCATION = "STRUCT<country STRING, locality STRING, lat DOUBLE, long DOUBLE>"
_CIRCUIT = f"STRUCT<circuitId STRING, circuitName STRING, url STRING, Location: {_LOCATION}>"
_RACE = f"season BIGINT, round BIGINT, raceName STRING, date DATE, time STRING, url STRING, Circuit: {_CIRCUIT}"
_RESULT = (
    "STRUCT<number BIGINT, position BIGINT, positionText STRING, points BIGINT, grid BIGINT, laps BIGINT,"
    f" status STRING, Driver: {_DRIVER}, Constructor: {_CONSTRUCTOR}, Time: STRUCT<time STRING, millis BIGINT>,"
    " FastestLap: STRUCT<rank BIGINT, lap BIGINT, Time: STRUCT<time STRING>>>"
)
_QUALIFYING = (
    f"STRUCT<number BIGINT, position BIGINT, Driver: {_DRIVER}, Constructor: {_CONSTRUCTOR},"
    " Q1 STRING, Q2 STRING, Q3 STRING>"
)
_STANDING = (
    f"STRUCT<position BIGINT, positionText BIGINT, points BIGINT, wins BIGINT, Driver: {_DRIVER},"
    f" Constructors: ARRAY<{_CONSTRUCTOR}>>"
)
_STANDINGS_LIST = f"STRUCT<season BIGINT, round BIGINT, DriverStandings: ARRAY<{_STANDING}>>"
_PAGE = "total BIGINT, limit BIGINT, offset BIGINT, url STRING, series STRING, xmlns STRING"

CONTRACTS = {
    ("ergast", "seasons"): f"{_PAGE}, SeasonTable STRUCT<Seasons: ARRAY<STRUCT<season BIGINT, url STRING>>>",
    ("ergast", "drivers"): f"{_PAGE}, DriverTable STRUCT<season BIGINT, Drivers: ARRAY<{_DRIVER}>>",
    ("ergast", "results"): (
        f"{_PAGE}, RaceTable STRUCT<season BIGINT, Races: ARRAY<STRUCT<{_RACE}, Results: ARRAY<{_RESULT}>>>>"
    ),
    ("ergast", "qualifying"): (
        f"{_PAGE}, RaceTable STRUCT<season BIGINT, Races: ARRAY<STRUCT<{_RACE}, QualifyingResults: ARRAY<{_QUALIFYING}>>>>"
    ),
    ("ergast", "driverstandings"): (
        f"{_PAGE}, StandingsTable STRUCT<season BIGINT, round BIGINT, StandingsLists: ARRAY<{_STANDINGS_LIST}>>"
    ),
    ("openf1", "laps"): (
        "session_key BIGINT, meeting_key BIGINT, driver_number BIGINT, lap_number BIGINT, date_start TIMESTAMP,"
        " lap_duration DOUBLE, duration_sector_1 DOUBLE, duration_sector_2 DOUBLE, duration_sector_3 DOUBLE,"
        " i1_speed BIGINT, i2_speed BIGINT, st_speed BIGINT, is_pit_out_lap BOOLEAN"
    ),
    ("openf1", "stints"): (
        "session_key BIGINT, meeting_key BIGINT, driver_number BIGINT, stint_number BIGINT, lap_start BIGINT,"
        " lap_end BIGINT, compound STRING, tyre_age_at_start BIGINT"
    ),
}

# Columns that the loader adds to every raw table.
LINEAGE = "ingest_ts TIMESTAMP, object_key STRING"

# Further partition columns of raw tables, after the load.
PARTITIONS = {("openf1", "laps"): ("session_key",), ("openf1", "stints"): ("session_key",)}

# Fields dropped before landing, per endpoint: their arrays hold NULL elements.
DROP_FIELDS = {"laps": ("segments_sector_1", "segments_sector_2", "segments_sector_3")}


@cache
def schema_for(source: str, endpoint: str) -> T.StructType | None:
    """The contract of a raw table, or None where types are to be inferred."""
    ddl = CONTRACTS.get((source, endpoint.lower()))
    return T.StructType.fromDDL(ddl) if ddl else None


def _child(node: Column, name: str) -> Column:
    return F.try_variant_get(node, '$["' + name + '"]', "variant")


def _is_object(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("OBJECT"), F.lit(False))


def _is_list(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("ARRAY"), F.lit(False))


def _present(node: Column) -> Column:
    """Neither missing nor a JSON null."""
    return node.isNotNull() & ~F.is_variant_null(node)


def typed_node(node: Column, dtype: T.DataType) -> Column:
    """A VARIANT as ``dtype``: leaves go by their text, so numbers may be quoted; what does not fit is NULL."""
    if isinstance(dtype, T.StructType):
        leaves = [typed_node(_child(node, f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(_is_object(node), F.struct(*leaves))
    if isinstance(dtype, T.ArrayType):
        elements = F.try_variant_get(node, "$", "array<variant>")
        return F.transform(elements, lambda element: typed_node(element, dtype.elementType))
    return F.try_variant_get(node, "$", "string").try_cast(dtype)


def has_bad_node(node: Column, dtype: T.DataType, strict: bool = False) -> Column:
    """True where some node is present but not of its type's kind: a value that does not fit, or an object in a text.

    ``strict`` also rejects nested fields that the type does not have.
    """
    if isinstance(dtype, T.StructType):
        bad = ~_is_object(node)
        for f in dtype.fields:
            bad = bad | has_bad_node(_child(node, f.name), f.dataType, strict)
        if strict:
            names = F.map_keys(F.try_variant_get(node, "$", "map<string,variant>"))
            known = F.array(*[F.lit(name) for name in dtype.names])
            bad = bad | F.coalesce(F.size(F.array_except(names, known)) > 0, F.lit(False))
    elif isinstance(dtype, T.ArrayType):
        elements = F.try_variant_get(node, "$", "array<variant>")
        inside = F.exists(elements, lambda element: has_bad_node(element, dtype.elementType, strict))
        bad = ~_is_list(node) | F.coalesce(inside, F.lit(False))
    else:
        text, kind = F.try_variant_get(node, "$", "string"), F.schema_of_variant(node)
        bad = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        if not isinstance(dtype, T.StringType):
            bad = bad | text.try_cast(dtype).isNull()
    return _present(node) & bad


def sql_type(variant_schema: str) -> T.DataType | None:
    """The column type for what schema_of_variant tells; None where only nulls were seen.

    Numbers with a fraction are DOUBLE, very long ones DECIMAL, and fields of several kinds are text.
    """
    if variant_schema == "VOID":
        return None
    parts = re.split(r"(`(?:[^`]|``)*`)", variant_schema)
    # names in backticks are left alone, and so are those before a colon
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"DECIMAL\((\d+),(\d+)\)", _number_type, parts[i])
        parts[i] = re.sub(r"\b(OBJECT|VARIANT|VOID)\b(?!:)", lambda m: "STRUCT" if m[1] == "OBJECT" else "STRING", parts[i])
    return T.StructType.fromDDL(f"c {''.join(parts)}")[0].dataType


def _number_type(found: re.Match) -> str:
    if int(found[2]):
        return "DOUBLE"
    return "BIGINT" if int(found[1]) <= 18 else "DECIMAL(38,0)"
