"""Fixed values of the data contract, and the display labels built on them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Object keys of the lake.
PATH_PATTERN = r"^raw/source=([^/]+)/endpoint=([^/]+)/"
QUARANTINE_PREFIX = "raw_quarantine/"

# Car number -> three-letter driver code.
DRIVER_CODES = {
    1: "VER", 4: "NOR", 5: "BOR", 6: "HAD", 7: "DOO", 10: "GAS", 11: "PER", 12: "ANT", 14: "ALO",
    16: "LEC", 18: "STR", 20: "MAG", 22: "TSU", 23: "ALB", 24: "ZHO", 27: "HUL", 30: "LAW", 31: "OCO",
    43: "COL", 44: "HAM", 55: "SAI", 63: "RUS", 77: "BOT", 81: "PIA", 87: "BEA",
}

# Session key -> session name.
SESSION_NAMES = {
    9839: "2025 Abu Dhabi GP",
    11234: "2026 Australian GP",
    11240: "2026 Chinese GP — Sprint",
    11245: "2026 Chinese GP",
    11253: "2026 Japanese GP",
    11261: "2026 Bahrain GP",
    11269: "2026 Saudi Arabian GP",
    11275: "2026 Miami GP — Sprint",
    11280: "2026 Miami GP",
}


def _lookup(key: Column, names: dict[int, str], prefix: str) -> Column:
    pairs = chain.from_iterable((F.lit(k).cast("long"), F.lit(v)) for k, v in names.items())
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), key.cast("long")), F.concat(F.lit(prefix), key.cast("string"))
    )


def driver_label(number: Column, names: dict[int, str] = DRIVER_CODES) -> Column:
    return _lookup(number, names, "#")


def session_label(session_key: Column, names: dict[int, str] = SESSION_NAMES) -> Column:
    return _lookup(session_key, names, "Session #")


def session_keys(label: str, names: dict[int, str] = SESSION_NAMES) -> list[int]:
    """The sessions that show a label."""
    found = [key for key, name in names.items() if name == label]
    number = label.removeprefix("Session #")
    if number != label and number.lstrip("-").isdigit() and str(int(number)) == number and int(number) not in names:
        found.append(int(number))
    return found


def _with_label(df: DataFrame, key: str, out: str, prefix: str, lookup: DataFrame) -> DataFrame:
    # a caller's lookup has no known size, so the join strategy is left to the optimizer
    names = lookup.select(F.col(lookup.columns[0]).alias(key), F.col(lookup.columns[1]).alias("_label"))
    fallback = F.concat(F.lit(prefix), F.col(key).cast("string"))
    return df.join(names, key, "left").withColumn(out, F.coalesce("_label", fallback)).drop("_label")


def with_driver_label(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Add ``driver_label``; ``lookup`` (number, label) replaces the fixed codes."""
    if lookup is None:
        return df.withColumn("driver_label", driver_label(F.col("driver_number")))
    return _with_label(df, "driver_number", "driver_label", "#", lookup)


def with_session_label(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Add ``session_label``; ``lookup`` (key, label) replaces the fixed names."""
    if lookup is None:
        return df.withColumn("session_label", session_label(F.col("session_key")))
    return _with_label(df, "session_key", "session_label", "Session #", lookup)
