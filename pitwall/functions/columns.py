"""Column helpers. All of them are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitwall.functions.labels import PATH_PATTERN, QUARANTINE_PREFIX

OUTLIER_FACTOR = 1.25
FUEL_MS_PER_LAP = 30


def first_or_null(arr: Column, field: str) -> Column:
    """``field`` of the first element; NULL for an empty or missing array."""
    return F.get(arr, F.lit(0)).getField(field)


def to_ms(seconds: Column) -> Column:
    """Seconds to whole milliseconds, half away from zero."""
    return F.round(seconds * F.lit(1000.0)).cast("long")


def to_seconds(ms: Column) -> Column:
    return ms / F.lit(1000.0)


def not_true(flag: Column) -> Column:
    """True for false and for NULL."""
    return ~F.coalesce(flag, F.lit(False))


def inclusive_span(lo: Column, hi: Column) -> Column:
    """Number of laps from ``lo`` to ``hi``, both counted."""
    return hi - lo + F.lit(1)


def flag(cond: Column) -> Column:
    """1 where ``cond`` holds, 0 where it is false or NULL."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def grid_delta(grid: Column, position: Column) -> Column:
    return grid - position


def is_outlier(value: Column, median: Column, factor: float = OUTLIER_FACTOR) -> Column:
    return value > F.lit(float(factor)) * median


def fuel_corrected(lap_ms: Column, max_lap: Column, lap: Column, ms_per_lap: int = FUEL_MS_PER_LAP) -> Column:
    """Lap time as if driven with the fuel load of the session's last lap."""
    return lap_ms - F.lit(ms_per_lap) * (max_lap - lap)


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def full_name(given: Column, family: Column) -> Column:
    """NULL if either part is NULL."""
    return F.concat(given, F.lit(" "), family)


def race_id(season: Column, round_: Column) -> Column:
    return F.concat(season.cast("string"), F.lit("-"), round_.cast("string"))


def minutes_since(ts: Column, as_of: Column) -> Column:
    """Whole elapsed minutes, truncated; negative for the future."""
    return F.timestamp_diff("MINUTE", ts, as_of)


def trunc_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def utc_text(ts: Column) -> Column:
    """An instant as yyyy-MM-dd HH:mm:ss in UTC, whatever the session's time zone."""
    since_epoch = F.make_dt_interval(secs=F.unix_seconds(ts).cast("decimal(18,6)"))
    return F.substr((F.lit("1970-01-01").cast("timestamp_ntz") + since_epoch).cast("string"), F.lit(1), F.lit(19))


def fetch_stamp(ts: Column) -> Column:
    """The stamp of a fetch in the name of a lake object."""
    return F.concat(F.translate(utc_text(ts), " -:", "T"), F.lit("Z"))


def ingest_ts(path: Column) -> Column:
    """The fetch time stamped into a lake object's name; NULL if there is none."""
    stamp = F.regexp_extract(path, r"(\d{8}T\d{6}Z)", 1)
    return F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd'T'HHmmssX"))


def lake_path_parts(key: Column) -> dict[str, Column]:
    """Routing columns of a lake object key."""
    source = F.regexp_extract(key, PATH_PATTERN, 1)
    endpoint = F.regexp_extract(key, PATH_PATTERN, 2)
    skip = F.when(key.startswith(QUARANTINE_PREFIX), F.lit("quarantine_prefix")).when(
        source == "", F.lit("path_unrecognized")
    )
    loadable = skip.isNull()
    return {
        "source": F.when(loadable, source),
        "endpoint": F.when(loadable, endpoint),
        "target_table": F.when(loadable, F.concat(source, F.lit("_"), F.lower(endpoint))),
        "skip_reason": skip,
    }


def median_element(value: Column, accuracy: int = 10_000) -> Column:
    """Median that is an element of the input, from a mergeable sketch.

    Exact for groups up to about ``accuracy`` / 5 rows; beyond, the rank is off
    by at most 1 / accuracy. For exact medians use operators.medians.
    """
    return F.percentile_approx(value, F.lit(0.5), F.lit(accuracy))


def newest_first(*cols: str | Column) -> list[Column]:
    """Descending sort keys with NULLs last."""
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in cols]
