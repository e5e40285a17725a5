"""What to fetch, load or read: slices, sessions, and the completeness of pages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import trunc_second
from pitwall.sources.schemas import DROP_FIELDS

# Fixed values of the feeds.
DEFAULT_ENDPOINTS = "seasons,drivers,results,qualifying,driverStandings"
PAGE_LIMIT = 100
SESSION_LOOKBACK_HOURS = 2

_PAGES_PER_TASK = 10_000


def select_slice(df: DataFrame, season: int | None = None, endpoints: str | None = None) -> DataFrame:
    """Rows of one season and a comma-separated list of endpoints.

    An argument beats its default: the current UTC year and the five standard
    endpoints.
    """
    season = season or dt.datetime.now(dt.timezone.utc).year
    wanted = [e.strip() for e in (endpoints or DEFAULT_ENDPOINTS).split(",") if e.strip()]
    return df.filter(F.col("endpoint").isin(wanted) & (F.col("season") == season))


def select_sessions(df: DataFrame, session_keys: Sequence[int]) -> DataFrame:
    """Backfill: exactly these sessions, whether they are active or not."""
    return df.filter(F.col("session_key").isin([int(k) for k in session_keys]))


def active_sessions(sessions: DataFrame, as_of: Column, lookback_hours: int = SESSION_LOOKBACK_HOURS) -> DataFrame:
    """Sessions that started within the look-back and have not ended.

    Times compare at whole seconds. A missing start counts as started, a
    missing end as still running.
    """
    now = trunc_second(as_of)
    start, end = trunc_second(F.col("date_start")), trunc_second(F.col("date_end"))
    since = now - F.make_dt_interval(hours=F.lit(lookback_hours))
    started = start.isNull() | ((F.col("date_start") >= since) & (start <= now))
    return sessions.filter(started & (end.isNull() | (end >= now)))


def gate(sessions: DataFrame, as_of: Column, lookback_hours: int = SESSION_LOOKBACK_HOURS) -> DataFrame | None:
    """The active sessions, or None where there is nothing to do."""
    active = active_sessions(sessions, as_of, lookback_hours)
    return None if active.isEmpty() else active


def sanitize(df: DataFrame, endpoint: str) -> DataFrame:
    """Drop the fields that the raw table of ``endpoint`` cannot hold."""
    return df.drop(*DROP_FIELDS.get(endpoint, ()))


_PAGE_KEYS = ["source", "endpoint", "season"]


def _expected_pages(pages: DataFrame, limit: int) -> DataFrame:
    """Page count per walk. The first page is always fetched; a bad total counts as 0."""
    total = F.coalesce(F.col("total").cast("string").try_cast("bigint"), F.lit(0).cast("long"))
    totals = pages.groupBy(*_PAGE_KEYS).agg(F.max(total).alias("_total"))
    count = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_total") / F.lit(limit)))
    return totals.select(*_PAGE_KEYS, count.alias("expected"))


def missing_pages(pages: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """One row per page offset that a complete walk would have landed."""
    first = F.sequence(F.lit(0).cast("long"), F.col("expected") - 1, F.lit(_PAGES_PER_TASK).cast("long"))
    last = F.least(F.col("_first") + _PAGES_PER_TASK - 1, F.col("expected") - 1)
    # a walk of very many pages is laid out by many tasks
    chunks = _expected_pages(pages, limit).select(*_PAGE_KEYS, "expected", F.explode(first).alias("_first"))
    grid = chunks.repartition(*_PAGE_KEYS, "_first").select(
        *_PAGE_KEYS, F.explode(F.sequence("_first", last)).alias("_page")
    )
    offsets = grid.select(*_PAGE_KEYS, (F.col("_page") * limit).alias("missing_offset"))
    landed = pages.select(*_PAGE_KEYS, F.col("offset").alias("missing_offset")).distinct()
    return offsets.join(landed, [*_PAGE_KEYS, "missing_offset"], "left_anti")


def page_audit(pages: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """Completeness of each walk: pages expected, landed and missing."""
    lost = missing_pages(pages, limit).groupBy(*_PAGE_KEYS).agg(
        F.count(F.lit(1)).alias("_missing"), F.min("missing_offset").alias("first_missing_offset")
    )
    missing = F.coalesce("_missing", F.lit(0))
    return (
        _expected_pages(pages, limit)
        .join(lost, _PAGE_KEYS, "left")
        .select(
            *_PAGE_KEYS, "expected", (F.col("expected") - missing).alias("landed"), missing.alias("missing"),
            "first_missing_offset",
        )
    )
