"""Near-live refresh of the live page, from a state that each load extends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.joins import latest_session
from pitwall.plans import dashboards, marts, staging
from pitwall.session import materialise, scratch_scope
from pitwall.sources.warehouse import BATCH, Warehouse

LIVE_TABLE = "live_state"
# The newest start of a valid lap per session and load.
STARTS = "session_starts"


def session_starts(raw_laps: DataFrame) -> DataFrame:
    """The newest start of a valid lap per session.

    The newest copy of a lap carries its largest start time, so copies need
    not be removed first.
    """
    return staging.valid_laps(raw_laps).groupBy("session_key").agg(F.max("date_start").alias("lap_started_at"))


def note_starts(warehouse: Warehouse, batch: str | None = None) -> None:
    """Extend the state by the laps of one load; without a load by all laps.

    A repeated load replaces its own rows. Sessions of folded loads keep one row.
    """
    laps = warehouse.source("openf1", "laps")
    if batch is not None:
        laps = warehouse.appended("raw", "openf1_laps").filter(F.col(BATCH).startswith(f"{batch}-"))
    warehouse.append("staging", STARTS, session_starts(laps), batch or "all")
    newest = F.max("lap_started_at").alias("lap_started_at")
    warehouse.fold("staging", STARTS, lambda rows: rows.groupBy("session_key").agg(newest), but=batch or "all")


def live_from_raw(
    raw_laps: DataFrame, raw_stints: DataFrame, as_of: Column | None = None, starts: DataFrame | None = None
) -> DataFrame:
    """The live page from raw rows of the newest session only.

    All its inputs are per session, so the other sessions need no work. With
    ``starts`` the session is found there, and both raw tables are read in that
    session's partitions alone. The session is found first: a key that is known
    when a read is planned spares the listing of all other partitions.
    """
    starts = session_starts(raw_laps) if starts is None else starts
    newest = latest_session(starts).first()
    this_session = F.col("session_key") == F.lit(newest and newest[0])
    laps = materialise(staging.laps(raw_laps.filter(this_session)), "live_laps")
    stints = staging.stints(raw_stints.filter(this_session))
    return dashboards.live_state(laps, stints, marts.driver_pace(laps), as_of)


def refresh_live(warehouse: Warehouse, as_of: Column | None = None, batch: str | None = None) -> DataFrame:
    """Recompute the live page after a load and publish it; versions before the last go."""
    if batch is not None or not warehouse.has("staging", STARTS):
        note_starts(warehouse, batch if warehouse.has("staging", STARTS) else None)
    raw_laps, raw_stints = (warehouse.source("openf1", name) for name in ("laps", "stints"))
    with scratch_scope(warehouse.spark):
        live = live_from_raw(raw_laps, raw_stints, as_of, warehouse.table("staging", STARTS))
        published, _ = warehouse.replace("marts", LIVE_TABLE, live)
    warehouse.drop_old_versions("marts", LIVE_TABLE)
    return published


def live_refresher(warehouse: Warehouse, as_of: Column | None = None) -> Callable[[str], None]:
    """A callback for stream_lake(after=...)."""

    def refresh(batch: str) -> None:
        if warehouse.has("raw", "openf1_laps") and warehouse.has("raw", "openf1_stints"):
            refresh_live(warehouse, as_of, batch)

    return refresh
