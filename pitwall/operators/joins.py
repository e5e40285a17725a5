"""Joins of laps, stints, facts and dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import OUTLIER_FACTOR, newest_first

# a block is 2 ** 5 = 32 laps
_LAP_BLOCK_BITS = 5


def enrich(fact: DataFrame, others: DataFrame | Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left equi-joins of one or more relations on the same keys."""
    for other in [others] if isinstance(others, DataFrame) else others:
        fact = fact.join(other, list(keys), "left")
    return fact


def orphans(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows of ``child`` whose non-null ``col`` has no match in ``parent``.``field``."""
    known = parent.select(F.col(field).alias("_known")).distinct()
    present = child.filter(F.col(col).isNotNull())
    return present.join(known, present[col] == known["_known"], "left_anti")


def latest_session(laps: DataFrame) -> DataFrame:
    """One row: the session with the newest lap, the larger key on a tie."""
    newest = laps.groupBy("session_key").agg(F.max("lap_started_at").alias("_newest"))
    return newest.orderBy(*newest_first("_newest", "session_key")).limit(1).select("session_key")


def keep_latest_session(df: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of the single session in ``latest``; none if it is empty.

    A scalar subquery, so the key reaches the scan and skips row groups of a
    table that is clustered by session.
    """
    return df.filter(F.col("session_key") == latest.scalar())


def session_max_lap(laps: DataFrame) -> DataFrame:
    return laps.groupBy("session_key").agg(F.max("lap_number").alias("session_max_lap"))


def with_session_max(laps: DataFrame) -> DataFrame:
    """Laps with the last lap number of their session."""
    return laps.join(session_max_lap(laps), "session_key")


def current_stints(latest: DataFrame, stints: DataFrame) -> DataFrame:
    """Stints that cover the one latest lap of each (session, driver).

    ``latest`` has a single row per driver, so the lap range stays a plain
    residual condition of the equi-join.
    """
    d, s = latest.alias("d"), stints.alias("s")
    covered = F.col("d.latest_lap_number").between(F.col("s.lap_start"), F.col("s.lap_end"))
    keys = (F.col("s.session_key") == F.col("d.session_key")) & (F.col("s.driver_number") == F.col("d.driver_number"))
    return s.join(d, keys & covered).select("s.*")


def laps_in_stint(
    laps: DataFrame, stints: DataFrame, columns: Sequence[str] = ("compound",), skip_first: bool = True
) -> DataFrame:
    """Laps joined with every stint that covers them, plus ``session_max_lap``.

    A stint counts from its second lap on with ``skip_first``. A stint without
    an end covers nothing; overlapping stints each give a row.

    The lap range is cut into blocks of laps and the block joins the equi-join
    keys. A lap is then compared only with stints of its own block, and a
    driver with very many laps spreads over many tasks. Only blocks in which a
    driver has laps are made, so a wild lap number costs one block.
    """
    extent = laps.groupBy("session_key").agg(
        F.min("lap_number").alias("_min_lap"), F.max("lap_number").alias("session_max_lap")
    )
    first = F.greatest(F.col("lap_start") + F.lit(1 if skip_first else 0), F.col("_min_lap"))
    last = F.least("lap_end", "session_max_lap")
    blocks = laps.select("session_key", "driver_number", _block("lap_number").alias("_block")).distinct()
    spans = (
        stints.filter(F.col("lap_start").isNotNull() & F.col("lap_end").isNotNull())
        .join(extent, "session_key")
        .withColumns({"_first": first, "_last": last})
        .filter(F.col("_first") <= F.col("_last"))
        .join(blocks, ["session_key", "driver_number"])
        .filter(F.col("_block").between(_block("_first"), _block("_last")))
        .select("session_key", "driver_number", "session_max_lap", "_first", "_last", *columns, "_block")
    )
    blocked = laps.withColumn("_block", _block("lap_number"))
    joined = blocked.join(spans, ["session_key", "driver_number", "_block"])
    covered = joined.filter(F.col("lap_number").between(F.col("_first"), F.col("_last")))
    return covered.drop("_block", "_first", "_last")


def _block(lap: str) -> Column:
    return F.shiftright(lap, _LAP_BLOCK_BITS)


def drop_outliers(df: DataFrame, value: str, median: str, factor: float = OUTLIER_FACTOR) -> DataFrame:
    """Rows up to ``factor`` times the median; rows without a positive median go."""
    return df.filter((F.col(median) > 0) & (F.col(value) <= F.lit(float(factor)) * F.col(median)))
