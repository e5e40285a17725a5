"""Finding and splitting off groups that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.session import materialise

# Rows of one group that a task may hold. Percentile aggregates keep up to 128
# groups in memory before they fall back to sorting.
HOT_ROWS = 100_000

# Rows of key-sized relations that may be broadcast.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """Broadcast hint for a written table whose row count allows it.

    Beyond that the join shuffles, and splits its skewed keys at run time.
    """
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str = "_hot_") -> Column:
    """Null-safe equality of ``keys`` with their prefixed twins in ``right``."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups of more than ``hot_rows`` rows, counted with map-side partial sums."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hot_rows"))
    return sizes.filter(F.col("_hot_rows") > hot_rows).withColumnsRenamed({k: "_hot_" + k for k in keys})


def fits(table: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether every group of a written table has at most ``hot_rows`` rows.

    A table of at most that many rows in total needs no look at its groups.
    """
    return table.count() <= hot_rows or hot_groups(table, keys, hot_rows).isEmpty()


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS, sized_by: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Split ``df`` into (cold rows, rows of hot groups, the hot groups).

    On ordinary data no group is hot and ``df`` comes back as it is. ``sized_by``
    is a written table with at least the rows of ``df`` in every group, which is
    counted in place of a long plan. ``hot_rows=None`` says that all groups are
    known to fit.
    """
    sizes = df if sized_by is None else sized_by
    if hot_rows is None or fits(sizes, keys, hot_rows):
        return df, None, None
    groups = materialise(hot_groups(sizes, keys, hot_rows), "hot_groups")
    if sized_by is not None:
        df = materialise(df, "skewed")  # a long plan that now gets several consumers
    match, keyed = same_keys(df, groups, keys), broadcast_if_small(groups)
    cold = df.join(keyed, match, "left_anti")
    hot = df.join(keyed, match, "left_semi")
    return cold, hot, groups
