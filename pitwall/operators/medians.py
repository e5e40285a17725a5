"""Exact medians per group.

Two kinds: ``element`` is the lower middle value and keeps the input type,
``interpolated`` is the mean of the two middle values as DOUBLE. NULLs are
ignored by both.

Groups that fit a task are sorted or counted there by built-in aggregates. The
rows of a larger group never meet in one task: its median is narrowed down by
counting rows per value range, with partial sums on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.hot import HOT_ROWS, broadcast_if_small, same_keys, split_hot
from pitwall.session import materialise

ELEMENT = "element"
INTERPOLATED = "interpolated"
_RANGES = 1024


def median_interpolated(value: Column, partition: Sequence[str]) -> Column:
    """Interpolated median over a window partition that fits a task."""
    return F.percentile(value, F.lit(0.5)).over(Window.partitionBy(*partition))


def median_element_over(df: DataFrame, value: str, partition: Sequence[str]) -> Column:
    """Lower middle value over a window partition that fits a task; whole numbers up to 2 ** 53."""
    keys = ", ".join(f"`{k}`" for k in partition)
    median = F.expr(f"percentile_disc(0.5) within group (order by `{value}`) over (partition by {keys})")
    return median.cast(df.schema[value].dataType)


def median_of_group(value: str, how: str = ELEMENT) -> Column:
    """Median aggregate for groups that fit a task."""
    if how == INTERPOLATED:
        return F.percentile(F.col(value), F.lit(0.5))
    values = F.collect_list(value)
    return F.get(F.sort_array(values), F.shiftright(F.size(values) - 1, 1))


def with_group_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    hot_rows: int | None = HOT_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add the interpolated median of ``value`` over each group to every row."""
    cold, hot, _ = split_hot(df, keys, hot_rows, sized_by)
    result = cold.withColumn(out, median_interpolated(F.col(value), keys))
    if hot is None:
        return result
    medians = _narrow_down(materialise(hot.select(*keys, value), "hot_rows"), keys, value, INTERPOLATED, out)
    hot_result = hot.join(broadcast_if_small(medians), same_keys(hot, medians, keys, "_m_"), "left")
    return result.unionByName(hot_result.select(*df.columns, out))


def group_medians(
    df: DataFrame,
    keys: Sequence[str],
    medians: dict[str, str],
    how: str = ELEMENT,
    count_as: str | None = None,
    hot_rows: int | None = HOT_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """One row per group with the medians given as output=input, and its row count."""
    count = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    columns = [*keys, *([count_as] if count_as else []), *medians]
    cold, hot, _ = split_hot(df, keys, hot_rows, sized_by)
    result = cold.groupBy(*keys).agg(*count, *[median_of_group(v, how).alias(o) for o, v in medians.items()])
    if hot is None:
        return result
    hot = materialise(hot.select(*keys, *dict.fromkeys(medians.values())), "hot_rows")
    tall = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as or "_rows"))
    for out, value in medians.items():
        found = _narrow_down(hot, keys, value, how, out)
        tall = tall.join(found, same_keys(tall, found, keys, "_m_"), "left")
        tall = tall.drop(*["_m_" + k for k in keys])
    return result.select(*columns).unionByName(tall.select(*columns))


def _narrow_down(hot: DataFrame, keys: Sequence[str], value: str, how: str, out: str) -> DataFrame:
    """Median per hot group, with keys prefixed ``_m_``.

    Each round cuts the value range that holds the wanted rank into equal parts,
    counts rows per part and keeps the one part with the rank, down to a single
    value. The state is one or two rows per hot group.
    """
    rows = hot.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    lower, upper = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    ranks = F.array(lower, upper) if how == INTERPOLATED else F.array(lower)
    state = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        .select(*[F.col(k).alias("_m_" + k) for k in keys], F.posexplode(ranks).alias("_target", "_rank"), "_lo", "_hi")
    )
    group = [*["_m_" + k for k in keys], "_target"]
    while True:
        state = materialise(state, "median_range")
        wide = state.filter(F.col("_lo") < F.col("_hi"))
        if wide.isEmpty():
            break
        v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
        inside = same_keys(rows, wide, keys, "_m_") & v.between(lo, hi)
        halves = (v / 2.0 - lo / 2.0, hi / 2.0 - lo / 2.0)
        cut = F.floor(F.coalesce(F.try_divide(*halves), F.lit(0.0)) * _RANGES)
        # the largest value always gets the last part, so every round shrinks the range
        part = F.when(v >= hi, F.lit(_RANGES)).otherwise(F.least(cut, F.lit(_RANGES - 1)))
        counts = (
            rows.join(broadcast_if_small(wide), inside)
            .groupBy(*group, "_rank", part.alias("_part"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        )
        upto = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part"))
        kept = (
            counts.withColumn("_upto", upto)
            .filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
            .withColumn("_rank", F.col("_rank") - (F.col("_upto") - F.col("_n")))
        )
        state = state.filter(F.col("_lo") >= F.col("_hi")).unionByName(kept.select(*state.columns))
    median = F.avg("_lo") if how == INTERPOLATED else F.first("_lo")
    return materialise(state.groupBy(*group[:-1]).agg(median.alias(out)), "medians")

