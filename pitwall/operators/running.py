"""Running sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.hot import HOT_ROWS, split_hot
from pitwall.session import materialise


def running_sum(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str, out: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the sum of ``value`` over all rows up to the current one.

    The remaining columns break ties in ``order``. Groups too large for one
    sort are cut into consecutive slices: each slice is summed on its own and
    shifted by the total of the slices before it.
    """
    ties = [c for c in df.columns if c not in partition and c not in order]
    sort = [F.col(c).asc_nulls_first() for c in [*order, *ties]]
    cold, hot, groups = split_hot(df, partition, hot_rows)
    result = cold.withColumn(out, _upto_here(value, partition, sort))
    if hot is None:
        return result

    slices = groups.agg(F.sum("_hot_rows")).first()[0] // hot_rows + 1
    ranged = hot.repartitionByRange(slices, *[F.col(c).asc_nulls_first() for c in partition], *sort)
    ranged = materialise(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    # one row per group and slice
    before = Window.partitionBy(*partition).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*partition, "_slice")
        .agg(F.sum(value).alias("_total"))
        .withColumn("_shift", F.sum("_total").over(before))
        .select(*[F.col(c).alias("_s_" + c) for c in partition], F.col("_slice").alias("_s_slice"), "_shift")
    )
    within = ranged.withColumn("_within", _upto_here(value, [*partition, "_slice"], sort))
    match = within["_slice"] == shifts["_s_slice"]
    for c in partition:
        match &= within[c].eqNullSafe(shifts["_s_" + c])
    total = F.when(
        F.col("_within").isNotNull() | F.col("_shift").isNotNull(),
        F.coalesce("_within", F.lit(0)) + F.coalesce("_shift", F.lit(0)),
    )
    shifted = within.join(shifts, match, "left").withColumn(out, total)
    return result.unionByName(shifted.select(*df.columns, out))


def _upto_here(value: str, partition: Sequence[str], sort: Sequence[Column]) -> Column:
    frame = Window.partitionBy(*partition).orderBy(*sort)
    return F.sum(value).over(frame.rowsBetween(Window.unboundedPreceding, Window.currentRow))
