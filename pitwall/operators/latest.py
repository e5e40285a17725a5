"""De-duplication, latest-row and top-n operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.columns import newest_first


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; copies collapse on the map side before the shuffle."""
    return df.distinct()


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group.

    The rank filter becomes a WindowGroupLimit on both sides of the exchange:
    each map task sends at most ``n`` rows per group, however many copies exist.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per natural key: the newest by ``order``, NULLs last.

    The remaining columns end the sort, so ties resolve the same way on every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    return top_n(df, keys, newest_first(*order, *rest), 1)


def max_by_group(df: DataFrame, keys: Sequence[str], **out: str) -> DataFrame:
    """``max`` of columns per group, given as output=input."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(o) for o, c in out.items()])


def count_rows(df: DataFrame, keys: Sequence[str], out: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def last_n_avg(df: DataFrame, keys: Sequence[str], order: str, col: str, out: str, n: int = 5) -> DataFrame:
    """Average of ``col`` over the ``n`` newest rows of each group."""
    recent = top_n(df.select(*keys, order, col), keys, newest_first(order, col), n)
    return recent.groupBy(*keys).agg(F.avg(col).alias(out))
