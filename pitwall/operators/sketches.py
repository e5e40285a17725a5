"""Medians from mergeable KLL sketches.

A sketch per small group is stored, and larger groups merge the stored
sketches, so a new load changes the medians without a look at older rows. The
median is an element of the input, the lower middle one, and exact up to about
``accuracy`` rows in a group; beyond, its rank is off by a small share of the
rows that shrinks with ``accuracy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size parameter of a sketch: the rank of a median is off by less than 0.1 per cent of the rows.
ACCURACY = 4096


def sketch_groups(df: DataFrame, keys: Sequence[str], value: str, out: str = "sketch", accuracy: int = ACCURACY) -> DataFrame:
    """One sketch of whole numbers per group."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_bigint(value, F.lit(accuracy)).alias(out))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], out: str = "sketch", accuracy: int = ACCURACY) -> DataFrame:
    """The sketches of larger groups, or of the same groups over several loads."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", F.lit(accuracy)).alias(out))


def sketch_median(sketch: str) -> Column:
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(0.5))


def sketch_rows(sketch: str) -> Column:
    return F.kll_sketch_get_n_bigint(sketch)
