"""Flattening of nested page rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, path: str, alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array at ``path``; NULL and empty arrays vanish.

    ``keep`` names the outer columns to carry along, so that the scan reads
    only the leaves in use.
    """
    return df.select(*keep, F.explode(path).alias(alias))


def flatten_pages(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Project nested paths to flat columns, given as output=path."""
    return df.select(*[F.col(path).alias(out) for out, path in paths.items()])


def require_keys(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The column contract of a relation: these columns, in this order."""
    return df.select(*columns)
