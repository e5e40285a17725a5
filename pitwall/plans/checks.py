"""Data tests: NOT NULL, UNIQUE and relationships, with the declared test list."""

from __future__ import annotations

from collections.abc import Callable, Container, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.joins import orphans


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, all from one pass."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in cols])
    return nulls.select(F.inline(rows))


def null_counts(cols: Sequence[str]) -> dict[str, Column]:
    """The same counts as metrics that a write observes on its way."""
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in cols}


def duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null keys that occur more than once, with their row count."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.filter(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of duplicated keys."""
    return duplicates(df, cols).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("-".join(cols)).alias("column"), "failures"
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """One row with the number of non-null child values that the parent lacks."""
    lost = orphans(child, col, parent, field).agg(F.count(F.lit(1)).alias("failures"))
    return lost.select(F.lit(col).alias("column"), "failures")


@dataclass(frozen=True)
class Checks:
    """Declared tests of one model."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    # (column, parent model, parent column)
    relationships: tuple[tuple[str, str, str], ...] = ()

    def with_parents(self, built: Container[str]) -> Checks:
        """Without the relationships whose parent was not built."""
        return replace(self, relationships=tuple(r for r in self.relationships if r[1] in built))


# The declared data tests.
CHECKS = {
    "stg_ergast__races": Checks(not_null=("season", "round")),
    "stg_ergast__results": Checks(not_null=("driver_id", "season", "round")),
    "stg_ergast__qualifying": Checks(not_null=("driver_id", "season", "round")),
    "stg_ergast__drivers": Checks(not_null=("driver_id",), unique=("driver_id",)),
    "stg_ergast__driver_standings": Checks(not_null=("driver_id", "season")),
    "stg_openf1__laps": Checks(not_null=("session_key", "driver_number", "lap_number", "lap_time_ms")),
    "stg_openf1__stints": Checks(not_null=("session_key", "driver_number", "stint_number", "compound")),
    "dim_driver": Checks(not_null=("driver_id",), unique=("driver_id",)),
    "dim_race": Checks(not_null=("race_id", "season", "round"), unique=("race_id",)),
    "fct_driver_race_summary": Checks(
        not_null=("race_id", "driver_id"),
        relationships=(("race_id", "dim_race", "race_id"), ("driver_id", "dim_driver", "driver_id")),
    ),
    "vw_dashboard_overview": Checks(not_null=("race_id", "driver_id")),
    "fct_lap": Checks(not_null=("session_key", "driver_number", "lap_number", "lap_time_ms")),
    "fct_driver_pace": Checks(not_null=("session_key", "driver_number")),
    "vw_dashboard_race": Checks(not_null=("session_key", "driver_number", "lap_number")),
    "fct_clean_air_pace": Checks(not_null=("session_key", "driver_number", "compound")),
    "vw_dashboard_pace_by_compound": Checks(not_null=("session_key", "driver_number", "compound")),
    "vw_dashboard_live": Checks(not_null=("session_key", "driver_number", "latest_lap_number")),
}


RESULT = "model string, check string, column string, failures bigint"


def run_checks(
    df: DataFrame, model: str, checks: Checks, ref: Callable[[str], DataFrame], observed: dict[str, int] | None = None
) -> DataFrame:
    """One row per declared test: model, check, column, failures.

    ``observed`` holds the null_counts of the write of ``df``; with them only
    the keys of ``df`` are read again.
    """
    parts = []
    if checks.not_null and observed is not None:
        rows = [(model, "not_null", c, observed[f"null_{c}"]) for c in checks.not_null]
        parts.append(df.sparkSession.createDataFrame(rows, RESULT).drop("model"))
    elif checks.not_null:
        parts.append(not_null(df, checks.not_null).withColumn("check", F.lit("not_null")))
    for col in checks.unique:
        parts.append(unique(df, [col]).withColumn("check", F.lit("unique")))
    for col, parent, field in checks.relationships:
        parts.append(relationships(df, col, ref(parent), field).withColumn("check", F.lit("relationships")))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(F.lit(model).alias("model"), "check", "column", "failures")
