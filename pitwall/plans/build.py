"""The 17 relations in build order, and the build with its test gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from pitwall.plans import dashboards, marts, staging
from pitwall.plans.checks import CHECKS, null_counts, run_checks
from pitwall.plans.views import text_of
from pitwall.session import materialise_observed, scratch_scope
from pitwall.sources.audit import write_events
from pitwall.sources.warehouse import Warehouse

VIEW, TABLE = "view", "table"


@dataclass(frozen=True)
class Model:
    """One relation: how it is built from its inputs and how it is kept.

    ``reads`` narrows the schema of its raw table to the leaves in use.
    """

    name: str
    layer: str
    materialized: str
    build: Callable[..., DataFrame]
    source: tuple[str, str] | None = None
    reads: str | None = None
    needs: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


def _stg(name: str, build: Callable[..., DataFrame], source: str, table: str, reads: str | None = None) -> Model:
    return Model(name, "staging", VIEW, build, source=(source, table), reads=reads)


def _mart(name: str, build: Callable[..., DataFrame], *needs: str, cluster_by: tuple[str, ...] = ()) -> Model:
    return Model(name, "marts", TABLE, build, needs=needs, cluster_by=cluster_by)


def _page(name: str, build: Callable[..., DataFrame], *needs: str) -> Model:
    return Model(name, "marts", VIEW, build, needs=needs)


_LAP_KEY = ("session_key", "driver_number", "lap_number")

MODELS = (
    _stg("stg_ergast__races", staging.races, "ergast", "results", staging.RACES_READ),
    _stg("stg_ergast__results", staging.results, "ergast", "results", staging.RESULTS_READ),
    _stg("stg_ergast__qualifying", staging.qualifying, "ergast", "qualifying", staging.QUALIFYING_READ),
    _stg("stg_ergast__drivers", staging.drivers, "ergast", "drivers"),
    _stg(
        "stg_ergast__driver_standings", staging.driver_standings, "ergast", "driverstandings", staging.STANDINGS_READ
    ),
    _stg("stg_openf1__laps", staging.laps, "openf1", "laps"),
    _stg("stg_openf1__stints", staging.stints, "openf1", "stints"),
    _mart("dim_driver", marts.dim_driver, "stg_ergast__drivers", "stg_ergast__results"),
    _mart("dim_race", marts.dim_race, "stg_ergast__races"),
    _mart("fct_driver_race_summary", marts.driver_race_summary, "stg_ergast__results", "stg_ergast__qualifying"),
    _mart("fct_lap", marts.fct_lap, "stg_openf1__laps", cluster_by=_LAP_KEY),
    _mart("fct_driver_pace", marts.driver_pace, "fct_lap", cluster_by=_LAP_KEY[:2]),
    _mart("fct_clean_air_pace", marts.clean_air_pace, "fct_lap", "stg_openf1__stints", cluster_by=_LAP_KEY[:2]),
    _page("vw_dashboard_overview", dashboards.overview, "fct_driver_race_summary", "dim_driver", "dim_race"),
    _page("vw_dashboard_race", dashboards.race_deep_dive, "fct_lap", "fct_driver_pace"),
    _page("vw_dashboard_live", dashboards.live_state, "fct_lap", "stg_openf1__stints", "fct_driver_pace"),
    _page("vw_dashboard_pace_by_compound", dashboards.pace_by_compound, "fct_clean_air_pace"),
)


class CheckFailure(Exception):
    """Some data test failed; ``rows`` lists all results, ``skipped`` the models not built."""

    def __init__(self, rows: list, skipped: list[str]):
        failed = [f"{r.model}.{r.column} {r.check}: {r.failures}" for r in rows if r.failures]
        super().__init__("; ".join(failed))
        self.rows, self.skipped = rows, skipped


@dataclass
class Build:
    """Relations of one run by name, as the catalog serves them, with their test results."""

    relations: dict[str, DataFrame] = field(default_factory=dict)
    checks: list = field(default_factory=list)


SERVICE = "build"


def run(spark: SparkSession, warehouse: Warehouse, models: Sequence[Model] = MODELS) -> Build:
    """Build the models in order and test each one.

    A table and a staging relation are written once; the write counts their
    NULLs, and what is written is tested and read by the next models. A staging
    relation is served as a view over the raw tables, a page as a view over the
    marts. A failed test keeps the models that depend on it from being built,
    and tests against a model that was not built are left out. The others go
    on, and the run fails at its end. Each model leaves an audit row.
    """
    result, blocked, events = Build(), set(), []
    skipped, staged = [], {}
    databases = {layer: warehouse.database(layer) for layer in ("raw", "staging", "marts")}
    with scratch_scope(spark):
        for model in models:
            if blocked.intersection(model.needs):
                blocked.add(model.name)
                skipped.append(model.name)
                events.append({"event": "model_skipped", "severity": "ERROR", "target_table": model.name})
                continue
            inputs = [staged[n] for n in model.needs]
            if model.source:
                inputs.insert(0, warehouse.source(*model.source, model.reads))
            nulls, seen = null_counts(CHECKS[model.name].not_null), None
            if model.materialized == TABLE:
                df = model.build(*inputs)
                df, seen = warehouse.replace(model.layer, model.name, df, model.cluster_by, nulls)
                staged[model.name] = result.relations[model.name] = df
                warehouse.drop_old_versions(model.layer, model.name)
            else:
                served = warehouse.view(model.layer, model.name, text_of(model.name, databases))
                result.relations[model.name] = staged[model.name] = served
                if model.source:
                    staged[model.name], seen = materialise_observed(model.build(*inputs), model.name, nulls)
            checks = CHECKS[model.name].with_parents(result.relations)
            rows = run_checks(staged[model.name], model.name, checks, staged.__getitem__, seen).collect()
            result.checks += rows
            failed = [f"{r.column} {r.check}" for r in rows if r.failures]
            if failed:
                blocked.add(model.name)
            events.append({
                "event": "model_failed" if failed else "model_built", "severity": "ERROR" if failed else "INFO",
                "target_table": model.name, "output_rows": seen and seen["rows"], "reason": ", ".join(failed) or None,
            })
    write_events(warehouse, SERVICE, events)
    if blocked:
        raise CheckFailure(result.checks, skipped)
    return result
