"""Load, build, check, and only then show: one run that stops on a failed check."""

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators.quality import DECLARED, Check, quarantine, run_suite, store_failures
from salesmart.operators.verify import verify_landing, verify_warehouse
from salesmart.plans.build import LAYERS, RunOptions, Warehouse
from salesmart.sources.tables import (
    LANDING_LAYER, Staged, landing_rows, layer_name, publish, publish_views, reject, stage,
)


class ChecksFailed(Exception):
    """``failures``: how many rows or values each failed check objects to."""

    def __init__(self, failures: Mapping[str, int]):
        super().__init__(", ".join(f"{name}: {n}" for name, n in sorted(failures.items())))
        self.failures = dict(failures)


def failed_checks(
    tables: Mapping[str, DataFrame], checks: Iterable[Check], allowed: Mapping[str, int]
) -> dict[Check, int]:
    """Checks with more failures than ``allowed`` (by name; none where it says nothing)."""
    checks = list(checks)
    rows = run_suite(tables, checks).where("NOT passed").collect()  # one row a check at most
    found = {r.check_name: r.failures for r in rows if r.failures > allowed.get(r.check_name, 0)}
    return {c: found[c.name] for c in checks if c.name in found}


def run_checked(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    options: RunOptions = RunOptions(),
    prefix: str | None = None,
    landing: str = LANDING_LAYER,
    checks: Iterable[Check] = DECLARED,
    allowed: Mapping[str, int] | None = None,
    failures: str = "check_failures",
    cut: bool = False,
) -> dict[str, DataFrame]:
    """Extract, land, build, check, publish and verify; the verification's frames.

    Every table is written to its spare folder, and the next ones are built from it there.
    The suite reads these files. If a check fails, no table is switched: readers go on with
    the old versions, the failing values and rows are kept under ``failures``, the refused
    tables as ``<table>__rejected``, and ``ChecksFailed`` is raised. Otherwise all tables are
    switched, sources first; a run that ends between two switches is repeated as a whole.
    """
    staged: dict[str, Staged] = {}

    def keep(name: str, df: DataFrame, table: str) -> DataFrame:
        staged[name] = stage(df, table)
        return staged[name].rows

    sources = {name: keep(name, rows, f"{landing}.{name}") for name, rows in landing_rows(read, cut)}
    sources = {name: df.toDF(*[c.lower() for c in df.columns]) for name, df in sources.items()}
    warehouse = Warehouse(
        sources, options, lambda name, df: keep(name, df, f"{layer_name(LAYERS[name], prefix)}.{name}")
    )
    tables = sources | warehouse.models()
    failed = failed_checks(tables, checks, allowed or {})
    if failed:
        for check in failed:
            store_failures(tables, check, failures)
            quarantine(tables, check, failures)
        for rows in staged.values():
            reject(rows)
        raise ChecksFailed({c.name: n for c, n in failed.items()})
    live = {name: publish(rows) for name, rows in staged.items()}
    shown = {n: live[n].toDF(*[c.lower() for c in live[n].columns]) for n in sources}
    views = Warehouse(shown, options)
    publish_views({n: getattr(views, n) for n, layer in LAYERS.items() if layer == "staging"}, prefix)
    return {f"landing_{n}": df for n, df in verify_landing(shown).items()} | verify_warehouse(shown, live)
