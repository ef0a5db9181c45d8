"""The whole warehouse: lazily, or written layer by layer."""

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from salesmart.operators.calendar import fixed_bounds, spine_between
from salesmart.plans.dimensions import dim_customers, dim_dates, dim_products
from salesmart.plans.facts import fact_orders
from salesmart.plans.finance import revenue_analysis
from salesmart.plans.staging import stg_customers, stg_orders, stg_products
from salesmart.sources.tables import full_refresh, layer_name, publish_views
from salesmart.sources.versions import refresh_versioned

LAYERS = {
    "stg_customers": "staging", "stg_products": "staging", "stg_orders": "staging",
    "dim_customers": "core", "dim_products": "core", "dim_dates": "core",
    "fact_orders": "core", "revenue_analysis": "finance",
}


@dataclass(frozen=True)
class RunOptions:
    """What a run depends on besides the data; the defaults are today and now."""

    as_of: dt.date | None = None
    run_ts: dt.datetime | None = None
    calendar: Mapping[str, dt.date] = field(default_factory=dict)
    safe: bool = False
    salts: int = 1


class Warehouse:
    """The models over ``customers``, ``products`` and ``orders``, each made on first use.

    ``keep`` is applied to every core and finance model as it is made: written through
    (see ``write_all``), a model is computed once and read by those after it. By default
    nothing is kept, and each result is one plan from the source scans on.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        options: RunOptions = RunOptions(),
        keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
    ):
        self.sources, self.options, self._keep = sources, options, keep

    @cached_property
    def customers(self) -> DataFrame:
        return self.sources["customers"]

    @cached_property
    def products(self) -> DataFrame:
        return self.sources["products"]

    @cached_property
    def orders(self) -> DataFrame:
        return self.sources["orders"]

    @cached_property
    def stg_customers(self) -> DataFrame:
        return stg_customers(self.customers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return stg_products(self.products, self.options.safe)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return stg_orders(self.orders)

    @cached_property
    def dim_customers(self) -> DataFrame:
        made = dim_customers(self.stg_customers, self.options.as_of, self.options.run_ts)
        return self._keep("dim_customers", made)

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._keep("dim_products", dim_products(self.stg_products, self.options.run_ts))

    @cached_property
    def dim_dates(self) -> DataFrame:
        days = spine_between(fixed_bounds(self.orders.sparkSession, **self.options.calendar))
        return self._keep("dim_dates", dim_dates(days, run_ts=self.options.run_ts))

    @cached_property
    def fact_orders(self) -> DataFrame:
        made = fact_orders(
            self.stg_orders, self.dim_customers, self.dim_products, self.dim_dates,
            self.options.run_ts, salts=self.options.salts,
        )
        return self._keep("fact_orders", made)

    @cached_property
    def revenue_analysis(self) -> DataFrame:
        made = revenue_analysis(
            self.fact_orders, self.dim_dates, self.options.run_ts, safe=self.options.safe
        )
        return self._keep("revenue_analysis", made)

    def models(self) -> dict[str, DataFrame]:
        """Every model by name, in dependency order."""
        return {name: getattr(self, name) for name in LAYERS}

    def tables(self) -> dict[str, DataFrame]:
        """Sources and models by name."""
        sources = {name: getattr(self, name) for name in ("customers", "products", "orders")}
        return sources | self.models()


def build_all(
    sources: Mapping[str, DataFrame], options: RunOptions = RunOptions()
) -> dict[str, DataFrame]:
    """Every model, unevaluated. To read several of them, use ``write_all``."""
    return Warehouse(sources, options).models()


def write_all(
    sources: Mapping[str, DataFrame],
    options: RunOptions = RunOptions(),
    prefix: str | None = None,
    fact_width: int | None = None,
) -> dict[str, DataFrame]:
    """Rebuild all mart tables, each from the tables written before it.

    Staging stays virtual, as temporary views (with the prefix in their names). The written
    tables cut the lineage: a lost executor costs the tasks of the step it was in, not a
    recomputation from the sources.

    With ``fact_width`` the fact is kept in ranges of so many order ids, as
    ``plans.incremental`` needs it.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        table = f"{layer_name(LAYERS[name], prefix)}.{name}"
        if name == "fact_orders" and fact_width:
            return refresh_versioned(df, table, "order_id", fact_width)
        return full_refresh(df, table)

    models = Warehouse(sources, options, write).models()
    publish_views({n: df for n, df in models.items() if LAYERS[n] == "staging"}, prefix)
    return models
