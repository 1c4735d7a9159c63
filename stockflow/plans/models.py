"""All models, what each one reads, and how it is stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from copy import copy
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.config import RetailConfig
from stockflow.operators.rank import global_rank
from stockflow.plans import rotation, sales, staging, stock
from stockflow.sources.tables import LoadResult, TableStore

Build = Callable[[Mapping[str, DataFrame], RetailConfig], DataFrame]
TABLE = "table"
VIEW = "view"


@dataclass(frozen=True)
class Model:
    """A named DataFrame definition. Tables are written, views are not.

    ``sorted_by`` orders the rows inside each written file, without a shuffle, so that
    a filter on these columns skips most row groups when the table is read.
    """

    name: str
    build: Build
    inputs: tuple[str, ...]
    kind: str = TABLE
    sorted_by: tuple[str, ...] = ()


STAGING_MODELS = tuple(
    Model(name, build, inputs) for name, (build, inputs) in staging.STAGING.items()
)

# In an order in which every model comes after what it reads.
MART_MODELS = (
    Model("fact_sales", sales.fact_sales, ("order_lines", "orders"), sorted_by=("order_created_at",)),
    Model("dim_locations", sales.dim_locations, ("locations",)),
    Model(
        "fact_inventory_snapshot",
        stock.fact_inventory_snapshot,
        ("inventory_levels", "product_variants", "products", "locations"),
        sorted_by=("available_quantity",),
    ),
    Model("dim_products", sales.dim_products, ("products", "fact_sales")),
    Model("dim_customers", sales.dim_customers, ("customers", "fact_sales")),
    Model("fact_daily_sales", sales.fact_daily_sales, ("orders", "dim_locations")),
    Model("style_location_demand", stock.style_location_demand, ("fact_sales", "dim_locations")),
    Model("weeks_of_cover", stock.weeks_of_cover, ("fact_inventory_snapshot", "fact_sales")),
    Model(
        "negative_stock_report",
        stock.negative_stock_report,
        ("fact_inventory_snapshot", "products"),
        VIEW,
    ),
    Model(
        "negative_stock_location_summary",
        stock.negative_stock_location_summary,
        ("negative_stock_report",),
        VIEW,
    ),
    Model(
        "variant_location_demand",
        stock.variant_location_demand,
        ("fact_inventory_snapshot", "dim_locations", "fact_sales", "style_location_demand"),
        sorted_by=("available_quantity",),
    ),
    Model("store_rotation_locations", rotation.store_rotation_locations, ("dim_locations",)),
    Model("store_rotation_products", rotation.store_rotation_products, ("dim_products",)),
    Model(
        "store_rotation_candidates",
        rotation.store_rotation_candidates,
        ("variant_location_demand", "store_rotation_locations", "store_rotation_products"),
    ),
    Model(
        "style_consolidation_candidates",
        rotation.style_consolidation_candidates,
        ("variant_location_demand", "store_rotation_locations", "store_rotation_products"),
    ),
    Model(
        "store_rotation_recommendations",
        rotation.store_rotation_recommendations,
        ("store_rotation_candidates",),
    ),
    Model("store_rotation_report", rotation.store_rotation_report, ("store_rotation_candidates",)),
    Model(
        "store_rotation_workbench",
        rotation.store_rotation_workbench,
        ("store_rotation_candidates", "variant_location_demand"),
    ),
)

# Reports are read in this order. A stored table has none: sorting it while writing
# would cost a shuffle and promise nothing to the reader.
DISPLAY_ORDER = {
    "negative_stock_report": ("location_name", "available_quantity", "product_title", "variant_title"),
    "store_rotation_candidates": ("-rotation_score",),
    "store_rotation_recommendations": ("rotation_rank",),
    "store_rotation_report": ("rotation_rank",),
    "store_rotation_workbench": ("send_from_location_name", "product_title", "variant_title"),
    "style_consolidation_candidates": ("send_from_location_name", "product_title", "variant_title"),
}

MODELS = {model.name: model for model in (*STAGING_MODELS, *MART_MODELS)}


class StoredTables(Mapping):
    """Tables of a store by name; a view is rebuilt from the tables it reads.

    Reading back what was written gives the next model real file sizes, on which
    Spark decides whether a join side is small enough to broadcast.
    """

    def __init__(self, store: TableStore, cfg: RetailConfig):
        self.store = store
        self.cfg = cfg

    def on(self, store: TableStore) -> StoredTables:
        """The same tables, read from and written to another store."""
        other = copy(self)
        other.store = store
        return other

    def __getitem__(self, name: str) -> DataFrame:
        model = MODELS.get(name)
        if model is not None and model.kind == VIEW:
            return model.build(self, self.cfg)
        return self.store.read(name)

    def __iter__(self) -> Iterator[str]:
        return iter(MODELS)

    def __len__(self) -> int:
        return len(MODELS)


def _display_order(name: str) -> list[Column]:
    return [
        F.col(column[1:]).desc() if column.startswith("-") else F.col(column).asc() for column in DISPLAY_ORDER[name]
    ]


def in_display_order(name: str, rows: DataFrame) -> DataFrame:
    """Rows of a report sorted for reading; '-' marks a descending column."""
    return rows.orderBy(*_display_order(name))


def with_display_position(name: str, rows: DataFrame, ties: tuple[str, ...]) -> DataFrame:
    """Rows of a report with ``position``, their place in display order from 1 on; ``ties``
    are columns that tell apart rows that the order leaves equal."""
    return global_rank(rows, [*_display_order(name), *[F.col(column).asc() for column in ties]], "position")


def stored_layout(model: Model, rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions(*model.sorted_by) if model.sorted_by else rows


def build_model(model: Model, tables: StoredTables) -> LoadResult:
    """Replace the stored table of a model; a view is only planned, see ``register_views``."""
    rows = model.build(tables, tables.cfg)
    if model.kind == VIEW:
        return LoadResult(model.name, "success", 0)
    return tables.store.replace(model.name, stored_layout(model, rows))


def register_views(models: Iterable[Model], tables: StoredTables) -> None:
    """Register the views among some models in the session, under their names."""
    for model in models:
        if model.kind == VIEW:
            tables[model.name].createOrReplaceTempView(model.name)
