"""The daily run: landing files to published, checked marts.

    raw -> staging (checked) -> order history
                             -> intermediate (checked) -> marts (checked) -> export

Each layer is checked before the next one is written; a blocking check leaves
everything readers see as it was.  The item fact is loaded incrementally: only
the months the look-back batch touches are rewritten.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.operators import checks, snapshot, upsert
from shopmart.operators.published import extend_history, merge_parts, write_indexed
from shopmart.plans import intermediate, marts, quality
from shopmart.plans.analyses import findings
from shopmart.plans.staging import stage
from shopmart.session import materialize, scratch
from shopmart.sources.contracts import RAW_COLUMNS, SourceFiles
from shopmart.sources.export import export_csv
from shopmart.sources.landing import load_raw
from shopmart.sources.publish import Location, Publisher
from shopmart.sources.seeds import read_seeds

MARTS = (
    "fct_order_items",
    "fct_orders",
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_date",
)
ITEMS, ITEM_KEY = "fct_order_items", "order_item_sk"
HISTORY = "order_status_history"


@dataclass
class Warehouse:
    """Where the layers live and how the run is parametrised."""

    spark: SparkSession
    root: str
    files: SourceFiles = field(default_factory=SourceFiles)
    lookback_days: int = upsert.LOOKBACK_DAYS
    calendar: tuple[date, date] = (marts.CALENDAR_START, marts.CALENDAR_END)
    #: Files of the user's own holidays and category names, by seed.
    seed_files: Mapping[str, str] = field(default_factory=dict)
    #: Versions of each layer that stay readable; None keeps all.
    retain: int | None = None

    def layer(self, name: str) -> Publisher:
        return Publisher(self.spark, f"{self.root.rstrip('/')}/{name}")

    def mart(self, name: str) -> DataFrame:
        return self.layer("marts").read(name)

    def register_views(self) -> None:
        """Make the newest published tables available to ``spark.sql``.

        Raw tables become ``raw_*``; the staging and intermediate models are views
        over them, ``stg_*`` and ``int_*``, and write nothing; seeds are ``seed_*``; marts and the
        order history go by their own names.
        """
        raw = {table: self.layer("raw").read(table) for table in RAW_COLUMNS}
        stg = stage(raw)
        views = {f"raw_{name}": df for name, df in raw.items()}
        views |= {f"stg_{name}": df for name, df in stg.items()}
        views |= {f"int_{name}": df for name, df in intermediate_views(stg).items()}
        views |= {f"seed_{name}": df for name, df in seeds(self).items()}
        views |= {name: self.mart(name) for name in MARTS}
        views[HISTORY] = self.layer("snapshots").read(HISTORY)
        for name, df in views.items():
            df.createOrReplaceTempView(name)


def write_findings(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Run the nine reports over the published marts and publish their results."""
    layer = warehouse.layer("findings")
    version = layer.next_version()
    reports = findings({name: warehouse.mart(name) for name in MARTS})
    layer.commit(version, {n: layer.write(df, n, version) for n, df in reports.items()})
    return {name: layer.read(name) for name in reports}


def purchase_month() -> Column:
    """The part of the item fact a row belongs to."""
    return F.date_format("purchase_date", "yyyy-MM")


def seeds(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The user's seed files; the rules of the library for those that are not given."""
    given = read_seeds(warehouse.spark, warehouse.seed_files)
    if "national_holidays" not in given:
        days = marts.dim_date(marts.days(warehouse.spark, *warehouse.calendar))
        given["national_holidays"] = days.filter("is_br_holiday").select(
            F.col("date_day").alias("holiday_date"), "holiday_name"
        )
    if "category_overrides" not in given:
        given["category_overrides"] = marts.category_overrides(warehouse.spark)
    return given


def intermediate_views(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The intermediate models as queries over the staged tables; nothing is written."""
    orders = intermediate.orders_enriched(
        stg["orders"],
        stg["customers"],
        stg["order_items"],
        stg["order_payments"],
        stg["order_reviews"],
        intermediate.ADDRESS,
    )
    return {
        "items_per_order": intermediate.items_per_order(stg["order_items"]),
        "payments_per_order": intermediate.payments_per_order(stg["order_payments"]),
        "reviews_per_order": intermediate.reviews_per_order(stg["order_reviews"]),
        "orders_enriched": orders,
        "customer_orders": intermediate.customer_orders(orders),
        "zip_code_locations": intermediate.zip_code_locations(stg["geolocation"]),
    }


def take_snapshot(warehouse: Warehouse, raw_orders: DataFrame, as_of: str) -> None:
    """Record status changes of the raw orders as of this run."""
    layer = warehouse.layer("snapshots")
    version = layer.next_version()
    tables = extend_history(
        layer, HISTORY, raw_orders, "order_id", snapshot.ORDER_STATUS_CHECKS, as_of, version
    )
    layer.commit(version, tables)


def build_intermediate(stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The intermediate models; those that several others read are written once."""
    items = intermediate.items_per_order(stg["order_items"])
    payments = intermediate.payments_per_order(stg["order_payments"])
    reviews = intermediate.reviews_per_order(stg["order_reviews"])
    orders = intermediate.order_core(stg["orders"], stg["customers"], intermediate.ADDRESS)
    orders = intermediate.with_items(orders, items)
    orders = intermediate.with_payments(orders, payments)
    orders = materialize(intermediate.with_reviews(orders, reviews), "orders_enriched")
    return {
        "items_per_order": items,
        "payments_per_order": payments,
        "reviews_per_order": reviews,
        "orders_enriched": orders,
        "customer_orders": intermediate.customer_orders(orders),
        "zip_code_locations": materialize(
            intermediate.zip_code_locations(stg["geolocation"]), "zip_code_locations"
        ),
    }


def load_items(
    layer: Publisher,
    items: DataFrame,
    orders: DataFrame,
    version: int,
    days: int | None = upsert.LOOKBACK_DAYS,
) -> dict[str, Location]:
    """Load the item fact; returns the folders of its months and of its index of keys.

    Without a published fact, or with ``days=None``, it is rebuilt from
    scratch; otherwise the look-back batch is deleted and inserted by key.
    """
    # Hashes cannot be compressed: half of what a row takes in a shuffle.
    derived = {ITEM_KEY: marts.item_key()}
    if days is None or not layer.exists(ITEMS):
        fact = marts.fct_order_items(items, orders)
        return write_indexed(layer, ITEMS, fact, ITEM_KEY, purchase_month(), version, derived)
    recent = upsert.look_back(orders, layer.read(ITEMS), "purchased_at", days)
    batch = marts.fct_order_items(items, recent)
    return merge_parts(layer, ITEMS, batch, ITEM_KEY, purchase_month(), version, derived)


def build_marts(
    warehouse: Warehouse,
    stg: Mapping[str, DataFrame],
    models: Mapping[str, DataFrame],
    full_refresh: bool = False,
) -> dict[str, DataFrame]:
    """Write all marts, check them, and only then publish them together."""
    layer = warehouse.layer("marts")
    version = layer.next_version()
    orders = models["orders_enriched"]
    days = None if full_refresh else warehouse.lookback_days
    locations = load_items(layer, stg["order_items"], orders, version, days)
    spine = marts.days(warehouse.spark, *warehouse.calendar)
    own = seeds(warehouse)
    built = {
        "fct_orders": marts.fct_orders(orders),
        "dim_customers": marts.dim_customers(
            models["customer_orders"], models["zip_code_locations"]
        ),
        "dim_products": marts.dim_products(
            stg["products"],
            stg["product_category_name_translation"],
            own["category_overrides"],
        ),
        "dim_sellers": marts.dim_sellers(stg["sellers"], models["zip_code_locations"]),
        "dim_date": marts.dim_date(spine, own["national_holidays"]),
    }
    for name, df in built.items():
        locations[name] = layer.write(df, name, version)
    written = {name: layer.read_at(locations[name]) for name in MARTS}
    checks.enforce(quality.mart_checks(written, stg["order_items"]))
    layer.commit(version, locations)
    return {name: layer.read(name) for name in MARTS}


def run_daily(
    warehouse: Warehouse,
    landing: str,
    as_of: str,
    full_refresh: bool = False,
    export_to: str | None = None,
) -> dict[str, DataFrame]:
    """One run over the files in ``landing``; ``as_of`` dates new order versions."""
    with scratch(warehouse.spark):
        raw = load_raw(warehouse.spark, landing, warehouse.layer("raw"), warehouse.files)
        stg = stage(raw)
        checks.enforce(quality.staging_checks({**stg, **seeds(warehouse)}))
        take_snapshot(warehouse, raw["orders"], as_of)
        models = build_intermediate(stg)
        checks.enforce(quality.intermediate_checks(models))
        published = build_marts(warehouse, stg, models, full_refresh)
        if export_to:
            export_csv(published, export_to)
    if warehouse.retain:
        for name in ("raw", "snapshots", "marts"):
            warehouse.layer(name).expire(warehouse.retain)
    return published
