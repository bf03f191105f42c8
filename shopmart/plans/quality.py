"""The quality suite of the warehouse, and profiles of known source anomalies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.operators import checks as dq
from shopmart.operators.checks import Check, Keys

# Domains of coded columns.
ORDER_STATUSES = (
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "canceled",
    "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)
RFM_SEGMENTS = (
    "champions",
    "loyal",
    "big_spenders",
    "recent",
    "need_attention",
    "at_risk",
    "lost",
    "no_delivered_order",
)

# Columns that must be filled, by layer and table.
FILLED = {
    "staging": {
        "orders": (
            "order_id",
            "customer_id",
            "order_status",
            "purchased_at",
            "estimated_delivery_date",
        ),
        "order_items": (
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "price",
            "freight_value",
        ),
        "order_payments": ("order_id", "payment_value"),
        "order_reviews": ("order_id", "review_score", "answered_at"),
        "customers": ("customer_id", "customer_unique_id", "zip_code_prefix", "state"),
        "sellers": ("seller_id", "state"),
        "products": ("product_id",),
        "product_category_name_translation": ("category_name", "category_name_en"),
        "geolocation": ("zip_code_prefix",),
        "national_holidays": ("holiday_date",),
        "category_overrides": ("category_name",),
    },
    "intermediate": {
        "payments_per_order": ("order_id",),
        "reviews_per_order": ("order_id",),
        "items_per_order": ("order_id",),
        "orders_enriched": ("order_id", "customer_unique_id"),
        "customer_orders": ("customer_unique_id",),
        "zip_code_locations": ("zip_code_prefix",),
    },
    "marts": {
        "fct_order_items": (
            "order_item_sk",
            "order_id",
            "customer_unique_id",
            "customer_state",
            "product_id",
            "seller_id",
            "purchase_date",
            "revenue",
        ),
        "fct_orders": ("order_id", "customer_unique_id", "purchase_date", "revenue"),
        "dim_customers": ("customer_unique_id", "rfm_segment"),
        "dim_products": ("product_id", "category_name_en"),
        "dim_sellers": ("seller_id",),
        "dim_date": ("date_day",),
    },
}

# Single-column keys, by layer and table.
KEYS = {
    "staging": {
        "orders": "order_id",
        "customers": "customer_id",
        "sellers": "seller_id",
        "products": "product_id",
        "product_category_name_translation": "category_name",
        "national_holidays": "holiday_date",
        "category_overrides": "category_name",
    },
    "intermediate": {
        "payments_per_order": "order_id",
        "reviews_per_order": "order_id",
        "items_per_order": "order_id",
        "orders_enriched": "order_id",
        "customer_orders": "customer_unique_id",
        "zip_code_locations": "zip_code_prefix",
    },
    "marts": {
        "fct_order_items": "order_item_sk",
        "fct_orders": "order_id",
        "dim_customers": "customer_unique_id",
        "dim_products": "product_id",
        "dim_sellers": "seller_id",
        "dim_date": "date_day",
    },
}

# Column tuples that identify a row, by layer and table.
GRAINS = {
    "staging": {
        "order_items": ("order_id", "order_item_id"),
        "order_payments": ("order_id", "payment_sequential"),
        "order_reviews": ("review_id", "order_id"),
    },
    "intermediate": {},
    "marts": {"fct_order_items": ("order_id", "order_item_id")},
}

# (child, child column, parent, parent column), by layer.
REFERENCES = {
    "staging": (
        ("orders", "customer_id", "customers", "customer_id"),
        ("order_items", "order_id", "orders", "order_id"),
        ("order_items", "product_id", "products", "product_id"),
        ("order_items", "seller_id", "sellers", "seller_id"),
        ("order_payments", "order_id", "orders", "order_id"),
        ("order_reviews", "order_id", "orders", "order_id"),
    ),
    "intermediate": (),
    "marts": (
        ("fct_order_items", "order_id", "fct_orders", "order_id"),
        ("fct_order_items", "customer_unique_id", "dim_customers", "customer_unique_id"),
        ("fct_order_items", "product_id", "dim_products", "product_id"),
        ("fct_order_items", "seller_id", "dim_sellers", "seller_id"),
        ("fct_order_items", "purchase_date", "dim_date", "date_day"),
        ("fct_orders", "customer_unique_id", "dim_customers", "customer_unique_id"),
        ("fct_orders", "purchase_date", "dim_date", "date_day"),
        ("fct_orders", "estimated_delivery_date", "dim_date", "date_day"),
    ),
}


def _generic(layer: str, tables: Mapping[str, DataFrame]) -> list[Check]:
    found = [
        dq.not_null(t, tables[t], c) for t, columns in FILLED[layer].items() for c in columns
    ]
    found += [dq.unique(t, tables[t], c) for t, c in KEYS[layer].items()]
    found += [dq.unique_combination(t, tables[t], c) for t, c in GRAINS[layer].items()]
    found += [
        dq.relationships(child, tables[child], column, tables[parent], key)
        for child, column, parent, key in REFERENCES[layer]
    ]
    return found


def staging_checks(stg: Mapping[str, DataFrame]) -> list[Check]:
    """Checks of the typed sources and the seeds."""
    orders, items = stg["orders"], stg["order_items"]
    payments, reviews = stg["order_payments"], stg["order_reviews"]
    return [
        *_generic("staging", stg),
        dq.expression_is_true(
            "orders",
            orders,
            "delivered_to_customer_at >= purchased_at",
            "delivered_to_customer_at is not null",
        ),
        # A known anomaly of the source: visible in every run, never blocking.
        dq.expression_is_true(
            "orders",
            orders,
            "delivered_to_carrier_at >= purchased_at",
            "delivered_to_carrier_at is not null",
        ).as_warning(),
        dq.accepted_values("orders", orders, "order_status", ORDER_STATUSES),
        dq.accepted_values("order_payments", payments, "payment_type", PAYMENT_TYPES),
        dq.accepted_values("order_reviews", reviews, "review_score", REVIEW_SCORES),
        dq.accepted_range("order_items", items, "price", 0, inclusive=False),
        dq.accepted_range("order_items", items, "freight_value", 0),
        dq.accepted_range("order_payments", payments, "payment_value", 0),
    ]


def intermediate_checks(models: Mapping[str, DataFrame]) -> list[Check]:
    return _generic("intermediate", models)


def mart_checks(marts: Mapping[str, DataFrame], stg_items: DataFrame) -> list[Check]:
    """Checks of the marts, business rules included."""
    items, orders = marts["fct_order_items"], marts["fct_orders"]
    return [
        *_generic("marts", marts),
        dq.accepted_values("dim_customers", marts["dim_customers"], "rfm_segment", RFM_SEGMENTS),
        every_item_reaches_the_fact(stg_items, items),
        payments_cover_the_order(orders),
        revenue_only_from_delivered(items),
        revenue_reconciles(items, orders),
    ]


def every_item_reaches_the_fact(stg_items: DataFrame, fct_order_items: DataFrame) -> Check:
    key = ("order_id", "order_item_id")
    lost = stg_items.select(*key).subtract(fct_order_items.select(*key))
    return Check(
        "every_item_reaches_the_fact",
        lost,
        child=Keys(stg_items, key),
        parent=Keys(fct_order_items, key),
        distinct=True,
    )


def payments_cover_the_order(fct_orders: DataFrame, tolerance: int = 1) -> Check:
    """Paying more is normal (interest); a few underpaid orders only warn."""
    due = F.col("items_amount") + F.col("freight_amount")
    rule = F.col("payments_count").isNotNull() & (F.col("payment_amount") < due - tolerance)
    underpaid = fct_orders.filter(rule).select("order_id", due.alias("amount_due"), "payment_amount")
    return Check(
        "payments_cover_items_and_freight", underpaid, error_above=100, counted=fct_orders, rule=rule
    )


def revenue_only_from_delivered(fct_order_items: DataFrame) -> Check:
    rule = F.expr("revenue <> 0 and order_status <> 'delivered'")
    wrong = fct_order_items.filter(rule).select("order_id", "order_item_id", "order_status", "revenue")
    return Check("revenue_only_from_delivered", wrong, counted=fct_order_items, rule=rule)


def revenue_reconciles(fct_order_items: DataFrame, fct_orders: DataFrame) -> Check:
    """One failing row, with both totals, when the facts disagree."""
    items = fct_order_items.agg(F.sum("revenue").alias("items_revenue"))
    orders = fct_orders.agg(F.sum("revenue").alias("orders_revenue"))
    differ = items.crossJoin(F.broadcast(orders)).filter("items_revenue <> orders_revenue")
    return Check(
        "revenue_reconciles_between_facts",
        differ,
        sums=((fct_order_items, "revenue"), (fct_orders, "revenue")),
    )


def source_profile(raw: Mapping[str, DataFrame], stg: Mapping[str, DataFrame]) -> DataFrame:
    """Known anomalies, counted and left in place: ``metric, value``."""

    def metric(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("metric"), F.col("value").cast("bigint"))

    def rows(df: DataFrame, condition: str) -> DataFrame:
        return df.agg(F.count_if(F.expr(condition)).alias("value"))

    shared_reviews = (
        stg["order_reviews"]
        .groupBy("review_id")
        .agg(F.count_distinct("order_id").alias("orders"))
        .agg(F.count_if(F.col("orders") > 1).alias("value"))
    )
    spelled = raw["sellers"].agg(F.count_distinct("seller_city").alias("value"))
    cleaned = stg["sellers"].agg(F.count_distinct("city").alias("value"))
    return (
        metric("zip_with_leading_zero", rows(stg["customers"], "zip_code_prefix like '0%'"))
        .union(metric("review_ids_shared_by_orders", shared_reviews))
        .union(
            metric(
                "handed_to_carrier_before_purchase",
                rows(stg["orders"], "delivered_to_carrier_at < purchased_at"),
            )
        )
        .union(metric("points_outside_the_box", rows(stg["geolocation"], "not is_in_brazil")))
        .union(metric("seller_city_spellings", spelled))
        .union(metric("seller_cities", cleaned))
        .union(metric("products_without_category", rows(stg["products"], "category_name is null")))
    )


def payment_match_profile(fct_orders: DataFrame) -> DataFrame:
    """How payments compare with the amount due, for orders that have both."""
    due = F.col("items_amount") + F.col("freight_amount")
    both = fct_orders.filter((F.col("items_count") > 0) & F.col("payments_count").isNotNull())
    paid = F.col("payment_amount")
    return both.agg(
        F.count("*").alias("orders"),
        F.count_if(paid == due).alias("exact"),
        F.count_if(paid > due).alias("overpaid"),
        F.count_if(paid < due).alias("underpaid"),
        F.count_if((paid > due) & (F.col("max_installments") > 1)).alias("overpaid_by_instalments"),
    )
