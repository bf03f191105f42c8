"""Staging: one raw table in, one typed and renamed table out. No joins.

Raw columns are text.  The casts are ANSI, so a value that does not parse
fails the run instead of turning into NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.numeric import money
from shopmart.functions.text import blank_to_null, clean_city_name, state_code
from shopmart.tables import TableSet

# The box around Brazil, in degrees.
BRAZIL_LATITUDE = (-34.0, 5.5)
BRAZIL_LONGITUDE = (-74.0, -34.5)


def _timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        clean_city_name(F.col("customer_city")).alias("city"),
        state_code(F.col("customer_state")).alias("state"),
    )


def stg_geolocation(
    raw: DataFrame,
    latitude_box: tuple[float, float] = BRAZIL_LATITUDE,
    longitude_box: tuple[float, float] = BRAZIL_LONGITUDE,
) -> DataFrame:
    """Points outside the box (or without coordinates) are flagged, not dropped."""
    points = raw.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("latitude"),
        F.col("geolocation_lng").cast("double").alias("longitude"),
        clean_city_name(F.col("geolocation_city")).alias("city"),
        state_code(F.col("geolocation_state")).alias("state"),
    )
    inside = F.col("latitude").between(*latitude_box) & F.col("longitude").between(*longitude_box)
    return points.withColumn("is_in_brazil", F.coalesce(inside, F.lit(False)))


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id",
        "seller_id",
        _timestamp("shipping_limit_date").alias("shipping_limit_at"),
        money(F.col("price")).alias("price"),
        money(F.col("freight_value")).alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        money(F.col("payment_value")).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        blank_to_null(F.col("review_comment_title")).alias("comment_title"),
        blank_to_null(F.col("review_comment_message")).alias("comment_message"),
        _timestamp("review_creation_date").alias("survey_sent_at"),
        _timestamp("review_answer_timestamp").alias("answered_at"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        _timestamp("order_purchase_timestamp").alias("purchased_at"),
        _timestamp("order_approved_at").alias("approved_at"),
        _timestamp("order_delivered_carrier_date").alias("delivered_to_carrier_at"),
        _timestamp("order_delivered_customer_date").alias("delivered_to_customer_at"),
        F.to_date(_timestamp("order_estimated_delivery_date")).alias("estimated_delivery_date"),
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("product_category_name").alias("category_name"),
        F.trim("product_category_name_english").alias("category_name_en"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    # The source spells "length" as "lenght" in two of its column names.
    sizes = {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
        "product_photos_qty": "photos_count",
        "product_weight_g": "weight_g",
        "product_length_cm": "length_cm",
        "product_height_cm": "height_cm",
        "product_width_cm": "width_cm",
    }
    return raw.select(
        "product_id",
        blank_to_null(F.col("product_category_name")).alias("category_name"),
        *[F.col(old).cast("int").alias(new) for old, new in sizes.items()],
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        clean_city_name(F.col("seller_city")).alias("city"),
        state_code(F.col("seller_state")).alias("state"),
    )


STAGING: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": stg_customers,
    "geolocation": stg_geolocation,
    "order_items": stg_order_items,
    "order_payments": stg_order_payments,
    "order_reviews": stg_order_reviews,
    "orders": stg_orders,
    "product_category_name_translation": stg_category_translation,
    "products": stg_products,
    "sellers": stg_sellers,
}


def stage(raw: Mapping[str, DataFrame]) -> TableSet:
    """Stage every raw table, each when it is first used."""

    def staged(table: str) -> Callable[[], DataFrame]:
        return lambda: STAGING[table](raw[table])

    return TableSet({table: staged(table) for table in raw})
