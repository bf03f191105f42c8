"""A small sample that keeps every reference intact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POINTS_PER_PREFIX = 3


#: Rows are counted by so many first digits of their hash: 65,536 classes.
HASH_DIGITS = 4


def sample_orders(orders: DataFrame, count: int = 500) -> DataFrame:
    """The ``count`` orders with the lowest hash of their id: stable across runs.

    The classes of first digits that lie wholly in the sample are kept by a filter; only
    the class the bound falls into, one in 65,536, is ranked. So a sample may be any share of the orders without
    meeting in one task.
    """
    hashed = orders.withColumn("__hash", F.md5(F.col("order_id").cast("string")))
    digits = F.substring("__hash", 1, HASH_DIGITS)
    classes = hashed.groupBy(digits.alias("__class")).agg(F.count("*").alias("__rows"))
    upto = Window.orderBy("__class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = classes.withColumn("__upto", F.sum("__rows").over(upto))
    # One row: the first class with which the sample is full, and how many of it belong to it.
    bound = reached.filter(F.col("__upto") >= count).agg(
        F.min_by(F.struct("__class", "__upto", "__rows"), "__class").alias("__last")
    )
    placed = hashed.crossJoin(F.broadcast(bound)).withColumn("__class", digits)
    last = F.col("__last.__class")
    whole = placed.filter(last.isNull() | (F.col("__class") < last))
    place = F.row_number().over(Window.partitionBy("__class").orderBy("__hash", "order_id"))
    left = count - (F.col("__last.__upto") - F.col("__last.__rows"))
    part = placed.filter(F.col("__class") == last).withColumn("__place", place).filter(F.col("__place") <= left)
    return whole.select(*orders.columns).unionByName(part.select(*orders.columns))


def first_per_key(df: DataFrame, key: str, order: Sequence[Column], count: int) -> DataFrame:
    """At most ``count`` rows per key; every task drops its surplus before the shuffle."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__place", place).filter(F.col("__place") <= count).drop("__place")


def consistent_sample(
    raw: Mapping[str, DataFrame], count: int = 500, points: int = POINTS_PER_PREFIX
) -> dict[str, DataFrame]:
    """Sampled orders and every row of the other tables that belongs to them."""
    orders = sample_orders(raw["orders"], count)
    order_ids = orders.select("order_id")

    def of_orders(table: str) -> DataFrame:
        return raw[table].join(order_ids, "order_id", "left_semi")

    items = of_orders("order_items")
    customers = raw["customers"].join(orders.select("customer_id"), "customer_id", "left_semi")
    sellers = raw["sellers"].join(items.select("seller_id"), "seller_id", "left_semi")
    prefixes = customers.select(
        F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix")
    ).union(sellers.select("seller_zip_code_prefix"))
    places = raw["geolocation"].join(prefixes, "geolocation_zip_code_prefix", "left_semi")
    tables = {
        "orders": orders,
        "order_items": items,
        "order_payments": of_orders("order_payments"),
        "order_reviews": of_orders("order_reviews"),
        "customers": customers,
        "products": raw["products"].join(items.select("product_id"), "product_id", "left_semi"),
        "sellers": sellers,
        "geolocation": first_points(places, points),
        "product_category_name_translation": raw["product_category_name_translation"],
    }
    return {
        name: df.select(*raw[name].columns) for name, df in tables.items() if name in raw
    }


def first_points(geolocation: DataFrame, count: int = POINTS_PER_PREFIX) -> DataFrame:
    """At most ``count`` points per zip prefix, by latitude, longitude and names."""
    order = [
        F.col(f"geolocation_{c}").asc_nulls_last() for c in ("lat", "lng", "city", "state")
    ]
    return first_per_key(geolocation, "geolocation_zip_code_prefix", order, count)
