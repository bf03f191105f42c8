"""Intermediate models: joins and the business rules every mart reuses.

``is_delivered`` and ``is_late`` are defined once, in :func:`order_core`.
Per-order inputs are reduced with aggregates rather than windows: partial
aggregation runs before the shuffle, so one order (or person) with a third of
all rows never lands in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.numeric import MONEY_TOTAL, coordinate_mean

DELIVERED = "delivered"


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("items_count"),
        F.count_distinct("seller_id").alias("sellers_count"),
        F.sum("price").alias("items_amount"),
        F.sum("freight_value").alias("freight_amount"),
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """The main type is that of the largest payment, the earliest on a tie."""
    # NULLs order first, as a descending sort of the amount would put them.
    largest_first = F.struct(
        (-F.col("payment_value")).alias("by_value"), "payment_sequential", "payment_type"
    )
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_amount"),
        F.count("*").alias("payments_count"),
        F.max("payment_installments").alias("max_installments"),
        F.bool_or(F.col("payment_type") == "voucher").alias("used_voucher"),
        F.min(largest_first)["payment_type"].alias("main_payment_type"),
    )


def _newest_first(name: str) -> Column:
    """Ascending sort key that is newest-first, with NULL before everything."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return (-F.timestamp_diff("MICROSECOND", epoch, F.col(name))).alias(f"by_{name}")


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """The latest answer wins; then the latest survey; then the lowest review id."""
    latest = F.min_by(
        F.struct(
            "review_id",
            "review_score",
            F.col("comment_message").isNotNull().alias("has_comment"),
            "answered_at",
        ),
        F.struct(_newest_first("answered_at"), _newest_first("survey_sent_at"), "review_id"),
    )
    return (
        reviews.groupBy("order_id")
        .agg(latest.alias("latest"), F.count("*").alias("reviews_count"))
        .select(
            "order_id",
            "latest.review_id",
            "latest.review_score",
            "latest.has_comment",
            F.col("latest.answered_at").alias("review_answered_at"),
            "reviews_count",
        )
    )


def order_core(
    orders: DataFrame, customers: DataFrame, address: tuple[str, ...] = ()
) -> DataFrame:
    """Orders with the person behind them, the delivered rule and the delivery clock.

    ``is_late`` compares days and only needs a delivery date: it does not look
    at the status.  Orders without a customer row are dropped.  ``address``
    names customer columns to carry along.
    """
    delivered_on = F.to_date("delivered_to_customer_at")
    who = customers.select(
        "customer_id", "customer_unique_id", F.col("state").alias("customer_state"), *address
    )
    return orders.join(who, "customer_id").select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "customer_state",
        "order_status",
        (F.col("order_status") == DELIVERED).alias("is_delivered"),
        "purchased_at",
        F.to_date("purchased_at").alias("purchase_date"),
        "approved_at",
        "delivered_to_carrier_at",
        "delivered_to_customer_at",
        "estimated_delivery_date",
        F.datediff(delivered_on, F.to_date("purchased_at")).alias("delivery_days"),
        F.datediff(delivered_on, F.col("estimated_delivery_date")).alias("delivery_delay_days"),
        (delivered_on > F.col("estimated_delivery_date")).alias("is_late"),
        *address,
    )


def with_items(orders: DataFrame, per_order: DataFrame) -> DataFrame:
    """Attach item amounts; an order without items gets zeros."""
    amounts = ["items_count", "sellers_count", "items_amount", "freight_amount"]
    joined = orders.join(per_order.select("order_id", *amounts), "order_id", "left")
    return joined.fillna(0, amounts)


def with_payments(orders: DataFrame, per_order: DataFrame) -> DataFrame:
    """Attach payments; the amount is 0 but the count stays NULL when unpaid."""
    joined = orders.join(
        per_order.select(
            "order_id",
            "payment_amount",
            "payments_count",
            "max_installments",
            "used_voucher",
            "main_payment_type",
        ),
        "order_id",
        "left",
    )
    return joined.fillna(0, ["payment_amount"])


def with_reviews(orders: DataFrame, per_order: DataFrame) -> DataFrame:
    """Attach the latest review; everything stays NULL when there is none."""
    kept = per_order.select("order_id", "review_id", "review_score", "has_comment", "reviews_count")
    return orders.join(kept, "order_id", "left")


def orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame | None = None,
    payments: DataFrame | None = None,
    reviews: DataFrame | None = None,
    address: tuple[str, ...] = (),
) -> DataFrame:
    """One row per order with amounts, payments, latest review and delivery metrics.

    A caller that does not need one of the per-order inputs leaves it out and
    saves its scan and join; the matching columns are then absent.
    """
    result = order_core(orders, customers, address)
    if items is not None:
        result = with_items(result, items_per_order(items))
    if payments is not None:
        result = with_payments(result, payments_per_order(payments))
    if reviews is not None:
        result = with_reviews(result, reviews_per_order(reviews))
    return result


ADDRESS = ("zip_code_prefix", "city", "state")


def customer_orders(orders: DataFrame, scores: bool = False) -> DataFrame:
    """Order history per person, with the address of the latest order.

    ``scores`` adds the sum and number of review scores, for orders that have them.

    ``orders`` is :func:`orders_enriched` with items and ``address=ADDRESS``
    (``state`` is carried as the address state).  Orders placed at the same
    moment are told apart by the highest ``customer_id``.
    """
    delivered = F.col("is_delivered")
    revenue = F.coalesce(F.sum(F.when(delivered, F.col("items_amount"))), F.lit(0))
    reviewed = [F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scores")]
    return (
        orders.groupBy("customer_unique_id")
        .agg(
            F.min("purchased_at").alias("first_order_at"),
            F.max("purchased_at").alias("last_order_at"),
            F.count("*").alias("orders_count"),
            F.count_if(delivered).alias("delivered_orders"),
            F.max(F.when(delivered, F.col("purchased_at"))).alias("last_delivered_order_at"),
            revenue.cast(MONEY_TOTAL).alias("lifetime_revenue"),
            F.max_by(F.struct(*ADDRESS), F.struct("purchased_at", "customer_id")).alias("latest"),
            *(reviewed if scores else ()),
        )
        .select("*", "latest.*")
        .drop("latest")
    )


def zip_code_locations(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates of the points inside Brazil, by zip prefix."""
    return (
        geolocation.filter("is_in_brazil")
        .groupBy("zip_code_prefix")
        .agg(
            coordinate_mean(F.col("latitude")).cast("double").alias("latitude"),
            coordinate_mean(F.col("longitude")).cast("double").alias("longitude"),
        )
    )
