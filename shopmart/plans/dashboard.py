"""Measures behind the dashboard pages; the drawing itself is left to a BI tool."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.functions.calendar import month_start, months_between_starts
from shopmart.functions.numeric import mean, percent, ratio, true_percent
from shopmart.plans.analyses import (
    delay_bucket,
    kpis,
    lines_per_order,
    with_category,
    with_order_measures,
)


def kpi_by_year(fct_orders: DataFrame) -> DataFrame:
    """The six KPI tiles for every value of the year filter."""
    by_year = fct_orders.withColumn("year", F.year("purchase_date"))
    return kpis(by_year, "year").orderBy("year")


def monthly_revenue(fct_order_items: DataFrame) -> DataFrame:
    return (
        fct_order_items.groupBy(month_start(F.col("purchase_date")).alias("month"))
        .agg(F.sum("revenue").alias("revenue_brl"))
        .orderBy("month")
    )


def _drill(items: DataFrame, key: str, state: str, month: date) -> DataFrame:
    """Revenue per ``key`` in one state and month, and the change on the month before."""
    this = F.lit(month)
    in_month = month_start(F.col("purchase_date"))
    previous = F.add_months(this, -1)
    selected = items.filter(
        (F.col("customer_state") == state)
        & (F.col("purchase_date") >= previous)
        & (F.col("purchase_date") < F.add_months(this, 1))
    )
    revenue = F.col("revenue")
    return (
        selected.groupBy(key)
        .agg(
            F.sum(F.when(in_month == this, revenue)).alias("revenue_brl"),
            F.sum(F.when(in_month == previous, revenue)).alias("previous_month_brl"),
        )
        .filter(F.col("revenue_brl").isNotNull())
        .withColumn(
            "change_pct",
            percent(
                F.col("revenue_brl") - F.col("previous_month_brl"),
                F.col("previous_month_brl"),
                1,
            ),
        )
        .orderBy(F.col("revenue_brl").desc(), F.col(key).asc_nulls_last())
    )


def revenue_drill_category(
    fct_order_items: DataFrame, dim_products: DataFrame, state: str, month: date
) -> DataFrame:
    return _drill(with_category(fct_order_items, dim_products), "category", state, month)


def drill_quality(
    fct_order_items: DataFrame,
    dim_products: DataFrame,
    fct_orders: DataFrame,
    state: str,
    month: date,
) -> DataFrame:
    """Orders, late rate and mean review score of a drilled state and month, by category.

    An order counts once in each category it has items of. Items are reduced to
    orders before they meet the reviews.
    """
    selected = fct_order_items.filter(
        (F.col("customer_state") == state)
        & (F.col("purchase_date") >= F.lit(month))
        & (F.col("purchase_date") < F.add_months(F.lit(month), 1))
    )
    orders = with_category(selected, dim_products).select("category", "order_id").distinct()
    told = fct_orders.select("order_id", "is_late", "review_score")
    return (
        orders.join(told, "order_id")
        .groupBy("category")
        .agg(
            F.count("*").alias("orders"),
            true_percent(F.col("is_late"), 1).alias("late_rate_pct"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
        )
        .orderBy(F.col("orders").desc(), F.col("category").asc_nulls_last())
    )


def revenue_drill_top_sellers(
    fct_order_items: DataFrame,
    state: str,
    month: date,
    dim_products: DataFrame | None = None,
    category: str | None = None,
    top: int = 10,
) -> DataFrame:
    """Best sellers of a state and month, optionally within one category."""
    items = fct_order_items
    if category is not None:
        items = with_category(items, dim_products).filter(F.col("category") == category)
    return _drill(items, "seller_id", state, month).limit(top)


def retention_matrix(
    fct_orders: DataFrame,
    first_cohort: date = date(2017, 1, 1),
    last_cohort: date = date(2017, 12, 1),
) -> DataFrame:
    """Distinct persons per cohort and month offset, as a percent of month 0.

    The cohort is the month of the first delivered order, while every order
    counts as activity: an undelivered order may even fall before month 0.
    """
    month = month_start(F.col("purchase_date"))
    # At most one set entry per calendar month.
    persons = (
        fct_orders.groupBy("customer_unique_id")
        .agg(
            F.min(F.when(F.col("is_delivered"), month)).alias("cohort_month"),
            F.collect_set(month).alias("months"),
        )
        .filter(F.col("cohort_month").between(first_cohort, last_cohort))
    )
    cells = (
        persons.select("cohort_month", F.explode("months").alias("month"))
        .select(
            "cohort_month",
            months_between_starts(F.col("month"), F.col("cohort_month")).alias(
                "months_since_first"
            ),
        )
        .groupBy("cohort_month", "months_since_first")
        .agg(F.count("*").alias("customers"))
    )
    at_start = F.max(F.when(F.col("months_since_first") == 0, F.col("customers")))
    cohort = Window.partitionBy("cohort_month")
    return cells.withColumn(
        "retention_pct", percent(F.col("customers"), at_start.over(cohort), 2)
    ).orderBy("cohort_month", "months_since_first")


def repeat_rate_by_state(customers: DataFrame) -> DataFrame:
    buyers = F.count_if(F.col("delivered_orders") > 0)
    repeat = F.count_if("is_repeat_customer")
    return (
        customers.groupBy("state")
        .agg(
            buyers.alias("buying_customers"),
            repeat.alias("repeat_customers"),
            percent(repeat, buyers, 2).alias("repeat_rate_pct"),
        )
        .orderBy("state")
    )


def review_by_delay_bucket(fct_orders: DataFrame) -> DataFrame:
    """Mean review by delay bucket over all orders; no delay gives a NULL bucket."""
    return (
        fct_orders.groupBy(delay_bucket(F.col("delivery_delay_days")).alias("delay_bucket"))
        .agg(
            F.count("*").alias("orders"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
        )
        .orderBy(F.col("delay_bucket").asc_nulls_last())
    )


def order_level_measures(
    fct_order_items: DataFrame, dim_products: DataFrame, fct_orders: DataFrame | None = None
) -> DataFrame:
    """Item revenue and order measures side by side, every order once per category."""
    lines = lines_per_order(with_category(fct_order_items, dim_products), "category")
    return (
        with_order_measures(lines, fct_orders)
        .groupBy("category")
        .agg(
            F.sum("revenue").alias("revenue_brl"),
            F.sum("lines").alias("items"),
            F.count("*").alias("orders"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
            true_percent(F.col("is_late"), 1).alias("late_rate_pct"),
        )
        .orderBy("category")
    )


def customer_kpis(
    dim_customers: DataFrame,
    fct_orders: DataFrame | None = None,
    by: str = "rfm_segment",
    segment: str | None = None,
) -> DataFrame:
    """Customers, repeat rate and mean review, optionally for one RFM segment.

    Customers that carry their review scores need no orders.
    """
    if segment is not None:
        dim_customers = dim_customers.filter(F.col("rfm_segment") == segment)
    if fct_orders is not None:
        scores = fct_orders.groupBy("customer_unique_id").agg(
            F.sum("review_score").alias("score_sum"), F.count("review_score").alias("scores")
        )
        dim_customers = dim_customers.join(scores, "customer_unique_id", "left")
    buyers = F.count_if(F.col("delivered_orders") > 0)
    return (
        dim_customers.groupBy(by)
        .agg(
            F.count("*").alias("customers"),
            percent(F.count_if("is_repeat_customer"), buyers, 2).alias("repeat_rate_pct"),
            ratio(F.sum("score_sum"), F.sum("scores"), 2).alias("avg_review_score"),
        )
        .orderBy(by)
    )


def seller_complaints(
    fct_order_items: DataFrame, fct_orders: DataFrame | None = None
) -> DataFrame:
    """Who drives complaints: every order counts once for each of its sellers."""
    sold = lines_per_order(fct_order_items, "seller_id")
    return (
        with_order_measures(sold, fct_orders)
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("orders"),
            F.count("review_score").alias("reviewed_orders"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
            true_percent(F.col("review_score") <= 2, 1).alias("one_or_two_stars_pct"),
            true_percent(F.col("is_late"), 1).alias("late_rate_pct"),
        )
    )
