"""The nine business questions, as functions over the marts.

Date ranges, states and labels are arguments.  Results are DataFrames in report
order; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmart.functions.calendar import month_start, months_between_starts
from shopmart.functions.numeric import mean, percent, ratio, true_percent
from shopmart.operators.scale import global_ntile, global_position, over_all
from shopmart.plans.marts import customer_flags
from shopmart.session import materialize
from shopmart.tables import TableSet


def kpis(fct_orders: DataFrame, *by: str) -> DataFrame:
    """Headline KPIs, optionally per value of ``by``.

    One pass over the orders: they are reduced to a row per person (and slice)
    first, which carries both the order measures and the repeat-customer rule.
    A person counts once in every slice they ordered in, as the repeat customer
    their whole history makes them.
    """
    score = F.col("review_score")
    persons = fct_orders.groupBy("customer_unique_id", *by).agg(
        F.sum("revenue").alias("revenue"),
        F.count_if("is_delivered").alias("delivered_orders"),
        F.count_if("is_late").alias("late_orders"),
        F.count("is_late").alias("orders_with_delivery_date"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("scores"),
    )
    persons = persons.withColumn("slice_delivered", F.col("delivered_orders"))
    if by:
        lifetime = F.sum("delivered_orders").over(Window.partitionBy("customer_unique_id"))
        persons = persons.withColumn("delivered_orders", lifetime)
    delivered = F.sum("slice_delivered")
    return (
        customer_flags(persons)
        .groupBy(*by)
        .agg(
            F.sum("revenue").alias("revenue_brl"),
            delivered.alias("delivered_orders"),
            ratio(F.sum("revenue"), delivered, 2).alias("average_order_value_brl"),
            percent(F.sum("late_orders"), F.sum("orders_with_delivery_date"), 2).alias(
                "late_delivery_rate_pct"
            ),
            ratio(F.sum("score_sum"), F.sum("scores"), 2).alias("average_review_score"),
            percent(
                F.count_if("is_repeat_customer"), F.count_if(F.col("delivered_orders") > 0), 2
            ).alias("repeat_purchase_rate_pct"),
        )
    )


def kpi_summary(fct_orders: DataFrame) -> DataFrame:
    return kpis(fct_orders)


def revenue_by_state(fct_orders: DataFrame) -> DataFrame:
    by_state = (
        fct_orders.filter("is_delivered")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.sum("revenue").alias("revenue_brl"),
            F.count("*").alias("delivered_orders"),
            mean(F.col("revenue"), 2).alias("average_order_value_brl"),
            percent(F.sum("freight_amount"), F.sum("items_amount"), 1).alias(
                "freight_pct_of_items"
            ),
            mean(F.col("delivery_days"), 1).alias("avg_delivery_days"),
            true_percent(F.col("is_late"), 1).alias("late_rate_pct"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
        )
    )
    revenue = F.col("revenue_brl")
    return by_state.select(
        # One row per state: small whatever the number of orders.
        F.rank().over(Window.orderBy(revenue.desc_nulls_first())).alias("revenue_rank"),
        "state",
        "revenue_brl",
        percent(revenue, over_all(F.sum(revenue)), 1).alias("revenue_share_pct"),
        "delivered_orders",
        "average_order_value_brl",
        "freight_pct_of_items",
        "avg_delivery_days",
        "late_rate_pct",
        "avg_review_score",
    ).orderBy("revenue_rank", "state")


def month_over_month(monthly: DataFrame, key: str) -> DataFrame:
    """Add the previous present month of the same ``key`` and the change in percent."""
    previous = F.lag("revenue_brl").over(Window.partitionBy(key).orderBy("month"))
    change = F.col("revenue_brl") - F.col("previous_month_brl")
    return monthly.withColumn("previous_month_brl", previous).withColumn(
        "mom_change_pct", percent(change, F.col("previous_month_brl"), 1)
    )


def revenue_by_state_monthly(
    fct_order_items: DataFrame,
    first_day: date = date(2017, 1, 1),
    last_day: date = date(2018, 8, 31),
    states: Sequence[str] | None = ("SP", "RJ", "MG"),
    report_from: date = date(2018, 1, 1),
) -> DataFrame:
    """Monthly revenue per state; the change is taken before the report is cut."""
    monthly = (
        fct_order_items.filter(F.col("purchase_date").between(first_day, last_day))
        .groupBy(
            F.col("customer_state").alias("state"),
            month_start(F.col("purchase_date")).alias("month"),
        )
        .agg(F.sum("revenue").alias("revenue_brl"))
    )
    report = month_over_month(monthly, "state").filter(F.col("month") >= F.lit(report_from))
    if states is not None:
        report = report.filter(F.col("state").isin(*states))
    return report.orderBy("state", "month")


# Upper bound in days of each delay bucket, and its label.
DELAY_BUCKETS = (
    (-10, "1. 10+ days early"),
    (0, "2. 0-9 days early"),
    (3, "3. 1-3 days late"),
    (7, "4. 4-7 days late"),
    (14, "5. 8-14 days late"),
)
DELAY_LAST_BUCKET = "6. 15+ days late"


def delay_bucket(delay_days: Column) -> Column:
    """Label of the delay bucket; NULL when there is no delay to speak of."""
    bucket = F.when(delay_days.isNull(), F.lit(None))
    for upper, label in DELAY_BUCKETS:
        bucket = bucket.when(delay_days <= upper, label)
    return bucket.otherwise(DELAY_LAST_BUCKET)


def late_delivery_vs_reviews(fct_orders: DataFrame) -> DataFrame:
    reviewed = fct_orders.filter("is_delivered and is_late is not null and review_score is not null")
    orders = F.count("*")
    return (
        reviewed.groupBy(delay_bucket(F.col("delivery_delay_days")).alias("delay_bucket"))
        .agg(
            orders.alias("orders"),
            mean(F.col("review_score"), 2).alias("avg_review_score"),
            true_percent(F.col("review_score") <= 2, 1).alias("one_or_two_stars_pct"),
        )
        .select(
            "delay_bucket",
            "orders",
            percent(F.col("orders"), over_all(F.sum("orders")), 1).alias("share_of_orders_pct"),
            "avg_review_score",
            "one_or_two_stars_pct",
        )
        .orderBy("delay_bucket")
    )


def monthly_cohorts(
    fct_orders: DataFrame,
    first_cohort: date = date(2017, 1, 1),
    last_cohort: date = date(2017, 12, 1),
) -> DataFrame:
    """Share of each monthly cohort that ordered again 1, 3, 6 and 1-12 months later.

    ``any_repeat_12m_pct`` counts (person, month) pairs: someone active in two
    later months counts twice.
    """
    # The set holds at most one entry per calendar month, and partial sets are
    # merged before the shuffle.
    active = (
        fct_orders.filter("is_delivered")
        .groupBy("customer_unique_id")
        .agg(F.collect_set(month_start(F.col("purchase_date"))).alias("months"))
        .withColumn("cohort_month", F.array_min("months"))
        .filter(F.col("cohort_month").between(first_cohort, last_cohort))
    )
    offsets = F.transform(
        "months", lambda month: months_between_starts(month, F.col("cohort_month"))
    )
    persons = active.select("cohort_month", offsets.alias("offsets"))
    size = F.count("*")

    def returned(offset: int) -> Column:
        return percent(F.count_if(F.array_contains("offsets", offset)), size, 2)

    within_year = F.size(F.filter("offsets", lambda offset: offset.between(1, 12)))
    return (
        persons.groupBy("cohort_month")
        .agg(
            size.alias("cohort_customers"),
            returned(1).alias("m1_pct"),
            returned(3).alias("m3_pct"),
            returned(6).alias("m6_pct"),
            percent(F.sum(within_year), size, 2).alias("any_repeat_12m_pct"),
        )
        .orderBy("cohort_month")
    )


def lines_per_order(fct_order_items: DataFrame, key: str) -> DataFrame:
    """Items reduced to one row per ``key`` and order.

    Joining orders to this cannot fan out, and an order with very many items
    arrives as one row per key.
    """
    carried = [F.any_value(c).alias(c) for c in ORDER_MEASURES if c in fct_order_items.columns]
    return fct_order_items.groupBy(key, "order_id").agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("lines"), *carried
    )


ORDER_MEASURES = ("review_score", "is_late")


def with_order_measures(lines: DataFrame, fct_orders: DataFrame | None) -> DataFrame:
    """Review score and lateness of the order; items that bring them along need no orders."""
    if fct_orders is None:
        return lines
    return lines.join(fct_orders.select("order_id", *ORDER_MEASURES), "order_id")


def with_category(fct_order_items: DataFrame, dim_products: DataFrame) -> DataFrame:
    category = F.col("category_name_en").alias("category")
    return fct_order_items.join(dim_products.select("product_id", category), "product_id")


def category_pareto(
    fct_order_items: DataFrame,
    dim_products: DataFrame,
    fct_orders: DataFrame | None = None,
    top: int = 15,
) -> DataFrame:
    """Categories by revenue with running share; review and late means weigh items."""
    lines = lines_per_order(
        with_category(fct_order_items.filter("is_delivered"), dim_products), "category"
    )
    n = F.col("lines")
    scored = F.when(F.col("review_score").isNotNull(), n)
    dated = F.when(F.col("is_late").isNotNull(), n)
    late = F.when(F.col("is_late"), n).otherwise(0)
    by_category = (
        with_order_measures(lines, fct_orders)
        .groupBy("category")
        .agg(
            F.sum("revenue").alias("revenue_brl"),
            F.count("*").alias("orders"),
            ratio(F.sum(F.col("review_score") * n), F.sum(scored), 2).alias("avg_review_score"),
            percent(F.sum(late), F.sum(dated), 1).alias("late_rate_pct"),
        )
    )
    # Categories are free text in the source, so their number is not bounded.
    placed = global_position(
        by_category,
        [F.col("revenue_brl").desc_nulls_first(), F.col("category").asc_nulls_last()],
        running={"revenue_so_far": "revenue_brl"},
        label="pareto",
    )
    total = placed.agg(F.sum("revenue_brl").alias("total"))
    return (
        placed.filter(F.col("row_number") <= top)
        .crossJoin(F.broadcast(total))
        .select(
            F.col("row_number").alias("revenue_rank"),
            "category",
            "revenue_brl",
            percent(F.col("revenue_brl"), F.col("total"), 1).alias("revenue_share_pct"),
            percent(F.col("revenue_so_far"), F.col("total"), 1).alias("cumulative_share_pct"),
            "orders",
            "avg_review_score",
            "late_rate_pct",
            F.col("group_rows").alias("categories_count"),
        )
        .orderBy("revenue_rank")
    )


def seller_concentration(fct_order_items: DataFrame, tiles: int = 10) -> DataFrame:
    by_seller = (
        fct_order_items.filter("is_delivered")
        .groupBy("seller_id")
        .agg(F.sum("revenue").alias("revenue_brl"))
    )
    order = (("revenue_brl", False), ("seller_id", True))
    deciles = (
        global_ntile(materialize(by_seller, "seller_revenue"), tiles, order, "revenue_decile")
        .groupBy("revenue_decile")
        .agg(F.count("*").alias("sellers"), F.sum("revenue_brl").alias("revenue_brl"))
    )
    share = percent(F.col("revenue_brl"), over_all(F.sum("revenue_brl")), 1)
    return deciles.withColumn("revenue_share_pct", share).orderBy("revenue_decile")


def rfm_segments(dim_customers: DataFrame) -> DataFrame:
    revenue = F.col("lifetime_revenue")
    return (
        dim_customers.filter("delivered_orders > 0")
        .groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customers"),
            F.sum(revenue).alias("revenue_brl"),
            mean(revenue, 2).alias("avg_lifetime_revenue_brl"),
            mean(F.col("recency_days"), 0).alias("avg_recency_days"),
        )
        .select(
            "rfm_segment",
            "customers",
            percent(F.col("customers"), over_all(F.sum("customers")), 1).alias("customers_pct"),
            "revenue_brl",
            percent(F.col("revenue_brl"), over_all(F.sum("revenue_brl")), 1).alias(
                "revenue_share_pct"
            ),
            "avg_lifetime_revenue_brl",
            "avg_recency_days",
        )
        .orderBy(F.col("revenue_brl").desc_nulls_first(), "rfm_segment")
    )


def black_friday(
    fct_order_items: DataFrame,
    dim_date: DataFrame,
    first_day: date = date(2017, 11, 1),
    last_day: date = date(2017, 11, 30),
    label: str = "Black Friday (2017-11-24)",
    other_label: str = "Other November days",
) -> DataFrame:
    """Mean orders and revenue of Black Friday against the other days of the range."""
    daily = (
        fct_order_items.filter(F.col("purchase_date").between(first_day, last_day))
        .groupBy("purchase_date")
        .agg(F.sum("revenue").alias("revenue_brl"), F.count_distinct("order_id").alias("orders"))
    )
    calendar = dim_date.select(F.col("date_day").alias("purchase_date"), "is_black_friday")
    return (
        daily.join(calendar, "purchase_date")
        .groupBy("is_black_friday")
        .agg(
            F.count("*").alias("day_count"),
            mean(F.col("orders"), 0).alias("avg_orders_per_day"),
            mean(F.col("revenue_brl"), 2).alias("avg_revenue_per_day_brl"),
        )
        .orderBy(F.col("is_black_friday").desc())
        .select(
            F.when(F.col("is_black_friday"), label).otherwise(other_label).alias("day_type"),
            "day_count",
            "avg_orders_per_day",
            "avg_revenue_per_day_brl",
        )
    )


def findings(tables: Mapping[str, DataFrame]) -> TableSet:
    """The nine reports over the marts, each defined when it is asked for."""
    orders, items = tables["fct_orders"], tables["fct_order_items"]
    return TableSet(
        {
            "kpi_summary": lambda: kpi_summary(orders),
            "revenue_by_state": lambda: revenue_by_state(orders),
            "revenue_by_state_monthly": lambda: revenue_by_state_monthly(items),
            "late_delivery_vs_reviews": lambda: late_delivery_vs_reviews(orders),
            "monthly_cohorts": lambda: monthly_cohorts(orders),
            "category_pareto": lambda: category_pareto(items, tables["dim_products"], orders),
            "seller_concentration": lambda: seller_concentration(items),
            "rfm_segments": lambda: rfm_segments(tables["dim_customers"]),
            "black_friday": lambda: black_friday(items, tables["dim_date"]),
        }
    )
