"""Reports over hand-made facts."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shopmart.plans import analyses, dashboard, marts

ORDERS = (
    "order_id int, customer_unique_id string, customer_state string, purchase_date date,"
    " is_delivered boolean, is_late boolean, delivery_days int, delivery_delay_days int,"
    " review_score int, revenue decimal(22,2), items_amount decimal(22,2),"
    " freight_amount decimal(22,2)"
)
ITEMS = (
    "order_id int, order_item_id int, customer_unique_id string, customer_state string,"
    " product_id int, seller_id int, purchase_date date, is_delivered boolean,"
    " revenue decimal(12,2)"
)
PRODUCTS = "product_id int, category_name_en string"


def order(n, person, state, day, delivered=True, late=False, delay=-5, score=5, revenue=10):
    money = D(revenue) if delivered else D(0)
    return (n, person, state, date.fromisoformat(day), delivered, late, 3, delay, score, money,
            D(revenue), D(1))


def item(n, line, state, product, seller, day, revenue, delivered=True):
    return (n, line, f"p{n}", state, product, seller, date.fromisoformat(day), delivered, D(revenue))


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def orders(frame):
    return frame(
        [
            order(1, "a", "SP", "2017-01-05", revenue=10),
            order(2, "a", "SP", "2017-02-05", late=True, delay=1, score=1, revenue=20),
            order(3, "b", "RJ", "2017-01-20", late=None, delay=None, score=None, revenue=30),
            # cancelled but delivered late: counts in the late rate, earns nothing
            order(4, "c", "RJ", "2018-01-20", delivered=False, late=True, delay=20, score=2),
        ],
        ORDERS,
    )


def test_kpis(orders):
    assert rows(analyses.kpi_summary(orders)) == [
        (D("60.00"), 3, D("20.00"), D("66.67"), D("2.67"), D("50.00"))
    ]


def test_kpis_of_nothing_are_null(orders):
    (row,) = rows(analyses.kpi_summary(orders.limit(0)))
    assert row[2:] == (None, None, None, None)


def test_kpis_by_year_use_the_whole_history(orders, frame):
    later = frame([order(5, "b", "RJ", "2018-03-01")], ORDERS)
    by_year = {r.year: r for r in dashboard.kpi_by_year(orders.union(later)).collect()}
    # b buys once in each year and is a repeat customer in both
    assert by_year[2017].repeat_purchase_rate_pct == 100
    assert by_year[2018].repeat_purchase_rate_pct == 100
    assert (by_year[2018].delivered_orders, by_year[2018].late_delivery_rate_pct) == (1, 50)


def test_states_rank_with_ties(orders):
    got = [(r.revenue_rank, r.state, r.revenue_share_pct, r.late_rate_pct, r.avg_review_score)
           for r in analyses.revenue_by_state(orders).collect()]
    assert got == [(1, "RJ", D("50.0"), None, None), (1, "SP", D("50.0"), D("50.0"), D("3.00"))]


def test_change_is_on_the_previous_present_month(frame):
    items = frame(
        [
            item(1, 1, "SP", 1, 1, "2017-10-01", 100),
            item(2, 1, "SP", 1, 1, "2018-01-01", 50),  # November and December are missing
            item(3, 1, "SP", 1, 1, "2018-02-01", 0, delivered=False),
            item(4, 1, "SP", 1, 1, "2018-03-01", 10),
            item(5, 1, "BA", 1, 1, "2018-03-01", 10),
        ],
        ITEMS,
    )
    got = rows(analyses.revenue_by_state_monthly(items))
    assert got == [
        ("SP", date(2018, 1, 1), D("50.00"), D("100.00"), D("-50.0")),
        ("SP", date(2018, 2, 1), D("0.00"), D("50.00"), D("-100.0")),
        ("SP", date(2018, 3, 1), D("10.00"), D("0.00"), None),
    ]
    assert analyses.revenue_by_state_monthly(items, states=None).count() == 4


@pytest.mark.parametrize(
    ("delay", "bucket"),
    [(-11, "1"), (-10, "1"), (-9, "2"), (0, "2"), (1, "3"), (3, "3"), (4, "4"), (7, "4"),
     (8, "5"), (14, "5"), (15, "6"), (None, None)],
)
def test_delay_buckets(frame, delay, bucket):
    label = frame([(delay,)], "d int").select(analyses.delay_bucket(F.col("d"))).first()[0]
    assert label is None if bucket is None else label.startswith(bucket + ".")


def test_late_deliveries_only_count_delivered_and_reviewed(orders):
    got = [(r.delay_bucket[0], r.orders, r.share_of_orders_pct, r.one_or_two_stars_pct)
           for r in analyses.late_delivery_vs_reviews(orders).collect()]
    assert got == [("2", 1, D("50.0"), D("0.0")), ("3", 1, D("50.0"), D("100.0"))]


def test_all_orders_by_bucket_have_a_null_bucket(orders):
    got = {r.delay_bucket: r.orders for r in dashboard.review_by_delay_bucket(orders).collect()}
    assert got[None] == 1 and sum(got.values()) == 4


@pytest.fixture
def cohort(frame):
    return frame(
        [
            order(1, "a", "SP", "2017-01-05"),
            order(2, "a", "SP", "2017-02-05"),
            order(3, "a", "SP", "2017-02-15"),  # same month: once
            order(4, "a", "SP", "2017-04-05"),  # second later month: counts again
            order(5, "b", "SP", "2017-01-20"),
            order(6, "b", "SP", "2017-02-20", delivered=False),
            order(7, "c", "SP", "2016-12-20", delivered=False),
            order(8, "c", "SP", "2017-01-21"),
            order(9, "d", "SP", "2016-12-20"),  # cohort outside the range
        ],
        ORDERS,
    )


def test_cohorts_count_person_months(cohort):
    assert rows(analyses.monthly_cohorts(cohort)) == [
        (date(2017, 1, 1), 3, D("33.33"), D("33.33"), D("0.00"), D("66.67"))
    ]


def test_retention_counts_every_order_as_activity(cohort):
    got = {r.months_since_first: (r.customers, r.retention_pct)
           for r in dashboard.retention_matrix(cohort).collect()}
    assert got == {
        -1: (1, D("33.33")), 0: (3, D("100.00")), 1: (2, D("66.67")), 3: (1, D("33.33")),
    }


@pytest.fixture
def sold(frame):
    items = frame(
        [
            item(1, 1, "SP", 1, 1, "2017-03-01", 60),
            item(1, 2, "SP", 1, 1, "2017-03-01", 20),
            item(2, 1, "SP", 1, 2, "2017-03-09", 10),
            item(2, 2, "SP", 2, 2, "2017-03-09", 10),
            item(3, 1, "SP", 2, 1, "2017-02-09", 40),
            item(4, 1, "RJ", 2, 1, "2017-03-09", 30, delivered=False),
        ],
        ITEMS,
    ).withColumn("revenue", F.when(F.col("is_delivered"), F.col("revenue")).otherwise(0))
    products = frame([(1, "beauty"), (2, None)], PRODUCTS)
    orders = frame(
        [
            order(1, "p1", "SP", "2017-03-01", score=1, late=True),
            order(2, "p2", "SP", "2017-03-09", score=5),
            order(3, "p3", "SP", "2017-02-09", score=None, late=None),
            order(4, "p4", "RJ", "2017-03-09", delivered=False, score=1),
        ],
        ORDERS,
    )
    return items, products, orders


def test_pareto_weighs_reviews_by_item(sold):
    items, products, orders = sold
    got = rows(analyses.category_pareto(items, products, orders))
    assert got == [
        # scores 1, 1 and 5; two of three items late
        (1, "beauty", D("90.00"), D("64.3"), D("64.3"), 2, D("2.33"), D("66.7"), 2),
        (2, None, D("50.00"), D("35.7"), D("100.0"), 2, D("5.00"), D("0.0"), 2),
    ]
    assert analyses.category_pareto(items, products, orders, top=1).count() == 1


def test_order_measures_count_an_order_once_per_category(sold):
    items, products, orders = sold
    got = {r.category: r for r in dashboard.order_level_measures(items, products, orders).collect()}
    assert (got["beauty"].orders, got["beauty"].items, got["beauty"].avg_review_score) == (2, 3, 3)
    assert got[None].orders == 3


def test_seller_complaints_count_an_order_once(sold):
    items, _, orders = sold
    got = {r.seller_id: r for r in dashboard.seller_complaints(items, orders).collect()}
    assert (got[1].orders, got[1].reviewed_orders, got[1].one_or_two_stars_pct) == (3, 2, 100)


def test_seller_deciles(frame):
    items = frame([item(n, 1, "SP", 1, n, "2017-03-01", 100 - n) for n in range(20)], ITEMS)
    got = rows(analyses.seller_concentration(items))
    assert [r[:2] for r in got] == [(n, 2) for n in range(1, 11)]
    assert got[0][2] == 199


def test_drill_compares_with_the_month_before(sold):
    items, products, _ = sold
    got = rows(dashboard.revenue_drill_category(items, products, "SP", date(2017, 3, 1)))
    assert got == [
        ("beauty", D("90.00"), None, None),
        (None, D("10.00"), D("40.00"), D("-75.0")),
    ]
    top = dashboard.revenue_drill_top_sellers(items, "SP", date(2017, 3, 1), top=1)
    assert rows(top) == [(1, D("80.00"), D("40.00"), D("100.0"))]
    beauty = dashboard.revenue_drill_top_sellers(
        items, "SP", date(2017, 3, 1), products, "beauty"
    )
    assert [r[0] for r in rows(beauty)] == [1, 2]


def test_black_friday_counts_undelivered_orders(spark, frame):
    items = frame(
        [
            item(1, 1, "SP", 1, 1, "2017-11-24", 100),
            item(2, 1, "SP", 1, 1, "2017-11-24", 0, delivered=False),
            item(3, 1, "SP", 1, 1, "2017-11-23", 10),
            item(4, 1, "SP", 1, 1, "2017-11-22", 20),
            item(5, 1, "SP", 1, 1, "2017-12-01", 20),
        ],
        ITEMS,
    )
    got = rows(analyses.black_friday(items, marts.dim_date(marts.days(spark))))
    assert got == [
        ("Black Friday (2017-11-24)", 1, D("2"), D("100.00")),
        ("Other November days", 2, D("1"), D("15.00")),
    ]


def test_segments_and_customer_kpis(frame):
    dim = frame(
        [
            ("a", "SP", 2, True, D(100), 5, "champions"),
            ("b", "SP", 1, False, D(50), 10, "lost"),
            ("c", "RJ", 1, False, D(50), 11, "lost"),
            ("d", "RJ", 0, False, D(0), None, "no_delivered_order"),
        ],
        "customer_unique_id string, state string, delivered_orders int,"
        " is_repeat_customer boolean, lifetime_revenue decimal(22,2), recency_days int,"
        " rfm_segment string",
    )
    got = rows(analyses.rfm_segments(dim))
    assert got == [
        ("champions", 1, D("33.3"), D("100.00"), D("50.0"), D("100.00"), D("5")),
        ("lost", 2, D("66.7"), D("100.00"), D("50.0"), D("50.00"), D("11")),
    ]
    orders = frame([order(1, "a", "SP", "2017-01-01", score=4), order(2, "b", "SP", "2017-01-01", score=1)], ORDERS)
    by_segment = {r.rfm_segment: r for r in dashboard.customer_kpis(dim, orders).collect()}
    assert by_segment["champions"].repeat_rate_pct == 100
    assert by_segment["no_delivered_order"].repeat_rate_pct is None
    assert rows(dashboard.customer_kpis(dim, orders, "state", "lost")) == [
        ("RJ", 1, D("0.00"), None), ("SP", 1, D("0.00"), D("1.00")),
    ]
    rates = {r.state: r.repeat_rate_pct for r in dashboard.repeat_rate_by_state(dim).collect()}
    assert rates == {"SP": D("50.00"), "RJ": D("0.00")}
