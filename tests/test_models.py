"""Models over the tiny shop, with results worked out by hand."""

from datetime import date
from decimal import Decimal as D
from hashlib import md5

import pytest
from pyspark.sql import functions as F
from shop import raw_frames

from shopmart.functions import calendar
from shopmart.functions.numeric import percent, ratio
from shopmart.functions.text import clean_city_name
from shopmart.plans import intermediate, marts
from shopmart.plans.staging import stage


@pytest.fixture(scope="module")
def stg(spark):
    return stage(raw_frames(spark))


@pytest.fixture(scope="module")
def enriched(stg):
    return intermediate.orders_enriched(
        stg["orders"],
        stg["customers"],
        stg["order_items"],
        stg["order_payments"],
        stg["order_reviews"],
        intermediate.ADDRESS,
    ).cache()


@pytest.fixture(scope="module")
def orders(enriched):
    return {r.order_id: r for r in enriched.collect()}


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Lages - SC", "lages"),
        ("auriflama/sp", "auriflama"),
        ("Rio de Janeiro, Brasil", "rio de janeiro"),
        ("sao paulo / sao paulo", "sao paulo"),
        ("SÃO PAULO", "sao paulo"),
        (" / ", None),
        (None, None),
    ],
)
def test_city_names(frame, raw, clean):
    df = frame([(raw,)], "c string")
    assert df.select(clean_city_name(F.col("c"))).first()[0] == clean


def test_ratios_round_half_away_from_zero_and_survive_zero(frame):
    df = frame([(5, 2), (-5, 2), (1, 0)], "n int, d int")
    assert [r[0] for r in df.select(ratio(F.col("n"), F.col("d"), 0)).collect()] == [3, -3, None]
    assert [r[0] for r in df.select(percent(F.col("n"), F.col("d"), 1)).collect()][:2] == [250, -250]


def test_staging_types(stg):
    assert dict(stg["orders"].dtypes)["purchased_at"] == "timestamp_ntz"
    assert dict(stg["orders"].dtypes)["estimated_delivery_date"] == "date"
    assert dict(stg["order_items"].dtypes)["price"] == "decimal(12,2)"


def test_staging_blank_text_is_null(stg):
    reviews = {r.review_id + r.order_id: r for r in stg["order_reviews"].collect()}
    assert reviews["r1o1"].comment_title == "great"
    assert reviews["r2o2"].comment_title is None
    assert reviews["r3o2"].comment_message is None


def test_points_are_flagged_not_dropped(stg):
    flags = [(r.zip_code_prefix, r.is_in_brazil) for r in stg["geolocation"].collect()]
    assert len(flags) == 5
    assert ("20000", True) in flags  # exactly on the edge
    assert ("30000", False) in flags  # no latitude


def test_bad_numbers_fail(spark):
    broken = raw_frames(spark, order_payments=[("o1", "x", "boleto", "1", "1.00")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(broken)["order_payments"].collect()


def test_main_payment_is_the_earliest_of_the_largest(orders):
    o1 = orders["o1"]
    assert (o1.payment_amount, o1.payments_count, o1.max_installments) == (D("165.76"), 2, 3)
    assert o1.main_payment_type == "credit_card" and o1.used_voucher


def test_latest_review_prefers_an_unknown_survey_date(orders):
    o2 = orders["o2"]
    assert (o2.review_id, o2.review_score, o2.reviews_count) == ("r3", 2, 2)
    assert o2.has_comment is False


def test_order_without_items_payments_or_review(orders):
    o5 = orders["o5"]
    assert (o5.items_count, o5.items_amount, o5.payment_amount) == (0, 0, 0)
    assert o5.payments_count is None and o5.review_score is None and o5.is_late is None


def test_late_compares_days_and_ignores_the_status(orders):
    assert orders["o1"].is_late is False and orders["o1"].delivery_delay_days == 0
    assert orders["o2"].is_late is True and orders["o2"].delivery_delay_days == 1
    assert orders["o3"].is_late is True and orders["o3"].is_delivered is False
    assert orders["o4"].is_late is None and orders["o4"].is_delivered is True


def test_order_without_customer_vanishes(spark, stg):
    extra = raw_frames(spark)
    lonely = stage({**extra, "customers": extra["customers"].filter("customer_id <> 'c1'")})
    core = intermediate.order_core(lonely["orders"], lonely["customers"])
    assert core.filter("order_id = 'o1'").isEmpty()


def test_customer_history_keeps_the_latest_address(enriched):
    people = {r.customer_unique_id: r for r in intermediate.customer_orders(enriched).collect()}
    p1 = people["p1"]
    assert (p1.orders_count, p1.delivered_orders, p1.state, p1.city) == (2, 2, "RJ", "rio de janeiro")
    assert p1.lifetime_revenue == D("230.50")
    assert people["p2"].delivered_orders == 0 and people["p2"].lifetime_revenue == 0
    assert people["p2"].last_delivered_order_at is None


def test_same_moment_orders_use_the_highest_customer_id(frame):
    rows = [("p", "c1", "A"), ("p", "c2", "B")]
    df = frame(rows, "customer_unique_id string, customer_id string, state string").selectExpr(
        "*",
        "timestamp_ntz'2017-01-01 00:00:00' as purchased_at",
        "true as is_delivered",
        "cast(1 as decimal(12,2)) as items_amount",
        "'z' as zip_code_prefix",
        "'city' as city",
    )
    assert intermediate.customer_orders(df).first().state == "B"


def test_centroids_use_points_inside_only(stg):
    zips = {r.zip_code_prefix: r for r in intermediate.zip_code_locations(stg["geolocation"]).collect()}
    assert set(zips) == {"01001", "20000"}
    assert (zips["01001"].latitude, zips["01001"].longitude) == (-23.6, -46.5)


def test_item_fact_earns_only_when_delivered(stg, enriched):
    fact = {(r.order_id, r.order_item_id): r for r in
            marts.fct_order_items(stg["order_items"], enriched).collect()}
    assert fact["o1", 1].revenue == 100 and fact["o3", 1].revenue == 0
    assert fact["o1", 1].order_item_sk == md5(b"o1-1").hexdigest()
    assert fact["o2", 1].customer_state == "RJ"


def test_products_translate_override_and_unknown(spark, stg):
    products = {
        r.product_id: r
        for r in marts.dim_products(
            stg["products"],
            stg["product_category_name_translation"],
            marts.category_overrides(spark),
        ).collect()
    }
    assert products["x1"].category_name_en == "health_beauty" and products["x1"].volume_cm3 == 6000
    assert (products["x2"].category_name, products["x2"].category_name_en) == ("unknown", "unknown")
    assert products["x3"].category_name_en == "pc_gamer"


def test_untranslated_category_stays_null(spark, stg):
    none = stg["product_category_name_translation"].limit(0)
    products = {r.product_id: r for r in marts.dim_products(
        stg["products"], none, marts.category_overrides(spark)).collect()}
    assert products["x1"].category_name == "beleza" and products["x1"].category_name_en is None


def test_customer_dimension(stg, enriched):
    locations = intermediate.zip_code_locations(stg["geolocation"])
    people = {r.customer_unique_id: r for r in marts.dim_customers(
        intermediate.customer_orders(enriched), locations).collect()}
    assert people["p1"].is_repeat_customer and people["p1"].f_score == 3
    # the last order of any status is on 2017-11-24
    assert people["p1"].recency_days == (date(2017, 11, 24) - date(2017, 3, 10)).days
    assert people["p2"].rfm_segment == "no_delivered_order"
    assert (people["p2"].r_score, people["p2"].f_score, people["p2"].m_score) == (None, None, None)
    assert people["p4"].recency_days is None
    assert people["p3"].latitude is None


@pytest.mark.parametrize(
    ("delivered", "r", "f", "m", "segment"),
    [
        (0, None, None, None, "no_delivered_order"),
        (2, 4, 3, 1, "champions"),
        (3, 1, 5, 5, "loyal"),
        (1, 3, 1, 5, "big_spenders"),
        (1, 4, 1, 4, "recent"),
        (1, 2, 1, 4, "at_risk"),
        (1, 2, 1, 3, "lost"),
        (1, 3, 1, 4, "need_attention"),
    ],
)
def test_segments_first_match_wins(frame, delivered, r, f, m, segment):
    df = frame([(delivered, r, f, m)], "delivered_orders int, r_score int, f_score int, m_score int")
    assert df.select(marts.rfm_segment()).first()[0] == segment


def test_calendar(spark):
    days = {r.date_day: r for r in marts.dim_date(marts.days(spark)).collect()}
    assert len(days) == 1096 and min(days) == date(2016, 1, 1) and max(days) == date(2018, 12, 31)
    black = {d for d, r in days.items() if r.is_black_friday}
    assert black == {date(2016, 11, 25), date(2017, 11, 24), date(2018, 11, 23)}
    sunday = days[date(2017, 4, 16)]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (7, "Sunday", True)
    holidays = {d: r.holiday_name for d, r in days.items() if r.is_br_holiday}
    assert len(holidays) == 36
    assert holidays[date(2017, 6, 15)] == "Corpus Christi"
    assert holidays[date(2018, 2, 13)] == "Carnaval"
    assert days[date(2016, 12, 31)].year_month == "2016-12"


def test_easter_over_two_centuries(spark):
    """Against the tabular rule used for parish calendars."""

    def tabular(y):
        a, b, c = y % 19, y // 100, y % 100
        h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
        q = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
        n = h + q - 7 * ((a + 11 * h + 22 * q) // 451) + 114
        return date(y, n // 31, n % 31 + 1)

    rows = spark.range(1900, 2100).select("id", calendar.easter_sunday(F.col("id").cast("int")).alias("e"))
    assert [(r.id, r.e) for r in rows.collect()] == [(y, tabular(y)) for y in range(1900, 2100)]


def test_two_holidays_on_one_day_keep_one_name(spark):
    day = marts.dim_date(marts.days(spark, date(2000, 4, 21), date(2000, 4, 21))).collect()
    assert [r.holiday_name for r in day] == ["Tiradentes"]
