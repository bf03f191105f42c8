"""Raw marketplace tables derived from a star-schema order database.

The nine raw tables are projections of ``orders``, ``lineitem``, ``customer``,
``supplier``, ``nation``, ``part`` and ``events``; only names of nations and
attributes of customers need a join.  All derivations are per row, so they
neither shuffle nor depend on how the data is split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopmart.sources.files import Folder
from shopmart.tables import TableSet

# The second load sees every order; the first only those before this day.
SECOND_LOAD_FROM = "2001-06-01"

_SHIPPED = "o_orderstatus in ('F', 'P')"
_FINAL_STATUS = f"""case
    when o_orderstatus = 'P' and o_orderkey % 50 = 0 then 'canceled'
    when {_SHIPPED} then 'delivered'
    else 'shipped' end"""


TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


_schemas: dict[str, StructType] = {}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; its footer is asked for the schema only once per process."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def source_tables(spark: SparkSession, folder: str) -> TableSet:
    """The parquet tables of one folder."""

    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: _read(spark, f"{folder.rstrip('/')}/{name}.parquet")

    return TableSet({name: reader(name) for name in TABLES})


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Stored bytes of the tables of one folder."""
    files = Folder(spark, folder)
    return sum(files.size(f"{name}.parquet") for name in TABLES)


def _keys(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def _days(count: str) -> str:
    return f"make_dt_interval(cast({count} as int))"


def raw_orders(t: TableSet, first_load: bool = False) -> DataFrame:
    """One row per order; one in 17 is still being processed in the first load."""
    orders = t["orders"]
    pending = "false"
    if first_load:
        orders = orders.filter(f"o_orderdate < timestamp_ntz'{SECOND_LOAD_FROM} 00:00:00'")
        pending = "o_orderkey % 17 = 0"
    return orders.selectExpr(
        "o_orderkey as order_id",
        "o_orderkey as customer_id",
        f"case when {pending} then 'processing' else {_FINAL_STATUS} end as order_status",
        "o_orderdate as order_purchase_timestamp",
        f"case when o_orderkey % 11 <> 0 then o_orderdate + {_days('1')} end as order_approved_at",
        f"""case when {_SHIPPED} and not {pending}
            then o_orderdate + {_days('(o_orderkey * 13) % 7 - 1')}
            end as order_delivered_carrier_date""",
        f"""case when {_SHIPPED} and o_orderkey % 97 <> 0 and not {pending}
            then o_orderdate + {_days('(o_orderkey * 7919) % 40 + 1')}
            end as order_delivered_customer_date""",
        f"""o_orderdate + {_days('22 + (o_orderkey * 31) % 10')}
            as order_estimated_delivery_date""",
    )


def _dirty_city(key: str) -> str:
    """The nation's name in one of four spellings, all cleaned to the same city."""
    return f"""case {key} % 4
        when 0 then concat(upper(n_name), ' - sp')
        when 1 then concat(lower(n_name), '/sp')
        when 2 then concat(' ', n_name, ', brasil')
        else lower(n_name) end"""


def raw_customers(t: TableSet) -> DataFrame:
    """One customer row per order; about one person in fifty orders again."""
    nations = t["nation"].select("n_nationkey", "n_name")
    customers = t["customer"].join(nations, _keys("c_nationkey", "n_nationkey"))
    return (
        t["orders"]
        .select("o_orderkey", "o_custkey")
        .join(customers, _keys("o_custkey", "c_custkey"))
        .selectExpr(
            "o_orderkey as customer_id",
            "case when o_orderkey % 10 = 0 then o_custkey else -o_orderkey end"
            " as customer_unique_id",
            "lpad(cast(c_custkey % 100 as string), 5, '0') as customer_zip_code_prefix",
            f"{_dirty_city('o_orderkey')} as customer_city",
            "concat(' ', lower(n_name)) as customer_state",
        )
    )


def raw_sellers(t: TableSet) -> DataFrame:
    return (
        t["supplier"]
        .join(t["nation"], _keys("s_nationkey", "n_nationkey"))
        .selectExpr(
            "s_suppkey as seller_id",
            "lpad(cast(s_suppkey % 100 as string), 5, '0') as seller_zip_code_prefix",
            f"{_dirty_city('s_suppkey')} as seller_city",
            "n_name as seller_state",
        )
    )


def raw_products(t: TableSet) -> DataFrame:
    return t["part"].selectExpr(
        "p_partkey as product_id",
        "case when p_size <> 50 then p_type end as product_category_name",
        "length(p_name) as product_name_lenght",
        "length(p_name) + length(p_brand) as product_description_lenght",
        "1 + p_partkey % 5 as product_photos_qty",
        "p_size * 100 as product_weight_g",
        "p_size as product_length_cm",
        "1 + p_partkey % 7 as product_height_cm",
        "1 + p_partkey % 5 as product_width_cm",
    )


def raw_translation(t: TableSet) -> DataFrame:
    """English names of all categories but one, which only the overrides know."""
    return (
        t["part"]
        .filter("p_type <> 'PROMO'")
        .select("p_type")
        .distinct()
        .selectExpr(
            "p_type as product_category_name", "lower(p_type) as product_category_name_english"
        )
    )


OVERRIDES = (("PROMO", "promotion"),)

_PRICE = "cast(l_extendedprice as decimal(12,2))"
_FREIGHT = f"cast({_PRICE} * cast(l_tax as decimal(4,2)) as decimal(12,2))"


def raw_order_items(t: TableSet) -> DataFrame:
    """Line numbers repeat within an order here: the grain check has work to do."""
    return t["lineitem"].selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as order_item_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "l_shipdate as shipping_limit_date",
        f"{_PRICE} as price",
        f"{_FREIGHT} as freight_value",
    )


def raw_order_payments(t: TableSet) -> DataFrame:
    """One payment per line; some orders are underpaid, some pay interest."""
    correction = """case when l_orderkey % 200 = 0 then -2.00
        when l_orderkey % 150 = 7 then 1.50 else 0.00 end"""
    return t["lineitem"].selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as payment_sequential",
        "case l_returnflag when 'A' then 'credit_card' when 'N' then 'boleto'"
        " else 'voucher' end as payment_type",
        "1 + l_linenumber as payment_installments",
        f"cast({_PRICE} + {_FREIGHT} + {correction} as decimal(12,2)) as payment_value",
    )


def raw_order_reviews(t: TableSet) -> DataFrame:
    """One review per event; some orders have two, some review ids cover two orders."""
    return t["events"].selectExpr(
        "event_id - case when event_id % 40 = 5 then 1 else 0 end as review_id",
        "event_id - case when event_id % 20 = 1 then 1 else 0 end as order_id",
        "1 + (event_id * 7) % 5 as review_score",
        "case when event_id % 3 = 0 then concat('  ', event_type, ' ')"
        " when event_id % 3 = 1 then '  ' end as review_comment_title",
        "case when event_type in ('view', 'click') then props when event_type = 'error'"
        " then ' ' end as review_comment_message",
        f"case when event_id % 13 <> 0 then ts - {_days('1')} end as review_creation_date",
        "ts as review_answer_timestamp",
    )


def raw_geolocation(t: TableSet) -> DataFrame:
    """One point per customer, some outside the box."""
    return (
        t["customer"]
        .join(t["nation"], _keys("c_nationkey", "n_nationkey"))
        .selectExpr(
            "lpad(cast(c_custkey % 100 as string), 5, '0') as geolocation_zip_code_prefix",
            "cast(c_acctbal as decimal(12,2)) / 200 - 20 as geolocation_lat",
            "c_custkey % 60 - 84 as geolocation_lng",
            f"{_dirty_city('c_custkey')} as geolocation_city",
            "n_name as geolocation_state",
        )
    )


def raw_tables(t: TableSet, first_load: bool = False) -> TableSet:
    return TableSet(
        {
            "customers": lambda: raw_customers(t),
            "geolocation": lambda: raw_geolocation(t),
            "order_items": lambda: raw_order_items(t),
            "order_payments": lambda: raw_order_payments(t),
            "order_reviews": lambda: raw_order_reviews(t),
            "orders": lambda: raw_orders(t, first_load),
            "product_category_name_translation": lambda: raw_translation(t),
            "products": lambda: raw_products(t),
            "sellers": lambda: raw_sellers(t),
        }
    )


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, as they would arrive from CSV files."""
    return df.selectExpr(*[f"cast(`{c}` as string) as `{c}`" for c in df.columns])
