"""Every query by name, over the stand-in tables of one folder.

The tables span 1995-2001, so the date ranges, states and labels of the
reports are passed accordingly.  Each function returns a lazy DataFrame;
results keep their natural types until :func:`comparable`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from shopmart.functions.text import clean_city_name
from shopmart.operators import checks as dq
from shopmart.operators import digest, sampling, snapshot, upsert
from shopmart.operators.asof import as_of_join
from shopmart.plans import analyses, daily, dashboard, intermediate, marts, quality, staging
from shopmart.session import fit_partitions, materialize, scratch_folder
from shopmart.sources import landing, standin
from shopmart.sources.contracts import RAW_COLUMNS, SourceFiles
from shopmart.sources.export import export_csv, read_exported
from shopmart.sources.publish import Publisher
from shopmart.sources.seeds import read_seeds
from shopmart.streaming import changes

STATES = ("NATION_1", "NATION_2", "NATION_3")
MONTHLY_FROM, MONTHLY_TO = date(1996, 1, 1), date(1997, 8, 31)
REPORT_FROM = date(1997, 1, 1)
COHORTS = (date(1996, 1, 1), date(1996, 12, 1))
NOVEMBER = (date(1996, 11, 1), date(1996, 11, 30))
DRILL_STATE, DRILL_MONTH = "NATION_7", date(1997, 3, 1)
FIRST_LOAD_AT, SECOND_LOAD_AT = "2001-06-01 00:00:00", "2001-08-02 00:00:00"
BETWEEN_LOADS = "2001-07-01 00:00:00"
FEED_AGAIN_FROM, FEED_UNTIL = "1996-12-01 00:00:00", "1997-01-01 00:00:00"


class Models:
    """The models over one set of source tables; each is built only when asked for."""

    def __init__(self, spark: SparkSession, folder: str, first_load: bool = False) -> None:
        self.spark = spark
        self.folder = folder
        fit_partitions(spark, standin.input_bytes(spark, folder))
        self.source = standin.source_tables(spark, folder)
        self.raw = standin.raw_tables(self.source, first_load)
        self.stg = staging.stage(self.raw)

    def enriched(self, *, items=False, payments=False, reviews=False, address=()) -> DataFrame:
        """Orders with just the inputs a query needs."""
        s = self.stg
        return intermediate.orders_enriched(
            s["orders"],
            s["customers"],
            s["order_items"] if items else None,
            s["order_payments"] if payments else None,
            s["order_reviews"] if reviews else None,
            address,
        )

    def fct_orders(self, **inputs) -> DataFrame:
        return marts.fct_orders(self.enriched(**inputs))

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return marts.fct_order_items(self.stg["order_items"], self.enriched())

    @cached_property
    def history(self) -> DataFrame:
        orders = self.enriched(items=True, address=intermediate.ADDRESS)
        return intermediate.customer_orders(orders)

    @cached_property
    def locations(self) -> DataFrame:
        """Written, so that joins know its true size and broadcast it only if small."""
        return materialize(
            intermediate.zip_code_locations(self.stg["geolocation"]), "zip_code_locations"
        )

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.history, self.locations)

    @cached_property
    def rfm(self) -> DataFrame:
        """The customer dimension without coordinates."""
        return marts.dim_customers(self.history)

    @cached_property
    def scored_rfm(self) -> DataFrame:
        """The customer dimension without coordinates, with review scores."""
        orders = self.enriched(items=True, reviews=True, address=intermediate.ADDRESS)
        return marts.dim_customers(intermediate.customer_orders(orders, scores=True))

    @cached_property
    def items_with_measures(self) -> DataFrame:
        """The item fact with review score and lateness of the order."""
        return marts.fct_order_items(
            self.stg["order_items"], self.enriched(reviews=True), analyses.ORDER_MEASURES
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(
            self.stg["products"],
            self.stg["product_category_name_translation"],
            marts.category_overrides(self.spark, standin.OVERRIDES),
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every day from the first purchase to the last promised delivery."""
        bounds = self.stg["orders"].agg(
            F.to_date(F.min("purchased_at")).alias("first_day"),
            F.max("estimated_delivery_date").alias("last_day"),
        )
        return marts.dim_date(marts.days_covering(bounds))


Query = Callable[[Models], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


# --- sources, sinks, sampling -------------------------------------------------


@query
def load_audit(m: Models) -> DataFrame:
    """Rows and hash of every stored file of the source tables.

    A table is a file or a folder of part files, in partition folders at any depth;
    rows are counted per part, by its whole path, which the scan gives encoded. A listed part without rows has
    0; a part with rows that is not listed is an error.
    """
    listed = [
        landing.list_files(m.spark, f"{m.folder}/{name}.parquet").withColumn("table_name", F.lit(name))
        for name in m.source
    ]
    hashed = landing.file_hashes(reduce(DataFrame.unionByName, listed))
    counted = [
        df.groupBy(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("table_name", F.lit(name))
        for name, df in m.source.items()
    ]
    counts = reduce(DataFrame.unionByName, counted)
    missing = F.raise_error(F.concat(F.lit("not among the listed files: "), "path")).cast("string")
    return hashed.join(counts, ["table_name", "path"], "full").select(
        F.coalesce("file_name", missing).alias("file_name"),
        "table_name",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "sha256",
    )


def _told(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count, digest`` of the comparable content of each table."""
    told = [
        digest.content_digest(comparable(df)).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, told)


@query
def landing_round_trip(m: Models) -> DataFrame:
    """All raw tables written as CSV files, landed, audited and typed again.

    ``audited_rows`` is what the audit of the load says, ``row_count`` and
    ``digest`` are taken from the staged tables read back.
    """
    folder = scratch_folder(m.spark, "landing")
    export_csv({t: standin.as_text(m.raw[t]) for t in RAW_COLUMNS}, f"{folder}/files")
    publisher = Publisher(m.spark, f"{folder}/raw")
    raw = landing.load_raw(m.spark, f"{folder}/files", publisher, SourceFiles("{table}"))
    audited = publisher.read("load_audit").groupBy("table_name").agg(F.sum("row_count").alias("audited_rows"))
    return _told(staging.stage(raw)).join(audited, "table_name", "left")


@query
def export_round_trip(m: Models) -> DataFrame:
    """All marts written as CSV files and read back with their types.

    ``exported_rows`` are counted while writing, ``row_count`` and ``digest`` are
    taken from the files. The orders, which three marts are made of, are joined once.
    """
    orders = m.enriched(items=True, payments=True, reviews=True, address=intermediate.ADDRESS)
    orders = materialize(orders, "orders_enriched")
    history = intermediate.customer_orders(orders)
    built = {
        "fct_order_items": marts.fct_order_items(m.stg["order_items"], orders),
        "fct_orders": marts.fct_orders(orders),
        "dim_customers": _rounded_coordinates(marts.dim_customers(history, m.locations)),
        "dim_products": m.dim_products,
        "dim_sellers": _rounded_coordinates(marts.dim_sellers(m.stg["sellers"], m.locations)),
        "dim_date": m.dim_date,
    }
    folder = scratch_folder(m.spark, "export")
    exported = export_csv(built, folder, compression="gzip")
    back = {name: read_exported(m.spark, folder, name, df.schema) for name, df in built.items()}
    counted = F.create_map(*[F.lit(x) for name, rows in exported.items() for x in (name, rows)])
    return _told(back).withColumn("exported_rows", counted[F.col("table_name")])


@query
def table_row_counts(m: Models) -> DataFrame:
    return landing.row_counts(m.raw)


@query
def consistent_sample_orders(m: Models) -> DataFrame:
    return sampling.sample_orders(m.raw["orders"]).select("order_id", "order_status")


@query
def consistent_sample_items(m: Models) -> DataFrame:
    items = sampling.consistent_sample(m.raw)["order_items"]
    return items.select("order_id", "order_item_id", "product_id", "seller_id", "price")


@query
def consistent_sample_counts(m: Models) -> DataFrame:
    return landing.row_counts(sampling.consistent_sample(m.raw))


@query
def sample_topk_per_key(m: Models) -> DataFrame:
    points = sampling.first_points(m.raw["geolocation"])
    return points.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )


# --- staging ------------------------------------------------------------------


def _staged_text(m: Models, table: str) -> DataFrame:
    return staging.STAGING[table](standin.as_text(m.raw[table]))


@query
def stg_orders_typed(m: Models) -> DataFrame:
    return _staged_text(m, "orders")


@query
def stg_items_typed(m: Models) -> DataFrame:
    return _staged_text(m, "order_items")


@query
def stg_payments_typed(m: Models) -> DataFrame:
    return _staged_text(m, "order_payments")


@query
def stg_reviews_typed(m: Models) -> DataFrame:
    return _staged_text(m, "order_reviews")


@query
def stg_customers_clean(m: Models) -> DataFrame:
    return _staged_text(m, "customers")


@query
def stg_sellers_clean(m: Models) -> DataFrame:
    return _staged_text(m, "sellers")


@query
def stg_products_typed(m: Models) -> DataFrame:
    return _staged_text(m, "products")


@query
def stg_category_translation(m: Models) -> DataFrame:
    return _staged_text(m, "product_category_name_translation")


@query
def stg_points_flagged(m: Models) -> DataFrame:
    return _staged_text(m, "geolocation")


@query
def stg_clean_names(m: Models) -> DataFrame:
    return m.source["documents"].select(
        "doc_id", clean_city_name(F.col("text")).alias("clean_name")
    )


# --- intermediate and marts ---------------------------------------------------


@query
def items_per_order(m: Models) -> DataFrame:
    return intermediate.items_per_order(m.stg["order_items"])


@query
def payments_per_order(m: Models) -> DataFrame:
    return intermediate.payments_per_order(m.stg["order_payments"])


@query
def latest_review_per_order(m: Models) -> DataFrame:
    return intermediate.reviews_per_order(m.stg["order_reviews"])


@query
def orders_enriched(m: Models) -> DataFrame:
    return m.enriched(items=True, payments=True, reviews=True)


@query
def customer_order_history(m: Models) -> DataFrame:
    return m.history


@query
def zip_centroids(m: Models) -> DataFrame:
    return _rounded_coordinates(intermediate.zip_code_locations(m.stg["geolocation"]))


def _rounded_coordinates(df: DataFrame) -> DataFrame:
    """Coordinates to six decimals, the precision of the report."""
    rounded = {
        c: F.round(F.col(c).cast("decimal(18,12)"), 6) for c in ("latitude", "longitude")
    }
    return df.withColumns(rounded)


@query
def fct_order_items(m: Models) -> DataFrame:
    return m.fct_order_items


@query
def fct_orders(m: Models) -> DataFrame:
    return m.fct_orders(items=True, payments=True, reviews=True)


@query
def dim_customers_rfm(m: Models) -> DataFrame:
    return _rounded_coordinates(m.dim_customers)


@query
def dim_products(m: Models) -> DataFrame:
    return m.dim_products


@query
def dim_sellers(m: Models) -> DataFrame:
    return _rounded_coordinates(marts.dim_sellers(m.stg["sellers"], m.locations))


@query
def dim_date(m: Models) -> DataFrame:
    return m.dim_date


# --- analyses -----------------------------------------------------------------


@query
def kpi_summary(m: Models) -> DataFrame:
    return analyses.kpi_summary(m.fct_orders(items=True, reviews=True))


@query
def revenue_by_state(m: Models) -> DataFrame:
    return analyses.revenue_by_state(m.fct_orders(items=True, reviews=True))


@query
def revenue_by_state_monthly(m: Models) -> DataFrame:
    return analyses.revenue_by_state_monthly(
        m.fct_order_items, MONTHLY_FROM, MONTHLY_TO, STATES, REPORT_FROM
    )


@query
def late_delivery_vs_reviews(m: Models) -> DataFrame:
    return analyses.late_delivery_vs_reviews(m.fct_orders(reviews=True))


@query
def monthly_cohorts(m: Models) -> DataFrame:
    return analyses.monthly_cohorts(m.fct_orders(), *COHORTS)


@query
def category_pareto(m: Models) -> DataFrame:
    return analyses.category_pareto(m.items_with_measures, m.dim_products)


@query
def seller_concentration(m: Models) -> DataFrame:
    return analyses.seller_concentration(m.fct_order_items)


@query
def rfm_segments(m: Models) -> DataFrame:
    return analyses.rfm_segments(m.rfm)


@query
def black_friday(m: Models) -> DataFrame:
    return analyses.black_friday(
        m.fct_order_items, m.dim_date, *NOVEMBER, label="Black Friday (1996-11-22)"
    )


# --- dashboard measures -------------------------------------------------------


@query
def kpi_by_year(m: Models) -> DataFrame:
    return dashboard.kpi_by_year(m.fct_orders(items=True, reviews=True))


@query
def monthly_revenue(m: Models) -> DataFrame:
    return dashboard.monthly_revenue(m.fct_order_items)


@query
def revenue_drill_category(m: Models) -> DataFrame:
    return dashboard.revenue_drill_category(
        m.fct_order_items, m.dim_products, DRILL_STATE, DRILL_MONTH
    )


@query
def drill_quality(m: Models) -> DataFrame:
    return dashboard.drill_quality(
        m.fct_order_items, m.dim_products, m.fct_orders(reviews=True), DRILL_STATE, DRILL_MONTH
    )


@query
def revenue_drill_top_sellers(m: Models) -> DataFrame:
    return dashboard.revenue_drill_top_sellers(m.fct_order_items, DRILL_STATE, DRILL_MONTH)


@query
def revenue_drill_category_sellers(m: Models) -> DataFrame:
    return dashboard.revenue_drill_top_sellers(
        m.fct_order_items, DRILL_STATE, DRILL_MONTH, m.dim_products, "promotion"
    )


@query
def retention_matrix(m: Models) -> DataFrame:
    return dashboard.retention_matrix(m.fct_orders(), *COHORTS)


@query
def repeat_rate_by_state(m: Models) -> DataFrame:
    return dashboard.repeat_rate_by_state(marts.customer_flags(m.history))


@query
def review_by_delay_bucket(m: Models) -> DataFrame:
    return dashboard.review_by_delay_bucket(m.fct_orders(reviews=True))


@query
def order_level_measures_no_fanout(m: Models) -> DataFrame:
    return dashboard.order_level_measures(m.items_with_measures, m.dim_products)


@query
def customer_kpis_by_segment(m: Models) -> DataFrame:
    return dashboard.customer_kpis(m.scored_rfm)


@query
def champions_by_state(m: Models) -> DataFrame:
    return dashboard.customer_kpis(m.scored_rfm, by="state", segment="champions")


@query
def seller_complaints(m: Models) -> DataFrame:
    return dashboard.seller_complaints(m.items_with_measures)


# --- incremental load and history ---------------------------------------------


def _first_load(m: Models) -> Models:
    return Models(m.spark, m.folder, first_load=True)


def _batch(m: Models, target: DataFrame) -> DataFrame:
    recent = upsert.look_back(m.enriched(), target, "purchased_at")
    return marts.fct_order_items(m.stg["order_items"], recent)


@query
def incremental_batch(m: Models) -> DataFrame:
    return _batch(m, _first_load(m).fct_order_items)


@query
def incremental_upsert(m: Models) -> DataFrame:
    target = _first_load(m).fct_order_items
    return upsert.delete_insert(target, _batch(m, target), "order_item_sk")


@query
def incremental_upsert_published(m: Models) -> DataFrame:
    """The item fact as published by months, after the look-back batch of the second load."""
    publisher = Publisher(m.spark, scratch_folder(m.spark, "upsert"))
    first = _first_load(m)
    for models in (first, m):
        orders, items = models.enriched(), models.stg["order_items"]
        version = publisher.next_version()
        publisher.commit(version, daily.load_items(publisher, items, orders, version))
    return publisher.read(daily.ITEMS)


@query
def incremental_upsert_new_column(m: Models) -> DataFrame:
    target = _first_load(m).fct_order_items
    batch = _batch(m, target).withColumn("is_large", F.col("price") >= 50000)
    merged = upsert.delete_insert(target, batch, "order_item_sk")
    return merged.select("order_item_sk", "order_status", "revenue", "is_large")


@query
def full_refresh(m: Models) -> DataFrame:
    fact = upsert.delete_insert(None, _batch(m, None), "order_item_sk")
    return fact.groupBy("order_status").agg(
        F.count("*").alias("items"), F.sum("revenue").alias("revenue_brl")
    )


def _order_history(m: Models) -> DataFrame:
    first = standin.as_text(standin.raw_orders(m.source, first_load=True))
    second = standin.as_text(m.raw["orders"])
    seen = None
    for batch, moment in ((first, FIRST_LOAD_AT), (second, SECOND_LOAD_AT)):
        seen = snapshot.apply_snapshot(
            seen, batch, "order_id", snapshot.ORDER_STATUS_CHECKS, moment
        )
    return seen


@query
def scd2_snapshot(m: Models) -> DataFrame:
    return _order_history(m)


@query
def scd2_as_of(m: Models) -> DataFrame:
    valid = snapshot.as_of_view(_order_history(m), BETWEEN_LOADS)
    return valid.select("order_id", "order_status", snapshot.VALID_FROM)


STEPS = {
    "created": "purchased_at",
    "approved": "approved_at",
    "shipped": "delivered_to_carrier_at",
    "delivered": "delivered_to_customer_at",
}


def _status_feed(m: Models) -> DataFrame:
    """Status changes at their own times."""
    events = F.array(
        *[
            F.struct(F.lit(status).alias("order_status"), F.col(c).alias("changed_at"))
            for status, c in STEPS.items()
        ]
    )
    return m.stg["orders"].select("order_id", F.inline(events))


@query
def scd2_as_of_events(m: Models) -> DataFrame:
    """Each item with the status its order had when the item was due to be shipped."""
    history = snapshot.apply_changes(None, _status_feed(m), "order_id", ("order_status",), "changed_at")
    due = m.stg["order_items"].select("order_id", "order_item_id", "shipping_limit_at")
    return as_of_join(due, history, "order_id", "shipping_limit_at", ["order_status"])


@query
def consistent_sample_third(m: Models) -> DataFrame:
    """A third of the orders, by the lowest hash."""
    orders = m.raw["orders"]
    sampled = sampling.sample_orders(orders, orders.count() // 3)
    return sampled.select("order_id", "order_status")


def _own_seeds(m: Models) -> dict[str, DataFrame]:
    """Seed files written from the tables and read under their contract: the first order day of each
    year is a holiday, and each category goes by its name reversed.
    """
    folder = scratch_folder(m.spark, "seeds")
    day = F.to_date("purchased_at")
    holidays = m.stg["orders"].groupBy(F.year("purchased_at").alias("y")).agg(F.min(day).alias("holiday_date"))
    names = m.stg["products"].select("category_name").filter("category_name is not null").distinct()
    files = {
        "national_holidays": holidays.select(F.concat(F.lit('First "order", '), "y").alias("holiday_name"), "holiday_date"),
        "category_overrides": names.select("category_name", F.reverse("category_name").alias("category_name_en")),
    }
    export_csv(files, folder)
    return read_seeds(m.spark, {name: f"{folder}/{name}" for name in files})


@query
def dim_date_own_holidays(m: Models) -> DataFrame:
    dates = marts.dim_date(m.dim_date.select("date_day"), _own_seeds(m)["national_holidays"])
    return dates.select("date_day", "holiday_name", "is_br_holiday")


@query
def dim_products_own_names(m: Models) -> DataFrame:
    """Products named by the user's overrides alone."""
    products, overrides = m.stg["products"], _own_seeds(m)["category_overrides"]
    translations = m.stg["product_category_name_translation"].limit(0)
    named = marts.dim_products(products, translations, overrides)
    return named.select("product_id", "category_name", "category_name_en")


@query
def scd2_change_feed(m: Models) -> DataFrame:
    """Status changes at their own times, in two batches of which a month arrives twice."""
    feed = _status_feed(m)
    seen = None
    for batch in (f"changed_at < '{FEED_UNTIL}'", f"changed_at >= '{FEED_AGAIN_FROM}'"):
        seen = snapshot.apply_changes(
            seen, feed.filter(batch), "order_id", ("order_status",), "changed_at"
        )
    return seen.select("order_id", "order_status", snapshot.VALID_FROM, snapshot.VALID_TO)


def _streamed(m: Models, sink_of: Callable[[Publisher], changes.Sink], table: str) -> DataFrame:
    """A table after the status feed has arrived as files in three parts, each processed by a
    stream when it arrives and then delivered to the sink once more.
    """
    folder = scratch_folder(m.spark, "stream")
    publisher = Publisher(m.spark, f"{folder}/published")
    sink = sink_of(publisher)
    feed = _status_feed(m).filter("changed_at is not null")
    arrivals = (
        f"changed_at < '{FEED_AGAIN_FROM}'",
        f"changed_at >= '{FEED_AGAIN_FROM}' and changed_at < '{FEED_UNTIL}'",
        f"changed_at >= '{FEED_UNTIL}'",
    )
    for batch_id, arrival in enumerate(arrivals):
        feed.filter(arrival).write.mode("append").parquet(f"{folder}/feed")
        files = m.spark.readStream.schema(feed.schema).parquet(f"{folder}/feed")
        changes.run_available(files, sink, f"{folder}/progress")
        sink(feed.filter(arrival), batch_id)
    return publisher.read(table)


@query
def stream_upsert_replayed(m: Models) -> DataFrame:
    """The newest status of each order, kept by a stream."""
    steps = F.array_position(F.array(*map(F.lit, STEPS)), F.col("order_status"))
    month = F.date_format("changed_at", "yyyy-MM")
    return _streamed(
        m,
        lambda p: changes.upsert_sink(p, "newest", "order_id", [F.col("changed_at"), steps], month),
        "newest",
    )


@query
def stream_history_replayed(m: Models) -> DataFrame:
    """The status history of each order, kept by a stream."""
    kept = _streamed(
        m,
        lambda p: changes.history_sink(p, "history", "order_id", ("order_status",), "changed_at"),
        "history",
    )
    return kept.select("order_id", "order_status", snapshot.VALID_FROM, snapshot.VALID_TO)


# --- data quality -------------------------------------------------------------


@query
def dq_not_null(m: Models) -> DataFrame:
    return dq.not_null("orders", m.stg["orders"], "approved_at").failing().select("order_id")


@query
def dq_unique(m: Models) -> DataFrame:
    return dq.unique("order_reviews", m.stg["order_reviews"], "review_id").failing()


@query
def dq_relationships(m: Models) -> DataFrame:
    check = dq.relationships(
        "orders", m.stg["orders"], "order_id", m.stg["order_reviews"], "order_id"
    )
    return check.failing().select("order_id")


@query
def dq_accepted_values(m: Models) -> DataFrame:
    check = dq.accepted_values(
        "orders", m.stg["orders"], "order_status", ("delivered", "shipped")
    )
    return check.failing().select("order_id", "order_status")


@query
def dq_accepted_range(m: Models) -> DataFrame:
    check = dq.accepted_range(
        "order_items", m.stg["order_items"], "freight_value", 0, inclusive=False
    )
    return check.failing().select("order_id", "order_item_id", "freight_value")


@query
def dq_expression(m: Models) -> DataFrame:
    check = dq.expression_is_true(
        "orders",
        m.stg["orders"],
        "delivered_to_carrier_at >= purchased_at",
        "delivered_to_carrier_at is not null",
    )
    return check.failing().select("order_id", "purchased_at", "delivered_to_carrier_at")


@query
def dq_unique_combination(m: Models) -> DataFrame:
    return dq.unique_combination(
        "order_items", m.stg["order_items"], ("order_id", "order_item_id")
    ).failing()


@query
def dq_completeness(m: Models) -> DataFrame:
    """All items against a fact that has only seen the first load."""
    fact = _first_load(m).fct_order_items
    return quality.every_item_reaches_the_fact(m.stg["order_items"], fact).failing()


@query
def dq_underpaid(m: Models) -> DataFrame:
    return quality.payments_cover_the_order(m.fct_orders(items=True, payments=True)).failing()


@query
def dq_revenue_delivered(m: Models) -> DataFrame:
    """Against a fact whose revenue rule was left out."""
    wrong = m.fct_order_items.withColumn("revenue", F.col("price"))
    return quality.revenue_only_from_delivered(wrong).failing()


@query
def dq_revenue_reconciles(m: Models) -> DataFrame:
    """Items of all loads against orders of the first one."""
    orders = _first_load(m).fct_orders(items=True)
    return quality.revenue_reconciles(m.fct_order_items, orders).failing()


@query
def dq_summary(m: Models) -> DataFrame:
    stg = m.stg
    orders = m.fct_orders(items=True, payments=True)
    items = m.fct_order_items
    return dq.summary(
        [
            dq.not_null("orders", stg["orders"], "purchased_at"),
            dq.not_null("orders", stg["orders"], "approved_at").as_warning(),
            dq.accepted_values("orders", stg["orders"], "order_status", quality.ORDER_STATUSES),
            dq.accepted_range("order_items", stg["order_items"], "price", 0, inclusive=False),
            dq.unique("orders", stg["orders"], "order_id"),
            dq.unique_combination(
                "order_items", stg["order_items"], ("order_id", "order_item_id")
            ),
            dq.relationships("order_items", stg["order_items"], "order_id", stg["orders"], "order_id"),
            quality.payments_cover_the_order(orders),
            quality.revenue_only_from_delivered(items),
            quality.revenue_reconciles(items, orders),
        ]
    )


def _seeds(m: Models) -> dict[str, DataFrame]:
    holidays = m.dim_date.filter("is_br_holiday")
    return {
        "national_holidays": holidays.select(F.col("date_day").alias("holiday_date"), "holiday_name"),
        "category_overrides": marts.category_overrides(m.spark, standin.OVERRIDES),
    }


@query
def dq_suite_staging(m: Models) -> DataFrame:
    """Every check of the sources and seeds."""
    return dq.summary(quality.staging_checks({**m.stg, **_seeds(m)}))


@query
def dq_suite_intermediate(m: Models) -> DataFrame:
    """Every check of the intermediate models."""
    return dq.summary(quality.intermediate_checks(daily.build_intermediate(m.stg)))


@query
def dq_suite_marts(m: Models) -> DataFrame:
    """Every check of the marts, business rules included."""
    models = daily.build_intermediate(m.stg)
    orders, locations = models["orders_enriched"], models["zip_code_locations"]
    built = {
        "fct_order_items": marts.fct_order_items(m.stg["order_items"], orders),
        "fct_orders": marts.fct_orders(orders),
        "dim_customers": marts.dim_customers(models["customer_orders"], locations),
        "dim_products": m.dim_products,
        "dim_sellers": marts.dim_sellers(m.stg["sellers"], locations),
        "dim_date": m.dim_date,
    }
    return dq.summary(quality.mart_checks(built, m.stg["order_items"]))


@query
def source_profile(m: Models) -> DataFrame:
    return quality.source_profile(m.raw, m.stg)


@query
def payment_match_profile(m: Models) -> DataFrame:
    return quality.payment_match_profile(m.fct_orders(items=True, payments=True))


# --- access -------------------------------------------------------------------

_MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(df: DataFrame) -> DataFrame:
    """Engine-neutral types: money and ratios DOUBLE, integers BIGINT, dates ISO text."""
    columns = []
    for field in df.schema.fields:
        name = expression = f"`{field.name}`"
        if isinstance(field.dataType, (DecimalType, FloatType)):
            expression = f"cast({name} as double)"
        elif isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            expression = f"cast({name} as bigint)"
        elif isinstance(field.dataType, DateType):
            expression = f"cast({name} as string)"
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            expression = f"date_format({name}, '{_MOMENT}')"
        columns.append(f"{expression} as {name}")
    return df.selectExpr(*columns)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_QUERIES[name](Models(spark, folder)))


def names() -> list[str]:
    return list(_QUERIES)
