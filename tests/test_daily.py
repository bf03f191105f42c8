"""The whole run over generated files: reload, history, incremental months, blocking checks."""

import pytest
from pyspark.sql import functions as F
from shop import RAW, write_landing

from shopmart.operators.checks import QualityError
from shopmart.plans import daily
from shopmart.sources.contracts import HeaderError
from shopmart.sources.seeds import read_seeds
from shopmart.streaming import changes

DAY1, DAY2 = "2018-01-01 06:00:00", "2018-01-02 06:00:00"


def replaced(rows, key, **fields):
    names = ("order_id", "customer_id", "order_status", "purchased", "approved", "carrier",
             "delivered", "promised")
    return [
        tuple(fields.get(n, v) for n, v in zip(names, r)) if r[0] == key else r for r in rows
    ]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    return daily.Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))


@pytest.fixture(scope="module")
def first_run(warehouse, tmp_path_factory):
    landing = write_landing(tmp_path_factory.mktemp("in1"))
    export = tmp_path_factory.mktemp("export")
    published = daily.run_daily(warehouse, str(landing), DAY1, export_to=str(export))
    months = warehouse.layer("marts").parts("fct_order_items")
    return published, months, export


def test_first_run_publishes_all_marts(first_run):
    published, months, export = first_run
    counts = {name: df.count() for name, df in published.items()}
    assert counts == {
        "fct_order_items": 6,
        "fct_orders": 6,
        "dim_customers": 5,
        "dim_products": 4,
        "dim_sellers": 2,
        "dim_date": 1096,
    }
    assert set(months) == {"2017-01", "2017-02", "2017-03", "2017-11"}
    assert {p.name for p in export.iterdir()} == set(daily.MARTS)


@pytest.fixture(scope="module")
def second_run(warehouse, first_run, tmp_path_factory):
    """o5 arrives and gets an item; o1, long ago, is corrected too late to be seen."""
    orders = replaced(RAW["orders"], "o5", order_status="delivered", delivered="2017-12-01 00:00:00")
    orders = replaced(orders, "o1", order_status="canceled")
    items = [*RAW["order_items"], ("o5", "1", "x1", "s1", "2017-11-28 00:00:00", "70.00", "7.00")]
    landing = write_landing(tmp_path_factory.mktemp("in2"), orders=orders, order_items=items)
    with pytest.raises(QualityError, match="revenue"):
        daily.run_daily(warehouse, str(landing), DAY2)
    return landing


def test_blocking_check_leaves_the_published_marts(warehouse, second_run):
    """The stale revenue of o1 no longer reconciles, so nothing is published."""
    assert warehouse.mart("fct_order_items").count() == 6


def test_history_saw_both_states(warehouse, second_run):
    history = warehouse.layer("snapshots").read(daily.HISTORY)
    # the versions a run closes are set aside, those still open are in buckets
    parts = set(warehouse.layer("snapshots").parts(daily.HISTORY))
    assert {p for p in parts if not p.startswith("open-")} == {"closed-2"}
    statuses = history.filter("order_id = 'o5'").orderBy("dbt_valid_from")
    assert [r.order_status for r in statuses.collect()] == ["shipped", "delivered"]


def test_full_refresh_repairs_old_months(warehouse, second_run):
    published = daily.run_daily(warehouse, str(second_run), DAY2, full_refresh=True)
    assert published["fct_order_items"].count() == 7
    earned = published["fct_order_items"].filter("order_id = 'o1'").agg(F.sum("revenue")).first()[0]
    assert earned == 0
    # the same batch again opens no new version
    assert warehouse.layer("snapshots").read(daily.HISTORY).count() == 8


def test_incremental_run_rewrites_only_touched_months(warehouse, second_run, tmp_path):
    before = warehouse.layer("marts").parts("fct_order_items")
    orders = replaced(RAW["orders"], "o5", order_status="delivered", delivered="2017-12-01 00:00:00")
    orders = replaced(orders, "o1", order_status="canceled")
    orders = replaced(orders, "o6", order_status="canceled")
    items = [*RAW["order_items"], ("o5", "1", "x1", "s1", "2017-11-28 00:00:00", "70.00", "7.00")]
    landing = write_landing(tmp_path / "in3", orders=orders, order_items=items)
    published = daily.run_daily(warehouse, str(landing), "2018-01-03 06:00:00")
    after = warehouse.layer("marts").parts("fct_order_items")
    assert {m for m in after if after[m] != before.get(m)} == {"2017-11"}
    rows = {r.order_id: r for r in published["fct_order_items"].collect()}
    assert rows["o6"].revenue == 0 and rows["o5"].revenue == 70
    assert published["fct_order_items"].count() == 7


def test_views_and_reports_of_the_published_marts(spark, warehouse, first_run):
    warehouse.register_views()
    joined = spark.sql(
        "select count(*) from fct_order_items i join dim_sellers s on i.seller_id = s.seller_id"
    )
    assert joined.first()[0] == warehouse.mart("fct_order_items").count()
    assert spark.sql("select state from stg_customers where customer_id = 'c1'").first()[0] == "SP"
    assert spark.sql("select customer_state from raw_customers").count() == len(RAW["customers"])
    assert spark.sql("select * from int_orders_enriched where order_id = 'o1'").first().items_count == 2
    assert spark.sql("select * from int_customer_orders").count() == 5
    assert spark.sql("select count(*) from seed_category_overrides").first()[0] > 0
    open_versions = spark.sql("select order_id from order_status_history where dbt_valid_to is null")
    assert open_versions.count() == len(RAW["orders"])
    reports = daily.write_findings(warehouse)
    assert len(reports) == 9 and reports["kpi_summary"].count() == 1


def test_seed_files_of_the_user(spark, tmp_path):
    (tmp_path / "own holidays.csv").write_text("holiday_name,holiday_date\n\"Shop, day\",2017-06-01\n")
    (tmp_path / "names.csv").write_text("category_name,category_name_en\npc_gamer,gaming\n")
    given = {"national_holidays": f"{tmp_path}/own holidays.csv", "category_overrides": f"{tmp_path}/names.csv"}
    warehouse = daily.Warehouse(spark, str(tmp_path / "w"), seed_files=given)
    published = daily.run_daily(warehouse, str(write_landing(tmp_path / "in")), DAY1)
    holidays = published["dim_date"].filter("is_br_holiday").collect()
    assert [(str(r.date_day), r.holiday_name) for r in holidays] == [("2017-06-01", "Shop, day")]
    named = {r.product_id: r.category_name_en for r in published["dim_products"].collect()}
    assert named["x3"] == "gaming"


def test_seed_files_are_held_to_their_columns_and_types(spark, tmp_path):
    (tmp_path / "h.csv").write_text("holiday_date,name\n2017-06-01,x\n")
    (tmp_path / "o.csv").write_text("category_name\nx\n")
    with pytest.raises(HeaderError) as caught:
        read_seeds(spark, {"national_holidays": f"{tmp_path}/h.csv", "category_overrides": f"{tmp_path}/o.csv"})
    assert "lacks the column holiday_name" in str(caught.value) and "lacks the column category_name_en" in str(caught.value)
    (tmp_path / "h.csv").write_text("holiday_date,holiday_name\n1st of June,x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_seeds(spark, {"national_holidays": f"{tmp_path}/h.csv"})["national_holidays"].collect()
    with pytest.raises(ValueError, match="no such seed: days"):
        read_seeds(spark, {"days": "x"})


SCHEMA = "order_id string, order_status string, changed_at timestamp_ntz"


def micro_batch(spark, folder, rows):
    df = spark.createDataFrame(rows, "order_id string, order_status string, at string")
    df.select("order_id", "order_status", F.to_timestamp_ntz("at").alias("changed_at")).coalesce(
        1
    ).write.mode("append").parquet(str(folder))


def test_streaming_upsert_and_history(spark, warehouse, tmp_path):
    layer = daily.Warehouse(spark, str(tmp_path / "w")).layer("live")
    source = tmp_path / "stream"
    month = F.date_format("changed_at", "yyyy-MM")
    upsert = changes.upsert_sink(layer, "orders", "order_id", [F.col("changed_at")], month)
    history = changes.history_sink(layer, "log", "order_id", ("order_status",), "changed_at")

    def run():
        for name, sink in (("u", upsert), ("h", history)):
            stream = spark.readStream.schema(SCHEMA).parquet(str(source))
            changes.run_available(stream, sink, str(tmp_path / f"offsets-{name}"))

    micro_batch(spark, source, [("a", "new", "2018-01-01 00:00:00"), ("b", "new", "2018-01-01 00:00:00")])
    run()
    micro_batch(spark, source, [("a", "sent", "2018-01-02 00:00:00")])
    run()
    run()  # nothing new: nothing changes
    assert {(r.order_id, r.order_status) for r in layer.read("orders").collect()} == {("a", "sent"), ("b", "new")}
    log = layer.read("log")
    assert log.count() == 3 and log.filter("dbt_valid_to is null").count() == 2
    # the same micro-batch once more, as after a failure before the stream noted its end
    again = spark.read.schema(SCHEMA).parquet(str(source)).filter("order_status = 'sent'")
    before = sorted(str(p) for p in (tmp_path / "w").rglob("*"))
    upsert(again, 1)
    history(again, 1)
    assert sorted(str(p) for p in (tmp_path / "w").rglob("*")) == before
    assert layer.last_batch("upsert orders") == layer.last_batch("history log") == 1
    # a batch of its own is written, and an empty one is noted
    upsert(again.withColumn("order_status", F.lit("back")), 2)
    upsert(again.limit(0), 3)
    assert {(r.order_id, r.order_status) for r in layer.read("orders").collect()} == {("a", "back"), ("b", "new")}
    assert layer.last_batch("upsert orders") == 3 and layer.last_batch("history log") == 1


def test_a_run_leaves_no_scratch_and_keeps_the_versions_asked_for(spark, tmp_path, monkeypatch):
    from shopmart import session

    shared = tmp_path / "shared"
    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: str(shared))
    warehouse = daily.Warehouse(spark, str(tmp_path / "w"), retain=2)
    for day in (1, 2, 3):
        landing = write_landing(tmp_path / f"in{day}")
        daily.run_daily(warehouse, str(landing), f"2018-01-0{day} 06:00:00")
        assert not list((shared / "shopmart").iterdir())
    marts = warehouse.layer("marts")
    assert marts.versions() == [2, 3]
    assert {p.name for p in (tmp_path / "w" / "marts" / "dim_date").iterdir()} == {"v2", "v3"}
    assert warehouse.mart("fct_order_items").count() == 6 and warehouse.mart("dim_date").count() == 1096
    # the audit of every load stays
    assert warehouse.layer("raw").read("load_audit").count() == 3 * len(RAW)
    assert warehouse.layer("snapshots").read(daily.HISTORY).count() == len(RAW["orders"])
