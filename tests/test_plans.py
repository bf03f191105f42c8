"""What the physical plans must and must not contain, with broadcasts switched off."""

import re
from pathlib import Path

import pytest

from shopmart import session
from shopmart.plans import registry

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables not present")

# Queries that run no job while they are being defined.
LAZY = (
    "kpi_summary",
    "revenue_by_state",
    "revenue_by_state_monthly",
    "late_delivery_vs_reviews",
    "monthly_cohorts",
    "retention_matrix",
    "orders_enriched",
    "customer_order_history",
    "fct_order_items",
    "seller_complaints",
    "order_level_measures_no_fanout",
    "incremental_upsert",
    "scd2_snapshot",
    "sample_topk_per_key",
)


@pytest.fixture(scope="module")
def plan(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: registry.run(name, spark, str(TABLES))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text
    assert "EvalPython" not in text and "MapInPandas" not in text


def columns_read(text, marker):
    scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if marker in s]
    return [{c.split("#")[0] for c in s.split(",")} for s in scans]


def test_scans_read_only_what_the_report_needs(plan):
    text = plan("kpi_summary")
    assert columns_read(text, "l_orderkey") == [{"l_orderkey", "l_extendedprice"}]
    assert columns_read(text, "c_custkey") == [{"c_custkey", "c_nationkey"}]


def test_first_load_filter_reaches_the_scan(plan):
    text = plan("scd2_snapshot")
    assert "LessThan(o_orderdate,2001-06-01" in text


def test_per_order_inputs_are_joined_without_another_shuffle(plan):
    """Items, payments and reviews arrive partitioned by order and stay so."""
    text = plan("orders_enriched")
    joins = text.split("SortMergeJoin [order_id")
    assert len(joins) == 4
    # Between two of the left joins there is no exchange of the joined rows.
    for between in joins[1:3]:
        assert "Exchange" not in between.split("SortMergeJoin")[0]


def test_windows_have_partition_keys_or_small_input(plan):
    """Only report-sized windows run in one task: each sits above an aggregate."""
    for name in ("revenue_by_state", "late_delivery_vs_reviews"):
        text = plan(name)
        below = text.partition("Exchange SinglePartition")[2].splitlines()[1:]
        source = next(line for line in below if "Project" not in line)
        assert "HashAggregate" in source


def test_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(1000).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    stored = sum(f.stat().st_size for f in (tmp_path / "orders.parquet").glob("part-*.parquet"))
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 100)
    before = {key: spark.conf.get(key) for key in session.PARTITION_CONF}
    try:
        for key in before:
            spark.conf.unset(key)
        registry.Models(spark, str(tmp_path))
        assert int(spark.conf.get(initial)) >= stored // 100 > 4
        assert {key: spark.conf.get(key) for key in before} == session.PARTITION_CONF
        spark.conf.set(initial, "100000")
        registry.Models(spark, str(tmp_path))
        assert spark.conf.get(initial) == "100000"
    finally:
        spark.conf.unset(initial)
        for key, value in before.items():
            spark.conf.set(key, value)
