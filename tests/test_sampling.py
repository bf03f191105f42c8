import hashlib

import pytest
from pyspark.sql import functions as F
from shop import RAW, raw_frames

from shopmart.operators import sampling


@pytest.fixture(scope="module")
def sample(spark):
    return sampling.consistent_sample(raw_frames(spark), count=3)


def values(df, column):
    return {r[0] for r in df.select(column).collect()}


def test_orders_with_the_lowest_hash(sample):
    ids = sorted((r[0] for r in RAW["orders"]), key=lambda i: hashlib.md5(i.encode()).hexdigest())
    assert values(sample["orders"], "order_id") == set(ids[:3])


def test_children_belong_to_sampled_orders(sample):
    orders = values(sample["orders"], "order_id")
    for table in ("order_items", "order_payments", "order_reviews"):
        assert values(sample[table], "order_id") <= orders


def test_parents_are_complete(sample):
    assert values(sample["orders"], "customer_id") == values(sample["customers"], "customer_id")
    assert values(sample["order_items"], "product_id") == values(sample["products"], "product_id")
    assert values(sample["order_items"], "seller_id") == values(sample["sellers"], "seller_id")


def test_every_table_keeps_its_columns(spark, sample):
    raw = raw_frames(spark)
    assert set(sample) == set(raw)
    for table, df in sample.items():
        assert df.columns == raw[table].columns
    assert sample["product_category_name_translation"].count() == 2


def test_few_points_per_prefix(frame):
    points = [("z", str(i), "0", "c", "s") for i in range(10)] + [("y", "1", "0", "c", "s")]
    columns = [f"geolocation_{c}" for c in ("zip_code_prefix", "lat", "lng", "city", "state")]
    kept = sampling.first_points(frame(points, ", ".join(f"{c} string" for c in columns)))
    counts = {r[0]: r[1] for r in kept.groupBy(columns[0]).count().collect()}
    assert counts == {"z": 3, "y": 1}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 as k", "id")
    plan = sampling.first_per_key(df, "k", [F.col("id").asc()], 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:]


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("count", [0, 1, 17, 999, 1500, 3000, 5000])
def test_a_sample_of_any_size(spark, monkeypatch, count, digits):
    """Equal hashes (repeated ids) included; more than there are is all of them."""
    monkeypatch.setattr(sampling, "HASH_DIGITS", digits)
    orders = spark.range(3000).selectExpr("id % 2900 as order_id", "id as other")
    got = sampling.sample_orders(orders, count).select("order_id").collect()
    ids = sorted((i % 2900 for i in range(3000)), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert sorted(r[0] for r in got) == sorted(ids[:count])


def test_a_large_sample_is_not_sorted_in_one_task(spark):
    orders = spark.range(1000).selectExpr("id as order_id")
    text = sampling.sample_orders(orders, 300)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "GlobalLimit" not in text
    for below in text.split("Exchange SinglePartition")[1:]:
        source = next(line for line in below.splitlines()[1:] if "Project" not in line and "Sort" not in line)
        assert "HashAggregate" in source
