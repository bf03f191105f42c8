from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from shop import raw_frames

from shopmart.operators import checks as dq
from shopmart.plans import intermediate, marts, quality
from shopmart.plans.staging import stage


@pytest.fixture
def people(frame):
    return frame([(1, "a", 5), (2, None, 0), (2, "b", -1), (None, "z", None)], "id int, code string, n int")


def failing(check):
    return check.failing().count()


def test_not_null_and_accepted_values(people):
    assert failing(dq.not_null("t", people, "id")) == 1
    assert failing(dq.accepted_values("t", people, "code", ("a", "b"))) == 1  # NULL passes


def test_unique_ignores_nulls(people):
    (row,) = dq.unique("t", people, "id").failing().collect()
    assert (row.id, row.n_records) == (2, 2)


def test_range_with_and_without_the_bound(people):
    assert failing(dq.accepted_range("t", people, "n", 0)) == 1
    assert failing(dq.accepted_range("t", people, "n", 0, inclusive=False)) == 2


def test_expression_lets_null_pass(people):
    assert failing(dq.expression_is_true("t", people, "n >= 0")) == 1
    assert failing(dq.expression_is_true("t", people, "n >= 0", "n is not null")) == 1


def test_relationships_let_null_pass(frame, people):
    parent = frame([(1,)], "pid int")
    assert failing(dq.relationships("t", people, "id", parent, "pid")) == 2


def test_unique_combination(frame):
    df = frame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    (row,) = dq.unique_combination("t", df, ("a", "b")).failing().collect()
    assert (row.a, row.b, row.n_records) == (1, 1, 2)


def test_summary_severities_and_thresholds(frame, people):
    checks = [
        dq.not_null("t", people, "id"),
        dq.not_null("t", people, "code").as_warning(),
        dq.Check("tolerated", people, people.n.isNotNull(), error_above=100),
        dq.unique("t", frame([(1,)], "x int"), "x"),
    ]
    status = {r.check: (r.failures, r.status) for r in dq.summary(checks).collect()}
    assert status == {
        "not_null:t.id": (1, "error"),
        "not_null:t.code": (1, "warn"),
        "tolerated": (3, "warn"),
        "unique:t.x": (0, "pass"),
    }


def test_row_checks_share_one_scan(people):
    checks = [dq.not_null("t", people, c) for c in ("id", "code", "n")]
    plan = dq.summary(checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_enforce_raises_only_on_errors(people):
    warning = dq.not_null("t", people, "id").as_warning()
    assert dq.enforce([warning]) == [("not_null:t.id", 1, "warn")]
    with pytest.raises(dq.QualityError, match="not_null:t.code"):
        dq.enforce([warning, dq.not_null("t", people, "code")])


@pytest.fixture(scope="module")
def shop(spark):
    raw = raw_frames(spark)
    stg = stage(raw)
    enriched = intermediate.orders_enriched(
        stg["orders"], stg["customers"], stg["order_items"], stg["order_payments"],
        stg["order_reviews"],
    )
    return raw, stg, marts.fct_orders(enriched), marts.fct_order_items(stg["order_items"], enriched)


def test_business_rules(shop):
    _, stg, orders, items = shop
    assert failing(quality.every_item_reaches_the_fact(stg["order_items"], items)) == 0
    lost = quality.every_item_reaches_the_fact(stg["order_items"], items.filter("order_id <> 'o1'"))
    assert failing(lost) == 2
    (underpaid,) = quality.payments_cover_the_order(orders).failing().collect()
    assert underpaid.order_id == "o3" and float(underpaid.amount_due - underpaid.payment_amount) == 2
    assert failing(quality.revenue_only_from_delivered(items)) == 0
    assert failing(quality.revenue_only_from_delivered(items.withColumn("revenue", items.price))) == 1
    assert failing(quality.revenue_reconciles(items, orders)) == 0
    assert failing(quality.revenue_reconciles(items.filter("order_id <> 'o1'"), orders)) == 1


def test_source_profile(shop):
    raw, stg, *_ = shop
    found = {r.metric: r.value for r in quality.source_profile(raw, stg).collect()}
    assert found == {
        "zip_with_leading_zero": 3,
        "review_ids_shared_by_orders": 1,
        "handed_to_carrier_before_purchase": 1,
        "points_outside_the_box": 2,
        "seller_city_spellings": 2,
        "seller_cities": 2,
        "products_without_category": 1,
    }


def test_payment_match_profile(shop):
    row = quality.payment_match_profile(shop[2]).first()
    assert (row.orders, row.exact, row.overpaid, row.underpaid, row.overpaid_by_instalments) == (5, 2, 2, 1, 2)


def test_the_suite_has_every_check():
    not_null = sum(len(c) for tables in quality.FILLED.values() for c in tables.values())
    unique = sum(len(tables) for tables in quality.KEYS.values())
    references = sum(len(r) for r in quality.REFERENCES.values())
    grains = sum(len(g) for g in quality.GRAINS.values())
    assert (not_null, unique, references, grains) == (53, 19, 14, 4)


def test_a_suite_scans_each_table_once(spark, frame, tmp_path):
    """Thirty checks over three tables: three scans, one shuffle by key, no join."""
    for name, rows in (("parents", [(1,), (2,)]), ("children", [(1, 1), (9, 2)]), ("others", [(1, 3), (3, 4)])):
        schema = "pid int" if name == "parents" else "fk int, n int"
        frame(rows, schema).write.parquet(str(tmp_path / name))
    parents, children, others = (spark.read.parquet(str(tmp_path / n)) for n in ("parents", "children", "others"))
    checks = [dq.unique("parents", parents, "pid"), dq.not_null("parents", parents, "pid")]
    for name, table in (("children", children), ("others", others)):
        checks += [
            dq.relationships(name, table, "fk", parents, "pid"),
            dq.unique(name, table, "n"),
            dq.unique_combination(name, table, ("fk", "n")),
            *[dq.accepted_range(name, table, "n", k) for k in range(10)],
        ]
    summary = dq.summary(checks)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3 and "Join" not in plan
    failures = {r["check"]: r["failures"] for r in summary.collect()}
    assert failures["relationships:children.fk"] == failures["relationships:others.fk"] == 1


def test_summary_counts_what_the_checks_find(frame):
    """Every kind of check, with nulls, repeated and missing keys, other key types and empty tables."""
    parent = frame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, None)], "pid long, code string")
    child = frame([(1, 1), (2, 1), (7, 1), (7, 1), (None, None), (None, None), (None, 5)], "fk int, n int")
    nothing = frame([], "fk int, n int")
    pairs = dq.Keys(child, ("fk", "n"))
    lost = child.select("fk", "n").subtract(nothing)
    checks = [
        dq.unique("p", parent, "pid"),
        dq.unique("p", parent, "code"),
        dq.relationships("c", child, "fk", parent, "pid"),
        dq.relationships("c", child, "n", parent, "pid"),
        dq.relationships("e", nothing, "fk", parent, "pid"),
        dq.relationships("x", child, "fk", nothing, "fk"),
        dq.unique("c", child, "fk"),
        dq.unique_combination("c", child, ("fk", "n")),
        dq.unique_combination("e", nothing, ("fk", "n")),
        dq.not_null("c", child, "fk"),
        dq.accepted_range("c", child, "n", 2),
        dq.Check("lost", lost, child=pairs, parent=dq.Keys(nothing, ("fk", "n")), distinct=True),
        dq.Check("kept", child.limit(0), child=pairs, parent=pairs, distinct=True),
        dq.Check("alone", parent.filter("pid > 1")),
    ]
    told = {r["check"]: r["failures"] for r in dq.summary(checks).collect()}
    assert told == {c.name: c.failing().count() for c in checks}
    assert told["lost"] == 5 and told["relationships:c.fk"] == 2 and told["unique_combination:c:fk+n"] == 2


def test_suites_find_what_single_checks_find(shop):
    _, stg, orders, items = shop
    tables = {"fct_order_items": items, "fct_orders": orders}
    checks = [
        quality.every_item_reaches_the_fact(stg["order_items"], items.filter("order_id <> 'o1'")),
        quality.payments_cover_the_order(orders),
        quality.revenue_only_from_delivered(items.withColumn("revenue", items.price)),
        quality.revenue_reconciles(items.filter("order_id <> 'o1'"), orders),
        *[dq.not_null(t, df, c) for t, df in tables.items() for c in df.columns],
    ]
    told = {r["check"]: r["failures"] for r in dq.summary(checks).collect()}
    assert told == {c.name: c.failing().count() for c in checks}


def test_facts_are_reconciled_in_the_same_pass(spark, frame, tmp_path):
    """Two sums in the one shuffle by key; keys of whole numbers and of hexadecimal digits are not sent as text."""
    schema = "order_id long, order_item_id int, sk string, revenue decimal(12,2)"
    md5 = ("00ff" * 8, "00fe" * 8)
    rows = [(1, 1, md5[0], 5), (1, 1, md5[0].upper(), 1), (2, 1, md5[1], None), (2, None, md5[1], 2), (None, None, "00f", 0)]
    frame([(*r[:3], None if r[3] is None else Decimal(r[3])) for r in rows], schema).write.parquet(str(tmp_path / "items"))
    frame([(1, Decimal("7.99")), (2, None)], "order_id long, revenue decimal(22,2)").write.parquet(str(tmp_path / "orders"))
    items, orders = (spark.read.parquet(str(tmp_path / n)) for n in ("items", "orders"))
    none = orders.withColumn("revenue", F.lit(None).cast("decimal(22,2)"))
    checks = [
        dq.unique("items", items, "sk"),
        dq.unique_combination("items", items, ("order_id", "order_item_id")),
        dq.relationships("items", items, "order_id", orders, "order_id"),
    ]
    differ = quality.revenue_reconciles(items, orders)
    summary = dq.summary([*checks, differ])
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Join" not in plan and "to_json" not in plan
    told = {r["check"]: r["failures"] for r in summary.collect()}
    assert told == {c.name: c.failing().count() for c in [*checks, differ]}
    assert told["unique:items.sk"] == told[differ.name] == 1
    for other in (none, items):  # nothing to compare; the same sum
        (row,) = dq.summary([quality.revenue_reconciles(items, other)]).collect()
        assert row["failures"] == 0
