from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopmart.operators import snapshot, upsert
from shopmart.operators.asof import as_of_join

ORDER = "order_id string, order_status string, approved string, note string"
CHECK = ("order_status", "approved")
T1, T2, T3 = "2018-01-01 00:00:00", "2018-01-02 00:00:00", "2018-01-03 00:00:00"


def times(*texts):
    return [None if t is None else datetime.fromisoformat(t) for t in texts]


def versions(history, key):
    rows = history.filter(F.col("order_id") == key).orderBy(snapshot.VALID_FROM).collect()
    return [(r.order_status, r[snapshot.VALID_FROM], r[snapshot.VALID_TO]) for r in rows]


@pytest.fixture
def history(frame):
    first = frame(
        [("a", "shipped", "x", "n"), ("b", "shipped", None, "n"), ("c", "new", "x", "n"), ("d", "new", "x", "n")],
        ORDER,
    )
    second = frame(
        [("a", "delivered", "x", "n"), ("b", "shipped", "x", "n"), ("c", "new", "x", "changed"), ("e", "new", None, "n")],
        ORDER,
    )
    seen = snapshot.apply_snapshot(None, first, "order_id", CHECK, T1)
    return snapshot.apply_snapshot(seen, second, "order_id", CHECK, T2)


def test_changed_status_gets_a_new_version(history):
    one, two = times(T1, T2)
    assert versions(history, "a") == [("shipped", one, two), ("delivered", two, None)]


def test_null_to_value_is_a_change(history):
    assert len(versions(history, "b")) == 2


def test_unchecked_column_is_not_a_change(history):
    (only,) = history.filter("order_id = 'c'").collect()
    assert only.note == "n" and only[snapshot.VALID_TO] is None


def test_vanished_key_stays_open_and_new_key_opens(history):
    one, two = times(T1, T2)
    assert versions(history, "d") == [("new", one, None)]
    assert versions(history, "e") == [("new", two, None)]


def test_revert_makes_a_third_version_and_repeat_makes_none(frame, history):
    back = frame([("a", "shipped", "x", "n")], ORDER)
    third = snapshot.apply_snapshot(history, back, "order_id", CHECK, T3)
    assert [v[0] for v in versions(third, "a")] == ["shipped", "delivered", "shipped"]
    again = snapshot.apply_snapshot(third, back, "order_id", CHECK, "2018-01-04 00:00:00")
    assert sorted(again.collect(), key=str) == sorted(third.collect(), key=str)


def test_version_ids_are_unique(history):
    assert history.count() == history.select(snapshot.VERSION_ID).distinct().count()


@pytest.mark.parametrize(("moment", "status"), [(T1, "shipped"), ("2018-01-01 23:59:59", "shipped"), (T2, "delivered")])
def test_point_in_time(history, moment, status):
    row = snapshot.as_of_view(history, moment).filter("order_id = 'a'").collect()
    assert [r.order_status for r in row] == [status]


def test_nothing_is_valid_before_the_first_load(history):
    assert snapshot.as_of_view(history, "2017-12-31 00:00:00").isEmpty()


def test_repeated_key_in_a_batch_opens_one_version(frame, history):
    twice = frame([("f", "new", "x", "n"), ("f", "sent", "x", "n"), ("f", "sent", "x", "n")], ORDER)
    (only,) = versions(snapshot.apply_snapshot(history, twice, "order_id", CHECK, T3), "f")
    assert only[0] == "sent"


def test_columns_new_in_a_batch_are_kept_and_gone_ones_are_null(frame, history):
    batch = frame([("a", "back", "x", "why")], "order_id string, order_status string, approved string, reason string")
    third = snapshot.apply_snapshot(history, batch, "order_id", CHECK, T3)
    rows = third.filter("order_id = 'a'").orderBy(snapshot.VALID_FROM).collect()
    assert [(r.note, r.reason) for r in rows] == [("n", None), ("n", None), (None, "why")]


FEED = "order_id string, order_status string, at string"


def feed(frame, rows):
    return frame(rows, FEED).withColumn("at", F.to_timestamp_ntz("at"))


def changed(history, rows):
    return snapshot.apply_changes(history, rows, "order_id", ("order_status",), "at")


def test_changes_of_a_key_in_one_batch_form_a_chain(frame):
    one, two, three = times(T1, T2, T3)
    rows = [("a", "new", T1), ("a", "new", T2), ("a", None, T3), ("b", "new", T2), ("c", "new", None)]
    seen = changed(None, feed(frame, rows))
    assert versions(seen, "a") == [("new", one, three), (None, three, None)]
    assert versions(seen, "b") == [("new", two, None)]
    assert versions(seen, "c") == []


def test_later_changes_close_the_open_version_and_repeats_change_nothing(frame):
    one, two, three = times(T1, T2, T3)
    first = changed(None, feed(frame, [("a", "new", T1), ("b", "new", T1)]))
    more = feed(frame, [("a", "new", T1), ("a", "sent", T2), ("a", "new", T3), ("a", "back", T3), ("b", "new", T3)])
    second = changed(first, more)
    assert versions(second, "a") == [("new", one, two), ("sent", two, three), ("new", three, None)]
    assert versions(second, "b") == [("new", one, None)]
    assert sorted(changed(second, more).collect(), key=str) == sorted(second.collect(), key=str)
    still_open = second.filter(F.col(snapshot.VALID_TO).isNull()).groupBy("order_id").count()
    assert {r["count"] for r in still_open.collect()} == {1}


def test_empty_feed(frame):
    empty = feed(frame, [])
    assert changed(None, empty).isEmpty()
    seen = changed(None, feed(frame, [("a", "new", T1)]))
    assert changed(seen, empty).collect() == seen.collect()


FACT = "k string, at timestamp_ntz, v int"


def fact(frame, rows):
    return frame([(k, datetime.fromisoformat(at), v) for k, at, v in rows], FACT)


def test_look_back_starts_at_the_newest_target_row(frame):
    target = fact(frame, [("a", "2018-03-31", 1), ("b", "2018-01-01", 1)])
    rows = fact(frame, [("in", "2018-03-01", 1), ("edge", "2018-03-01", 1), ("out", "2018-02-28", 1), ("new", "2018-05-01", 1)])
    kept = {r.k for r in upsert.look_back(rows, target, "at", 30).collect()}
    assert kept == {"in", "edge", "new"}


def test_empty_target_is_a_first_load(frame):
    rows = fact(frame, [("a", "2018-01-01", 1)])
    assert upsert.look_back(rows, rows.limit(0), "at").count() == 1
    assert upsert.look_back(rows, None, "at").count() == 1


def test_delete_insert_replaces_keeps_and_never_deletes(frame):
    target = fact(frame, [("old", "2018-01-01", 1), ("gone_at_source", "2018-03-01", 1), ("changed", "2018-03-02", 1)])
    batch = fact(frame, [("changed", "2018-03-02", 2), ("new", "2018-03-03", 1)])
    merged = {(r.k, r.v) for r in upsert.delete_insert(target, batch, "k").collect()}
    assert merged == {("old", 1), ("gone_at_source", 1), ("changed", 2), ("new", 1)}


def test_new_columns_are_null_for_old_rows(frame):
    target = fact(frame, [("old", "2018-01-01", 1)])
    batch = fact(frame, [("new", "2018-03-03", 1)]).withColumn("extra", F.lit("x"))
    merged = {r.k: r.extra for r in upsert.delete_insert(target, batch, "k").collect()}
    assert merged == {"old": None, "new": "x"}


def test_touched_partitions_include_where_the_key_was(frame):
    target = frame([("a", "m1"), ("b", "m2")], "k string, m string")
    batch = frame([("a", "m3")], "k string, m string")
    touched = {r.m for r in upsert.touched_partitions(target, batch, "k", "m").collect()}
    assert touched == {"m1", "m3"}


def brute_as_of(events, versions):
    rows = []
    for key, at in events:
        valid = [
            (start, state)
            for k, state, start, end in versions
            if None not in (key, at) and k == key and start <= at and (end is None or end > at)
        ]
        start, state = max(valid, default=(None, None))
        rows.append((key, at, state, start))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("span", ["hour", "month", "year"])
def test_each_event_takes_the_version_valid_at_its_time(spark, span):
    """A hot key, gaps, versions that start together or at an event, nulls, events before all versions."""
    import random

    rng = random.Random(3)
    moment = lambda h: f"2018-{1 + h // 672:02d}-{1 + h // 24 % 28:02d} {h % 24:02d}:00:00"
    versions, events = [], [(None, moment(5)), ("hot", None), ("unknown", moment(7)), (None, None)]
    for key, steps in (("hot", 300), ("a", 5), ("b", 1), ("gap", 4)):
        starts = sorted(rng.sample(range(4000), steps))
        for i, start in enumerate(starts):
            end = starts[i + 1] - (1 if key == "gap" else 0) if i + 1 < steps else None
            versions.append((key, f"{key}{i}", moment(start), None if end is None else moment(end)))
            events.append((key, moment(start)))
        events += [(key, moment(rng.randrange(4032))) for _ in range(60)] + [(key, moment(100))] * 2
    # one that ended as it started never counts
    versions.append(("b", "void", versions[305][2], versions[305][2]))
    history = spark.createDataFrame(versions, "k string, state string, f string, t string").selectExpr(
        "k", "state", "to_timestamp_ntz(f) as dbt_valid_from", "to_timestamp_ntz(t) as dbt_valid_to"
    )
    asked = spark.createDataFrame(events, "k string, at string").selectExpr("k", "to_timestamp_ntz(at) as at")
    found = as_of_join(asked, history, "k", "at", ["state"], span)
    told = found.selectExpr("k", "cast(at as string)", "state", "cast(dbt_valid_from as string)").collect()
    assert sorted((tuple(r) for r in told), key=repr) == brute_as_of(events, versions)


def test_as_of_join_of_empty_tables(frame):
    history = frame([], "k string, state string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    events = frame([("a", "2018-01-01")], "k string, at string").selectExpr("k", "to_timestamp_ntz(at) as at")
    (row,) = as_of_join(events, history, "k", "at", ["state"]).collect()
    assert (row.k, row.state) == ("a", None)
    assert as_of_join(events.limit(0), history, "k", "at", ["state"]).count() == 0
