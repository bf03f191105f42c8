"""Versions, parts, conflicting writers and clean-up of published tables."""

import pytest
from pyspark.sql import functions as F

from shopmart.operators import published
from shopmart.operators.published import extend_history, extend_history_by_changes, merge_parts
from shopmart.sources.publish import NO_PART, ConflictError, Publisher

CHECK = ("state",)


@pytest.fixture
def publisher(spark, tmp_path):
    return Publisher(spark, str(tmp_path / "layer"))


def rows_of(publisher, table):
    return sorted(tuple(r) for r in publisher.read(table).collect())


def test_the_second_writer_of_a_version_fails_and_changes_nothing(spark, frame, tmp_path):
    one, two = (Publisher(spark, str(tmp_path / "layer")) for _ in range(2))
    first, second = one.next_version(), two.next_version()
    assert first == second == 1
    a = one.write(frame([(1,)], "x int"), "a", first)
    b = two.write(frame([(2,)], "x int"), "b", second)
    one.commit(first, {"a": a})
    with pytest.raises(ConflictError, match="version 1"):
        two.commit(second, {"b": b})
    assert rows_of(two, "a") == [(1,)] and not one.exists("b")
    names = [p.name for p in (tmp_path / "layer" / "_versions").iterdir() if not p.name.startswith(".")]
    assert names == ["000000000001.json"]


def test_parts_of_any_name(frame, publisher):
    values = ["a:b", "c/d", "e=f", "100%", "g h", "é", "[x]", "", None]
    df = frame([(i, v) for i, v in enumerate(values)], "x int, part string")
    version = publisher.next_version()
    publisher.commit(version, {"t": publisher.write_parts(df, "t", version, F.col("part"))})
    assert publisher.read("t").count() == len(values)
    for i, value in enumerate(values[:-2]):
        assert [r.x for r in publisher.read("t", [value]).collect()] == [i]
    assert {r.x for r in publisher.read("t", [NO_PART]).collect()} >= {len(values) - 1}


def test_a_published_folder_may_be_moved(spark, frame, tmp_path):
    publisher = Publisher(spark, str(tmp_path / "here"))
    publisher.commit(1, {"t": publisher.write(frame([(1,)], "x int"), "t", 1)})
    (tmp_path / "here").rename(tmp_path / "there")
    assert Publisher(spark, str(tmp_path / "there")).read("t").count() == 1


def test_expiry_deletes_what_only_old_versions_use(frame, publisher, tmp_path):
    whole = frame([(1, "p"), (2, "q")], "x int, part string")
    publisher.commit(1, {"t": publisher.write_parts(whole, "t", 1, F.col("part")), "u": publisher.write(whole, "u", 1)})
    for version, value in ((2, 3), (3, 4)):
        changed = publisher.write_parts(frame([(value, "q")], "x int, part string"), "t", version, F.col("part"))
        publisher.commit(version, {"t": publisher.parts("t") | changed})
    pending = publisher.write(whole, "u", 4)
    publisher.expire(keep=1)
    assert publisher.versions() == [3]
    assert rows_of(publisher, "t") == [(1, "p"), (4, "q")] and publisher.read("u").count() == 2
    found = {str(p.relative_to(tmp_path / "layer")) for p in (tmp_path / "layer").glob("*/*")}
    assert {f for f in found if f[0] != "_"} == {"t/v1", "t/v3", "u/v1", "u/v4"}
    assert not (tmp_path / "layer" / "t" / "v1" / "__part=q").exists()
    publisher.commit(4, {"u": pending})
    with pytest.raises(ValueError):
        publisher.expire(keep=0)


ITEMS = "k string, month string, v int"


def merged(publisher, batch):
    version = publisher.next_version()
    tables = merge_parts(publisher, "t", batch, "k", F.col("month"), version)
    publisher.commit(version, tables)
    return {part for part, path in tables["t"].items() if f"/v{version}/" in f"{path}/"}


def test_upsert_rewrites_the_parts_of_its_keys_alone(frame, publisher):
    start = [(f"k{i}", f"2018-{1 + i % 4:02d}", i) for i in range(40)]
    merged(publisher, frame(start, ITEMS))
    want = {k: (k, m, v) for k, m, v in start}
    # k0 stays in January, k1 moves from February to April, a new key opens May
    batch = [("k0", "2018-01", 100), ("k1", "2018-04", 101), ("new", "2018-05", 102)]
    assert merged(publisher, frame(batch, ITEMS)) == {"2018-01", "2018-02", "2018-04", "2018-05"}
    want |= {k: (k, m, v) for k, m, v in batch}
    assert rows_of(publisher, "t") == sorted(want.values())
    assert merged(publisher, frame([("new", "2018-05", 1)], ITEMS)) == {"2018-05"}
    assert merged(publisher, frame([], ITEMS)) == set()
    want["new"] = ("new", "2018-05", 1)
    assert rows_of(publisher, "t") == sorted(want.values())


def test_upsert_finds_its_parts_without_reading_the_table(frame, publisher, monkeypatch):
    merged(publisher, frame([(f"k{i}", f"m{i % 20}", i) for i in range(200)], ITEMS))
    asked = []
    read_at = Publisher.read_at
    monkeypatch.setattr(
        Publisher,
        "read_at",
        lambda self, location, parts=None: asked.append((location, parts)) or read_at(self, location, parts),
    )
    tables = merge_parts(publisher, "t", frame([("k3", "m3", 0)], ITEMS), "k", F.col("month"), 2)
    (known, mine), (_, months) = asked
    assert all("/t_keys/" in path for path in known.values())
    assert len({name.partition("@")[0] for name in mine}) == 1 and len(known) > 20
    assert months == ["m3"]
    assert sum(1 for path in tables["t"].values() if "/v2/" in path) == 1


def test_the_index_is_written_anew_when_it_has_many_folders(frame, publisher):
    rounds = 2 * published.MOST_FOLDERS
    for i in range(rounds):
        merged(publisher, frame([("same", f"m{i}", i), (f"k{i}", "m", i)], ITEMS))
    names = publisher.parts("t_keys")
    bucket = [n for n in names if n.partition("@")[0] == frame([("same",)], "k string").select(published._bucket(F.col("k"))).first()[0]]
    assert len(bucket) <= published.MOST_FOLDERS
    held = publisher.read("t_keys").filter("__key = 'same'")
    assert held.count() == rounds
    assert rows_of(publisher, "t") == sorted([(f"k{i}", "m", i) for i in range(rounds)] + [("same", f"m{rounds - 1}", rounds - 1)])


def test_upsert_into_a_table_published_without_an_index(frame, publisher):
    old = frame([("a", "m1", 1), ("b", "m2", 2), (None, None, 3)], ITEMS)
    publisher.commit(1, {"t": publisher.write_parts(old, "t", 1, F.col("month"))})
    assert merged(publisher, frame([("b", "m1", 5)], ITEMS)) == {"m1"}
    assert {(r.k, r.v) for r in publisher.read("t").collect()} == {("a", 1), ("b", 5), (None, 3)}


def test_an_empty_first_load_has_its_columns(frame, publisher):
    merged(publisher, frame([], ITEMS))
    assert publisher.read("t").columns == ["k", "month", "v"]
    merged(publisher, frame([("a", "m1", 1)], ITEMS))
    assert rows_of(publisher, "t") == [("a", "m1", 1)]


def open_folders(publisher):
    return {p: path for p, path in publisher.parts("h").items() if p.startswith("open-")}


@pytest.mark.parametrize("at_own_times", [False, True])
def test_history_rewrites_the_buckets_that_change(frame, publisher, at_own_times):
    keys = [f"k{i}" for i in range(300)]

    def load(rows, moment):
        version = publisher.next_version()
        if at_own_times:
            df = frame([(*r, moment) for r in rows], "k string, state string, at string")
            df = df.withColumn("at", F.to_timestamp_ntz("at"))
            tables = extend_history_by_changes(publisher, "h", df, "k", CHECK, "at", version)
        else:
            tables = extend_history(publisher, "h", frame(rows, "k string, state string"), "k", CHECK, moment, version)
        publisher.commit(version, tables)

    load([(k, "new") for k in keys], "2018-01-01 00:00:00")
    before = open_folders(publisher)
    assert len(before) > published.BUCKETS // 2
    changed = [(keys[7], "sent"), ("another", None)]
    # a snapshot sees all rows, a feed only the changed ones
    load(changed if at_own_times else changed + [(k, "new") for k in keys if k != keys[7]], "2018-01-02 00:00:00")
    after = open_folders(publisher)
    rewritten = {p for p in after if after[p] != before.get(p)}
    assert 1 <= len(rewritten) <= 2
    history = publisher.read("h")
    assert history.count() == 302 and history.filter("dbt_valid_to is null").count() == 301
    assert history.filter(f"k = '{keys[7]}' and dbt_valid_to is not null").first().state == "new"
    # nothing new: nothing is written
    load([(keys[7], "sent")], "2018-01-02 00:00:00")
    assert publisher.read("h").count() == 302


def test_derived_columns_are_not_moved(frame, publisher):
    rows = frame([(1, "a", "x1"), (2, "b", "x2")], "id int, at string, h string")
    moved = rows.withColumn("h", F.md5(F.col("id").cast("string"))).select("h", "id", "at")
    folders = publisher.write_parts(moved, "t", 1, F.col("at"), derived={"h": F.md5(F.col("id").cast("string"))})
    back = publisher.read_at(folders)
    assert back.columns == ["h", "id", "at"] and sorted(back.collect()) == sorted(moved.collect())
    assert set(folders) == {"a", "b"}


def test_an_index_is_shuffled_once(frame, publisher):
    rows = frame([(f"k{i % 50}", "a") for i in range(200)], "k string, at string")
    pairs = published._pairs(rows, "k", F.col("at"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert pairs.count() == 50 and set(pairs.columns) == {"__key", "__at", "__bucket"}
    found = published.write_indexed(publisher, "t", rows, "k", F.col("at"), 1)
    assert sorted(r[0] for r in publisher.read_at(found["t_keys"]).select("__key").collect()) == sorted({f"k{i}" for i in range(50)})
