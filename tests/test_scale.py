"""The distributed ranks against Spark's own windows, and their plans."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopmart.operators import scale


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; ids make the order total."""
    return spark.range(3000).selectExpr(
        "id",
        "case when id % 3 = 0 then 7 else cast(pmod(hash(id), 97) as int) end as value",
        "id % 5 = 0 as flag",
        "cast(id % 40 as string) as grp",
    )


def order():
    return [F.col("value").desc(), F.col("id").asc()]


TILE_ORDER = (("value", False), ("id", True))


@pytest.mark.parametrize("tiles", [3, 5, 10])
def test_ntile_matches_the_window(skewed, tiles):
    mine = scale.global_ntile(skewed, tiles, TILE_ORDER, "tile")
    theirs = skewed.withColumn("tile", F.ntile(tiles).over(Window.orderBy(*order())))
    assert sorted(mine.collect()) == sorted(theirs.collect())


@pytest.mark.parametrize("rows", [0, 1, 2, 4, 5, 6, 11])
def test_ntile_of_few_rows(spark, rows):
    df = spark.range(rows)
    mine = scale.global_ntile(df, 5, (("id", True),), "tile")
    theirs = df.withColumn("tile", F.ntile(5).over(Window.orderBy("id")))
    assert sorted(mine.collect()) == sorted(theirs.collect())


def test_tile_ends_for_many_sizes(spark):
    """The last row of every bucket, as Spark's own ntile places it."""
    sizes = spark.range(1, 60).select(F.explode(F.sequence(F.lit(1), "id")).alias("pos"), "id")
    for tiles in (3, 5, 10):
        tile = F.ntile(tiles).over(Window.partitionBy("id").orderBy("pos"))
        last = sizes.withColumn("tile", tile).groupBy("id", "tile").agg(F.max("pos").alias("last"))
        expected: dict[int, set[int]] = {}
        for r in last.collect():
            expected.setdefault(r.id, set()).add(r["last"] - 1)
        for rows, ends in expected.items():
            assert set(scale._tile_ends(rows, tiles)) == ends - {rows - 1}


def test_running_sum_and_row_number(skewed):
    mine = scale.global_position(skewed, order(), running={"so_far": "value"})
    window = Window.orderBy(*order())
    theirs = skewed.select(
        "*",
        F.row_number().over(window).cast("bigint").alias("row_number"),
        F.count("*").over(Window.partitionBy()).alias("group_rows"),
        F.sum("value").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
    )
    assert sorted(mine.collect()) == sorted(theirs.collect())


def test_running_sum_within_groups(skewed):
    mine = scale.global_position(skewed, order(), ["grp"], {"so_far": "value"})
    window = Window.partitionBy("grp").orderBy(*order())
    so_far = F.sum("value").over(window.rowsBetween(Window.unboundedPreceding, 0))
    theirs = skewed.select("id", so_far.alias("so_far"))
    assert sorted(mine.select("id", "so_far").collect()) == sorted(theirs.collect())


def test_null_groups_stay_together(frame):
    df = frame([(None, 1), (None, 2), ("a", 3)], "g string, id int")
    placed = scale.global_position(df, [F.col("id").asc()], ["g"]).collect()
    assert sorted((r.id, r.row_number, r.group_rows) for r in placed) == [(1, 1, 2), (2, 2, 2), (3, 1, 1)]


def test_hot_value_is_split_over_partitions(spark, skewed):
    """Rows that share the leading sort value may not end up in one task."""
    rows = scale._sorted_rows(skewed.filter("value = 7"), order(), "hot")
    sizes = [r["count"] for r in rows.groupBy("__partition").count().collect()]
    total = sum(sizes)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if len(sizes) == 1:  # adaptive coalescing may merge a tiny result
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            rows = scale._sorted_rows(skewed.filter("value = 7"), order(), "hot")
            sizes = [r["count"] for r in rows.groupBy("__partition").count().collect()]
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == spread and max(sizes) < total / 2


def test_plan_moves_no_table_to_a_single_task(skewed):
    """The only single-partition step handles the per-partition counts."""
    placed = scale.global_position(skewed, order())
    plan = placed._jdf.queryExecution().executedPlan().toString()
    before_join = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in before_join
    assert "Window" not in before_join


@pytest.fixture(scope="module")
def uneven(spark):
    """Leading values of several types, a third of the rows sharing one; ids make the order total."""
    return spark.range(20_000).selectExpr(
        "id",
        "case when id % 3 = 0 then 0.05 else cast(pmod(hash(id), 9973) as decimal(14,2)) / 7 end as money",
        "case when id % 3 = 0 then 'éclair' else md5(cast(id % 5000 as string)) end as text",
        "case when id % 3 = 0 then null else date_add(date'2000-01-01', cast(pmod(hash(id), 3000) as int)) end as day",
        "timestamp_ntz'2017-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(hash(id), 7001)) as moment",
        "-pmod(hash(id), 3) as few",
    )


@pytest.mark.parametrize("few", [10**6, 50])
@pytest.mark.parametrize("column, up", [("money", True), ("money", False), ("text", True), ("text", False), ("moment", False), ("few", True)])
def test_cuts_by_sketch_are_the_exact_ones(uneven, monkeypatch, few, column, up):
    """However many rows lie in the brackets, and however they are ranked."""
    monkeypatch.setattr(scale, "_FEW", few)
    by = F.col(column).asc() if up else F.col(column).desc()
    mine = scale.global_ntile(uneven, 7, ((column, up), ("id", True)), "tile").select("id", "tile")
    theirs = uneven.select("id", F.ntile(7).over(Window.orderBy(by, "id")).alias("tile"))
    assert mine.exceptAll(theirs).count() == 0 and mine.count() == 20_000


def test_a_bracket_that_misses_its_cut_is_noticed(uneven, monkeypatch):
    monkeypatch.setattr(scale, "_intervals", lambda quantiles: [(5.0, 5.0)])
    mine = scale.global_ntile(uneven, 4, (("money", True), ("id", True)), "tile").select("id", "tile")
    theirs = uneven.select("id", F.ntile(4).over(Window.orderBy("money", "id")).alias("tile"))
    assert mine.exceptAll(theirs).count() == 0


def test_cuts_sort_only_what_lies_in_the_brackets(spark, uneven, monkeypatch):
    """A small part of the rows is ranked, and no written copy is made."""
    ranked = []
    rows_at = scale._rows_at
    monkeypatch.setattr(scale, "_rows_at", lambda df, *rest: ranked.append(rest[2]) or rows_at(df, *rest))
    monkeypatch.setattr(scale, "materialize", None)
    spread = spark.range(100_000).selectExpr("id", "cast(pmod(hash(id), 1000003) as double) as value")
    cuts = scale.tile_cuts_of(spread, 5, {"a": (("value", True), ("id", True)), "b": (("value", False), ("id", True))})
    assert len(cuts["a"].first().cuts) == 4 and len(cuts["b"].first().cuts) == 4
    assert all(rows < 2000 for rows in ranked) and len(ranked) == 2
    plan = cuts["a"]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
