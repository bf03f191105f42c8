"""Global ranks, tiles and running totals without a single-task window.

Spark runs a window without partition keys in one task.  Here the sort keys are
range-partitioned and sorted inside each partition; a row's global position is
its position in its partition plus the number of rows in earlier partitions.
Only one small row per partition (and group) is ever combined in one place.

The sorted rows are written to the shared folder once: positions and partition
counts must come from the same partitioning, and a recomputation after a lost
executor could draw different range boundaries.

The sort key has to be total (end it with a unique column); rows that tie on
all of it would share a partition and be numbered arbitrarily.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from shopmart.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below
_PARTITION = "__partition"
_LOCAL = "__local"


def _sorted_rows(df: DataFrame, keys: Sequence[Column], label: str) -> DataFrame:
    """Globally sorted rows with their partition and position inside it."""
    row_id = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__row", row_id)
        .withColumn(_PARTITION, F.shiftright("__row", _POSITION_BITS))
        .withColumn(_LOCAL, F.col("__row").bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("__row")
    )
    return materialize(placed, label)


def global_position(
    df: DataFrame,
    order: Sequence[Column],
    within: Sequence[str] = (),
    running: dict[str, str] | None = None,
    label: str = "sorted",
) -> DataFrame:
    """Add ``row_number`` and ``group_rows``, over all rows or per ``within`` group.

    ``running`` maps a result column to a column to sum from the first row of
    the group to the current one.  ``within`` may have few or many groups, and
    a group may hold any share of the rows.
    """
    within = list(within)
    running = running or {}
    rows = _sorted_rows(df, [*[F.col(c).asc() for c in within], *order], label)

    # One row per partition and group: where it starts, how much it holds.
    pieces = rows.groupBy(_PARTITION, *within).agg(
        F.min(_LOCAL).alias("__start"),
        F.count("*").alias("__rows"),
        *[F.sum(value).alias(f"__sum_{name}") for name, value in running.items()],
    )
    # At most one piece per partition without groups; with groups the window is
    # partitioned by them.
    group = Window.partitionBy(*[F.col(c) for c in within])
    before = group.orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    pieces = pieces.select(
        F.col(_PARTITION).alias("__piece"),
        *[F.col(c).alias(f"__in_{c}") for c in within],
        (F.coalesce(F.sum("__rows").over(before), zero) - F.col("__start")).alias("__shift"),
        F.sum("__rows").over(group).alias("group_rows"),
        *[
            F.coalesce(F.sum(f"__sum_{name}").over(before), zero).alias(f"__base_{name}")
            for name in running
        ],
    )
    same_piece = F.col(_PARTITION) == F.col("__piece")
    for c in within:
        same_piece &= F.col(c).eqNullSafe(F.col(f"__in_{c}"))

    # Running sums inside a piece: one window partition per range partition.
    piece = Window.partitionBy(_PARTITION, *within)
    upto = piece.orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, value in running.items():
        rows = rows.withColumn(f"__run_{name}", F.sum(value).over(upto))

    # Without groups, or with TRUE/FALSE groups, there are only a few pieces per
    # partition however large the data; otherwise the size decides at run time.
    if all(isinstance(df.schema[c].dataType, BooleanType) for c in within):
        pieces = F.broadcast(pieces)
    return rows.join(pieces, same_piece).select(
        *[F.col(c) for c in df.columns],
        (F.col(_LOCAL) + F.col("__shift") + 1).alias("row_number"),
        "group_rows",
        *[(F.col(f"__run_{n}") + F.col(f"__base_{n}")).alias(n) for n in running],
    )


def _tile_ends(rows: int, tiles: int) -> list[int]:
    """0-based positions of the last row of every ``ntile`` bucket but the last used.

    The first ``rows % tiles`` buckets hold one row more than the others.
    """
    small, larger = divmod(rows, tiles)
    ends, end = [], 0
    for tile in range(tiles):
        end += small + (tile < larger)
        ends.append(end - 1)
    return sorted({e for e in ends if 0 <= e < rows - 1})


def _after(row: Sequence[Column], cut: Sequence[Column], ascending: Sequence[bool]) -> Column:
    """Whether ``row`` sorts strictly after ``cut``."""
    result, equal = F.lit(False), F.lit(True)
    for mine, theirs, up in zip(row, cut, ascending, strict=True):
        result = result | (equal & ((mine > theirs) if up else (mine < theirs)))
        equal = equal & (mine == theirs)
    return result


Order = Sequence[tuple[str, bool]]

#: Ranks of the sketch are off by at most one in so many rows.
_ACCURACY = 10_000
#: So many rows are ranked in one task; more are sorted over many.
_FEW = 100_000


def _along(df: DataFrame, name: str, ascending: bool) -> Column:
    """A DOUBLE that never falls along the order; different values may share one."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, StringType):
        # The first six bytes, which a DOUBLE holds exactly.
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0")
        number = F.conv(head, 16, 10).cast("double")
    elif isinstance(kind, DateType):
        number = F.unix_date(column).cast("double")
    elif isinstance(kind, TimestampType):
        number = F.unix_micros(column).cast("double")
    elif isinstance(kind, TimestampNTZType):
        # Whole seconds without going through a time zone.
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        number = F.unix_date(F.to_date(column)).cast("double") * 86_400 + seconds
    else:
        number = column.cast("double")
    return number if ascending else -number


def _intervals(quantiles: Sequence[float]) -> list[tuple[float, float]]:
    """The brackets (low, high, low, high, ...) as disjoint intervals in order."""
    merged: list[tuple[float, float]] = []
    for low, high in sorted(zip(quantiles[::2], quantiles[1::2])):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _inside(along: Column, low: float, high: float) -> Column:
    return along.between(F.lit(low), F.lit(high))


def tile_cuts_of(df: DataFrame, tiles: int, orders: dict[str, Order]) -> dict[str, DataFrame]:
    """:func:`tile_cuts` for several orders of the same rows, by label.

    The rows are not sorted. A sketch of each order's leading column brackets the cuts, one
    more pass counts the rows before and within each bracket exactly, and only the
    rows within are ranked. If a cut were not in its bracket, all rows would be.
    """
    # Lowest and highest share of the rows at which a cut can lie, as far as the sketch tells.
    slack = 3 / _ACCURACY
    shares = [min(1.0, max(0.0, k / tiles + d)) for k in range(1, tiles) for d in (-slack, slack)]
    along = {label: _along(df, *order[0]) for label, order in orders.items()}
    sketches = [F.percentile_approx(a, shares, _ACCURACY).alias(label) for label, a in along.items()]
    sketch = df.agg(F.count("*").alias("__rows"), *sketches).first()
    rows, ends = sketch["__rows"], _tile_ends(sketch["__rows"], tiles)
    if not ends:
        return {label: _rows_at(df.limit(0), order, [], 0, label) for label, order in orders.items()}
    brackets = {label: _intervals(sketch[label]) for label in orders}
    counts = [
        count
        for label, a in along.items()
        for low, high in brackets[label]
        for count in (F.count_if(a < low), F.count_if(_inside(a, low, high)))
    ]
    counted = iter(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first())
    cuts = {}
    for label, order in orders.items():
        within, wanted, held = F.lit(False), [], 0
        for low, high in brackets[label]:
            before, inside = next(counted), next(counted)
            within |= _inside(along[label], low, high)
            wanted += [held + end - before for end in ends if before <= end < before + inside]
            held += inside
        if len(wanted) < len(ends):
            within, wanted, held = F.lit(True), ends, rows
        cuts[label] = _rows_at(df.filter(within), order, wanted, held, label)
    return cuts


def _rows_at(df: DataFrame, order: Order, positions: Sequence[int], rows: int, label: str) -> DataFrame:
    """One row, ``cuts``: those at the given places (from 0) along the order."""
    names = [name for name, _ in order]
    keys = [F.col(name).asc() if up else F.col(name).desc() for name, up in order]
    df = df.select(*names)
    if rows <= _FEW:
        place = F.row_number().over(Window.orderBy(*keys)) - 1
        found = df.withColumn("__place", place).filter(F.col("__place").isin(*positions))
    else:
        sorted_rows = _sorted_rows(df, keys, label)
        # One row per range partition.
        sizes = {r[_PARTITION]: r["count"] for r in sorted_rows.groupBy(_PARTITION).count().collect()}
        wanted, start = F.lit(False), 0
        for partition in sorted(sizes):
            local = [p - start for p in positions if start <= p < start + sizes[partition]]
            start += sizes[partition]
            if local:
                wanted = wanted | ((F.col(_PARTITION) == partition) & F.col(_LOCAL).isin(local))
        found = sorted_rows.filter(wanted)
    # At most tiles - 1 rows.
    return found.agg(F.collect_list(F.struct(*names)).alias("cuts"))


def tile_cuts(df: DataFrame, tiles: int, order: Order, label: str = "cuts") -> DataFrame:
    """One row, ``cuts``: the last row of every bucket of ``ntile(tiles)`` over ``df``.

    ``order`` lists (column, ascending); the columns must be filled and end with
    a unique one.  A bucket number is then a comparison with at most ``tiles - 1``
    values, so the full rows are neither sorted, shuffled nor joined. ``df`` is read
    three times; hand in a written table where it is expensive.
    """
    return tile_cuts_of(df, tiles, {label: order})[label]


def tile_number(order: Sequence[tuple[str, bool]], cuts: Column) -> Column:
    """The bucket of the current row, given :func:`tile_cuts` of the same ``order``."""
    row = [F.col(name) for name, _ in order]
    ascending = [up for _, up in order]
    passed = F.filter(cuts, lambda cut: _after(row, [cut[name] for name, _ in order], ascending))
    return F.size(passed) + 1


def global_ntile(
    df: DataFrame, tiles: int, order: Sequence[tuple[str, bool]], name: str
) -> DataFrame:
    """``ntile(tiles) over (order by order)`` as column ``name``.

    ``df`` is read four times; hand in a written table where it is expensive.
    """
    cuts = tile_cuts(df, tiles, order, label=name).withColumnRenamed("cuts", "__cuts")
    tiled = df.crossJoin(F.broadcast(cuts))
    return tiled.withColumn(name, tile_number(order, F.col("__cuts"))).drop("__cuts")


def over_all(aggregate: Column) -> Column:
    """A total over every row of a small, already aggregated report.

    For reports with a row per state, month, bucket or segment, whose size does
    not depend on the data; larger results go through :func:`global_position`.
    """
    return aggregate.over(Window.partitionBy())
