"""Type 2 history: a new version of a row whenever a checked column changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
VERSION_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
HISTORY_COLUMNS = (VERSION_ID, UPDATED_AT, VALID_FROM, VALID_TO)

ORDER_STATUS_CHECKS = (
    "order_status",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
)


def _open_version(key: str, as_of: Column) -> list[Column]:
    version = F.md5(F.concat_ws("|", F.col(key).cast("string"), as_of.cast("string")))
    return [
        version.alias(VERSION_ID),
        as_of.alias(UPDATED_AT),
        as_of.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    ]


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns only ``other`` has, as NULL, at the end."""
    missing = [f for f in other.schema.fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def _one_row_each(df: DataFrame, by: Sequence[str], first: Sequence[str]) -> DataFrame:
    """The highest row, compared by the columns ``first`` and then the others, of each key."""
    rest = [c for c in df.columns if c not in by and c not in first]
    return (
        df.groupBy(*by)
        .agg(F.max(F.struct(*first, *rest)).alias("__row"))
        .select(*by, "__row.*")
        .select(df.columns)
    )


def apply_snapshot(
    history: DataFrame | None,
    batch: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: str | Column,
) -> DataFrame:
    """The history after seeing ``batch`` at time ``as_of``.

    A key whose checked columns differ (NULLs compare equal) gets its open
    version closed and a new one opened; a new key gets a first version; keys
    missing from the batch, changes to other columns and closed versions leave
    the history as it is.  Of several rows of a key the one with the highest
    checked columns counts.  Columns new in the batch are NULL in older
    versions; columns the batch no longer has are NULL in newer ones.
    """
    moment = (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("timestamp_ntz")
    batch = _one_row_each(batch, [key], check)
    if history is None:
        return batch.select("*", *_open_version(key, moment))

    history = _with_columns_of(history, batch)
    batch = _with_columns_of(batch, history.drop(*HISTORY_COLUMNS))
    columns = batch.columns
    current = history.filter(F.col(VALID_TO).isNull())
    closed = history.filter(F.col(VALID_TO).isNotNull())

    old = current.select(F.col(key).alias("__old_key"), F.struct("*").alias("old"))
    new = batch.select(
        F.col(key).alias("__new_key"),
        F.struct(*columns, *_open_version(key, moment)).alias("new"),
    )
    paired = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")

    same = F.lit(True)
    for c in check:
        same &= F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    unseen = F.col("__new_key").isNull()
    added = F.col("__old_key").isNull()
    ended = F.struct(
        *[
            moment.alias(c) if c == VALID_TO else F.col(f"old.{c}").alias(c)
            for c in current.columns
        ]
    )
    opened = F.struct(*[F.col(f"new.{c}").alias(c) for c in current.columns])
    versions = (
        F.when(added, F.array(opened))
        .when(unseen | same, F.array("old"))
        .otherwise(F.array(ended, opened))
    )
    latest = paired.select(F.inline(versions))
    return closed.unionByName(latest)


def apply_changes(
    history: DataFrame | None,
    changes: DataFrame,
    key: str,
    check: Sequence[str],
    changed_at: str,
) -> DataFrame:
    """The history after a feed in which a key may change several times.

    A row opens a version at its own ``changed_at`` if its checked columns
    differ (NULLs compare equal) from those of the row before it, in the feed or
    in the history; the next version of the key closes it.  Of several rows of a
    key and time the one with the highest checked columns counts.  Rows not
    newer than the start of the open version of their key, or without a time,
    change nothing, so that a feed may be delivered again.
    """
    at = F.col(changed_at).cast("timestamp_ntz")
    feed = _one_row_each(changes.filter(at.isNotNull()), [key, changed_at], check)
    rows = feed.select("*", *_open_version(key, at))
    closed = None
    if history is not None:
        history = _with_columns_of(history, feed)
        closed = history.filter(F.col(VALID_TO).isNotNull())
        current = history.filter(F.col(VALID_TO).isNull())
        rows = current.withColumn("__known", F.lit(True)).unionByName(
            _with_columns_of(rows, history).withColumn("__known", F.lit(False))
        )
        since = F.max(F.when(F.col("__known"), F.col(VALID_FROM))).over(Window.partitionBy(key))
        rows = rows.withColumn("__since", since).filter(
            F.col("__known") | F.col("__since").isNull() | (F.col(VALID_FROM) > F.col("__since"))
        ).drop("__since", "__known")

    in_time = Window.partitionBy(key).orderBy(VALID_FROM)
    before = F.lag(F.struct(*check)).over(in_time)
    chain = (
        rows.withColumn("__before", before)
        .filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.struct(*check)))
        .drop("__before")
        .withColumn(VALID_TO, F.lead(VALID_FROM).over(in_time))
    )
    return chain if closed is None else closed.unionByName(chain)


def as_of_view(history: DataFrame, moment: str | Column) -> DataFrame:
    """The version of every row that was valid at ``moment``."""
    at = (F.lit(moment) if isinstance(moment, str) else moment).cast("timestamp_ntz")
    still_open = F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at)
    return history.filter((F.col(VALID_FROM) <= at) & still_open)
