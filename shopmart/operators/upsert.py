"""Incremental load of a fact: look-back batch and delete+insert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKBACK_DAYS = 30


def look_back(
    rows: DataFrame, target: DataFrame | None, column: str, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Rows of ``column`` no older than ``days`` before the newest row of ``target``.

    Without a target, or with an empty one, everything is returned: a first
    load.
    """
    if target is None:
        return rows
    newest = target.agg(F.max(column)).scalar()
    since = newest - F.make_dt_interval(F.lit(days))
    return rows.filter(newest.isNull() | (F.col(column) >= since))


def delete_insert(target: DataFrame | None, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``target`` without the keys of ``batch``, plus ``batch``.

    Rows outside the batch stay, even when the source no longer has them.
    Columns only the batch has are appended, NULL for the rows kept.
    """
    if target is None:
        return batch
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(batch.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(batch, allowMissingColumns=True)


def touched_partitions(
    target: DataFrame, batch: DataFrame, key: str, partition: str
) -> DataFrame:
    """Partitions a delete+insert has to rewrite.

    Those the batch writes to, and those that hold an older row of one of its
    keys.  Reads only the key and partition columns of the target.
    """
    holding = target.select(key, partition).join(batch.select(key), key, "left_semi")
    return holding.select(partition).union(batch.select(partition)).distinct()
