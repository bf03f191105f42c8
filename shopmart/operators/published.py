"""The incremental operators on published tables: only what changes is read and written.

A table stored by part has an index of keys beside it: which parts have ever held a
key. It is stored in buckets by the key's hash and only appended to, so finding the
parts that hold a batch's keys reads the buckets of those keys and no part of the
table. The open versions of a history are stored in such buckets, too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.operators.snapshot import VALID_TO, apply_changes, apply_snapshot
from shopmart.operators.upsert import delete_insert
from shopmart.session import materialize
from shopmart.sources.publish import NO_PART, Location, Publisher, part_name

OPEN, CLOSED = "open", "closed"
BUCKETS = 64
SLICES = 16
#: A bucket of the index made of more folders is written anew.
MOST_FOLDERS = 8
_KEY, _AT, _BUCKET, _SLICE = "__key", "__at", "__bucket", "__slice"


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(BUCKETS)).cast("string")


def index_name(table: str) -> str:
    return f"{table}_keys"


def _pairs(rows: DataFrame, key: str, part: Column) -> DataFrame:
    """The part each key lies in. Tasks hold few buckets each, of which there are slices so that
    none is a task of its own however large.
    """
    found = rows.select(
        F.col(key).alias(_KEY),
        part_name(part).alias(_AT),
        _bucket(F.col(key)).alias(_BUCKET),
        F.pmod(F.hash(F.col(key).cast("string")), F.lit(SLICES)).alias(_SLICE),
    )
    return found.repartition(_BUCKET, _SLICE).distinct().drop(_SLICE)


def _write_index(
    publisher: Publisher, table: str, pairs: DataFrame, version: int, spread: bool = True
) -> dict[str, str]:
    name = F.concat(F.col(_BUCKET), F.lit(f"@{version}"))
    return publisher.write_parts(pairs, index_name(table), version, name, drop=(_BUCKET,), spread=spread)


def write_indexed(
    publisher: Publisher,
    table: str,
    rows: DataFrame,
    key: str,
    part: Column,
    version: int,
    derived: Mapping[str, Column] | None = None,
) -> dict[str, Location]:
    """Write a table stored by ``part`` from scratch, and its index; returns the folders of both.

    ``derived`` as in :meth:`Publisher.write_parts`.
    """
    folders = publisher.write_parts(rows, table, version, part, derived=derived)
    if not folders:  # an empty table, to have its columns
        folders = {NO_PART: publisher.write(rows.limit(0), table, version)}
    pairs = _pairs(publisher.read_at(folders), key, part)
    return {table: folders, index_name(table): _write_index(publisher, table, pairs, version, spread=False)}


def _held(publisher: Publisher, known: dict[str, str], pairs: DataFrame) -> DataFrame:
    """The pairs the index has of the batch's keys, read from the buckets of those keys."""
    # At most one row per bucket.
    buckets = {r[0] for r in pairs.select(_BUCKET).distinct().collect()}
    mine = [name for name in known if name.partition("@")[0] in buckets]
    if not mine:
        return pairs.select(_KEY, _AT).limit(0)
    return publisher.read_at(known, mine).join(pairs.select(_KEY).distinct(), _KEY, "left_semi")


def merge_parts(
    publisher: Publisher,
    table: str,
    batch: DataFrame,
    key: str,
    part: Column,
    version: int,
    derived: Mapping[str, Column] | None = None,
) -> dict[str, Location]:
    """Delete+insert ``batch`` into a table stored by ``part``; returns the folders of it and its index.

    Parts that never held a key of the batch and get none of its rows are not
    read and keep their folder. A part a key has left is looked into again when that
    key comes again: the index only grows.
    """
    index = index_name(table)
    if not publisher.exists(table):
        return write_indexed(publisher, table, batch, key, part, version, derived)
    published = publisher.parts(table)
    batch = materialize(batch, f"{table}_batch")
    pairs = materialize(_pairs(batch, key, part), f"{table}_batch_keys")
    if publisher.exists(index):
        known = publisher.parts(index)
    else:  # published before there was an index
        pairs_before = _pairs(publisher.read(table), key, part)
        known = _write_index(publisher, table, pairs_before, 0, spread=False)
    held = _held(publisher, known, pairs)
    # At most one row per part.
    touched = {r[0] for r in held.select(_AT).union(pairs.select(_AT)).distinct().collect()}

    rewritten = delete_insert(publisher.read(table, sorted(touched)), batch, key)
    kept = {name: path for name, path in published.items() if name not in touched}
    folders = kept | publisher.write_parts(rewritten, table, version, part, derived=derived)
    new = pairs.join(held, [_KEY, _AT], "left_anti")
    return {table: folders, index: _extend_index(publisher, table, known, new, version)}


def _extend_index(
    publisher: Publisher, table: str, known: dict[str, str], new: DataFrame, version: int
) -> dict[str, str]:
    """Append new pairs; buckets made of many folders are written as one."""
    folders = Counter(name.partition("@")[0] for name in known)
    full = {bucket for bucket, n in folders.items() if n >= MOST_FOLDERS}
    old = [name for name in known if name.partition("@")[0] in full]
    if old:
        again = publisher.read_at(known, old).withColumn(_BUCKET, _bucket(F.col(_KEY)))
        new = new.unionByName(again).distinct()
    kept = {name: path for name, path in known.items() if name not in old}
    return kept | _write_index(publisher, table, new, version)


def extend_history(
    publisher: Publisher,
    table: str,
    batch: DataFrame,
    key: str,
    check: Sequence[str],
    as_of: str,
    version: int,
) -> dict[str, Location]:
    """Apply ``batch``, seen at ``as_of``, to a published history; returns all its folders.

    Of the open versions the key and the checked columns are compared with the batch; only buckets
    with a difference are read whole and rewritten.
    """
    if not publisher.exists(table):
        history = apply_snapshot(None, batch, key, check, as_of)
        return {table: _write_history(publisher, table, history, key, version)}
    published = publisher.parts(table)
    batch = materialize(batch, f"{table}_batch")
    opened = publisher.read(table, [p for p in published if _is_open(p)])
    if set(check) <= set(opened.columns):
        same = F.col(f"b.{key}") == F.col(f"o.{key}")
        for c in check:
            same &= F.col(f"b.{c}").eqNullSafe(F.col(f"o.{c}"))
        changed = batch.alias("b").join(opened.select(key, *check).alias("o"), same, "left_anti")
    else:  # a checked column is new: every version gets another
        changed = batch
    buckets = _buckets_of(changed, key)
    mine = batch.filter(_bucket(F.col(key)).isin(*buckets)) if buckets else batch.limit(0)
    seen, kept = _split(publisher, table, buckets)
    history = apply_snapshot(seen, mine, key, check, as_of)
    return {table: kept | _write_history(publisher, table, history, key, version)}


def extend_history_by_changes(
    publisher: Publisher,
    table: str,
    changes: DataFrame,
    key: str,
    check: Sequence[str],
    changed_at: str,
    version: int,
) -> dict[str, Location]:
    """Apply rows, each at its own time, to a published history; returns all its folders.

    Only the buckets of the changed keys are read and rewritten.
    """
    if not publisher.exists(table):
        history = apply_changes(None, changes, key, check, changed_at)
        return {table: _write_history(publisher, table, history, key, version)}
    changes = materialize(changes, f"{table}_changes")
    seen, kept = _split(publisher, table, _buckets_of(changes, key))
    history = apply_changes(seen, changes, key, check, changed_at)
    return {table: kept | _write_history(publisher, table, history, key, version)}


def _is_open(part: str) -> bool:
    return part.partition("-")[0] == OPEN


def _buckets_of(rows: DataFrame, key: str) -> list[str]:
    """The buckets of some rows, at most :data:`BUCKETS`."""
    return sorted(r[0] for r in rows.select(_bucket(F.col(key))).distinct().collect())


def _split(publisher: Publisher, table: str, buckets: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """The open versions of some buckets, and the folders that stay as they are."""
    published = publisher.parts(table)
    # A history written before there were buckets has one open part.
    read = [p for p in published if p == OPEN or p in {f"{OPEN}-{b}" for b in buckets}]
    return publisher.read(table, read), {p: path for p, path in published.items() if p not in read}


def _write_history(
    publisher: Publisher, table: str, history: DataFrame, key: str, version: int
) -> dict[str, str]:
    """Open versions are stored by bucket; the versions a run closes become a part of
    their own and are not touched again."""
    opened = F.concat(F.lit(f"{OPEN}-"), _bucket(F.col(key)))
    part = F.when(F.col(VALID_TO).isNull(), opened).otherwise(F.lit(f"{CLOSED}-{version}"))
    return publisher.write_parts(history, table, version, part)
