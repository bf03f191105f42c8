"""The two incremental operators as sinks of a stream of micro-batches.

Each sink publishes a new version per micro-batch, and with it the number of the
batch, in one step. A micro-batch that is delivered again, after a failure or by a
stream started over, is known by the sink's name and its number and writes nothing. A
stream whose batches are others needs another name. What a batch writes on the way is
deleted when it is done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopmart.operators.published import extend_history_by_changes, merge_parts
from shopmart.session import scratch
from shopmart.sources.publish import Location, Publisher

Sink = Callable[[DataFrame, int], None]
Load = Callable[[DataFrame, int], dict[str, Location]]


def _once(publisher: Publisher, name: str, load: Load) -> Sink:
    """Publish what ``load`` makes of a batch, unless the batch has been published."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= publisher.last_batch(name):
            return
        with scratch(batch.sparkSession):
            version = publisher.next_version()
            tables = {} if batch.isEmpty() else load(batch, version)
            publisher.commit(version, tables, (name, batch_id))

    return write


def upsert_sink(
    publisher: Publisher,
    table: str,
    key: str,
    newest: Sequence[Column],
    part: Column,
    name: str | None = None,
) -> Sink:
    """Delete+insert every micro-batch into a table stored by ``part``.

    Of several rows of a key in one micro-batch the highest by ``newest`` stays.
    """

    def load(batch: DataFrame, version: int) -> dict[str, Location]:
        rows = F.struct(*batch.columns)
        latest = (
            batch.groupBy(F.col(key).alias("__key"))
            .agg(F.max_by(rows, F.struct(*newest)).alias("row"))
            .select("row.*")
        )
        return merge_parts(publisher, table, latest, key, part, version)

    return _once(publisher, name or f"upsert {table}", load)


def history_sink(
    publisher: Publisher,
    table: str,
    key: str,
    check: Sequence[str],
    changed_at: str,
    name: str | None = None,
) -> Sink:
    """Apply every micro-batch to the history, each row at its own ``changed_at``."""

    def load(batch: DataFrame, version: int) -> dict[str, Location]:
        return extend_history_by_changes(publisher, table, batch, key, check, changed_at, version)

    return _once(publisher, name or f"history {table}", load)


def run_available(stream: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Process what has arrived since the last run, then stop."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
