"""Each event with the version of its key that was valid at the event's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.operators.snapshot import VALID_FROM, VALID_TO

_AT, _SPAN, _KIND, _EVENT, _VERSION = "__at", "__span", "__kind", "__event", "__version"
_CARRIED, _STARTED, _ASKED = -1, 0, 1  # in this order at the same moment


def as_of_join(
    events: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    span: str = "month",
) -> DataFrame:
    """``events`` with ``columns`` of the version valid at ``at``, NULL where there is none.

    Events and versions are put in line by time and each event takes the last
    version before it, so the work is that of two sorts however many versions a key has;
    events are never paired with versions. Lines are cut into spans of time (a unit
    of ``date_trunc``), so the events of a hot key are spread over as many tasks as they have spans. Of each
    key and span only the last version is handed on to the later ones.

    A version is valid from its start until just before its end. Versions of a key
    must not overlap; of those that start together the one that ends last counts.
    Events without a key or a time have no version. Rows may repeat.
    """
    moment = F.col(at).cast("timestamp_ntz")
    asked = events.select(
        F.col(key).alias("__key"),
        moment.alias(_AT),
        F.lit(_ASKED).alias(_KIND),
        F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias(_EVENT),
    )
    version = F.struct(F.col(VALID_FROM), F.col(VALID_TO), *[F.col(c).alias(f"__{c}") for c in columns])
    started = history.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"),
        F.col(VALID_FROM).cast("timestamp_ntz").alias(_AT),
        F.lit(_STARTED).alias(_KIND),
        version.alias(_VERSION),
    )
    asked, started = (
        df.withColumn(_SPAN, F.date_trunc(span, F.col(_AT)).cast("timestamp_ntz")) for df in (asked, started)
    )

    # One row per key and span: its last version, and whether any event asks for one.
    start_order = F.struct(_AT, F.col(f"{_VERSION}.{VALID_TO}").isNull(), F.col(f"{_VERSION}.{VALID_TO}"))
    last = started.groupBy("__key", _SPAN).agg(F.max_by(_VERSION, start_order).alias(_VERSION))
    wanted = asked.filter(F.col("__key").isNotNull() & F.col(_AT).isNotNull()).select("__key", _SPAN).distinct()
    spans = last.withColumn("__wanted", F.lit(False)).unionByName(
        wanted.withColumn("__wanted", F.lit(True)), allowMissingColumns=True
    )
    spans = spans.groupBy("__key", _SPAN).agg(
        F.max(_VERSION).alias(_VERSION), F.bool_or("__wanted").alias("__wanted")
    )
    earlier = Window.partitionBy("__key").orderBy(_SPAN).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        spans.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(earlier))
        .filter(F.col("__wanted") & F.col(_VERSION).isNotNull())
        .select("__key", _SPAN, F.col(_SPAN).alias(_AT), F.lit(_CARRIED).alias(_KIND), _VERSION)
    )

    line = asked.unionByName(started, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    in_time = Window.partitionBy("__key", _SPAN).orderBy(
        F.col(_AT), F.col(_KIND), F.col(f"{_VERSION}.{VALID_TO}").asc_nulls_last()
    )
    before = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = line.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(before))
    found = found.filter(F.col(_KIND) == _ASKED)
    ends = F.col(f"{_VERSION}.{VALID_TO}")
    known = F.col("__key").isNotNull() & F.col(_AT).isNotNull()
    valid = known & F.col(_VERSION).isNotNull() & (ends.isNull() | (ends > F.col(_AT)))
    return found.select(
        *[F.col(f"{_EVENT}.`{c}`").alias(c) for c in events.columns],
        *[F.when(valid, F.col(f"{_VERSION}.__{c}")).alias(c) for c in columns],
        F.when(valid, F.col(f"{_VERSION}.{VALID_FROM}")).alias(VALID_FROM),
    )
