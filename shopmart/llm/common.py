"""What the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than these.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_array(text: Column) -> Column:
    """Words of a text that is not null.

    Splitting at single characters is several times faster than at a pattern, and
    few texts hold blanks other than space and line feed.
    """
    lines = F.flatten(F.transform(F.split(text, "\n"), lambda line: F.split(line, " ")))
    rare = F.contains(text, F.lit("\t"))
    for blank in "\x0b\x0c\r":
        rare = rare | F.contains(text, F.lit(blank))
    return F.array_remove(F.when(rare, F.split(text, BLANK_RUN)).otherwise(lines), "")


def slices(batch: pa.RecordBatch, text: str = "text", chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds one row or at most about ``chars`` bytes of text."""
    sizes = batch.column(text).cast(pa.large_string())
    lengths = pa.compute.fill_null(pa.compute.binary_length(sizes), 0).to_pylist()
    start = held = 0
    for row, length in enumerate(lengths):
        if row > start and held + length > chars:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null becomes the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def give_back() -> None:
    """Return to the system what Arrow and Python have freed but keep for themselves.

    Workers outlive their tasks, and what they hold counts for the executor in later stages too.
    """
    pa.default_memory_pool().release_unused()
    # The heap's own, which Python and the libraries it calls share; only glibc has this call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def meets(taken: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Tells if a span (start, end) overlaps one of ``taken``. Spans are asked for in order and
    do not overlap each other, so that all of them take one sweep.
    """
    ahead = sorted(taken, reverse=True)
    reach = 0

    def overlaps(start: int, end: int) -> bool:
        nonlocal reach
        while ahead and ahead[-1][0] < end:
            reach = max(reach, ahead.pop()[1])
        return reach > start

    return overlaps
