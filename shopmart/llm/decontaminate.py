"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and underscores, in lower case. The benchmark's
windows of ``min_match`` words (fewer for shorter items) are hashed by
Karp-Rabin's running polynomial, and so are the documents' windows, a batch at a
time; windows that meet are the seeds of a (document, item) pair. Pairs with
enough seeds are tiled: the longest match of words not yet marked is marked in
both texts, again and again, until none of ``min_match`` words is left. The share
of an item's words that are marked is its coverage; passages in another order
give the same tiles. Pairs of at least ``min_coverage`` are reported.

The benchmark is the query set: it is sent to the tasks in blocks of at most
``block_chars`` characters, each against all documents, so a large benchmark
costs more passes and no more memory. Documents are not shuffled. A document
holds all its pairs in one task, at most as many as the block has items.

Defined cases: null or empty texts and items without a word match nothing; an
item shorter than ``min_match`` has to occur as one passage; ties go to the first
place in the item, then in the document; repeated rows are reported each; empty
tables give an empty result; columns other than those named are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import slices, table, texts

MIN_MATCH = 5
MIN_COVERAGE = 0.8
_BASE = np.uint64(1_099_511_628_211)
_find = re.compile(r"\w+").findall


def tokens(text: str | None) -> list[str]:
    return _find((text or "").lower())


def running_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash modulo 2**64 of each window of n ids."""
    ids = ids.astype(np.uint64)
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        out = out * _BASE + ids[k : k + len(out)]
    return out


def tiles(item: np.ndarray, doc: np.ndarray, pairs: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, words) of the tiles.

    ``pairs``: every (item place, document place) where windows of n words are equal.
    """
    free_item, free_doc = np.ones(len(item), np.int64), np.ones(len(doc), np.int64)
    found = []
    while len(pairs):
        # Windows that touch nothing marked.
        a, b = np.concatenate([[0], np.cumsum(free_item)]), np.concatenate([[0], np.cumsum(free_doc)])
        p, d = pairs.T
        pairs = pairs[(a[p + n] - a[p] == n) & (b[d + n] - b[d] == n)]
        if not len(pairs):
            break
        # Runs on a diagonal are longer matches.
        p, d = pairs[np.lexsort((pairs[:, 0], pairs[:, 1] - pairs[:, 0]))].T
        starts = np.nonzero(np.r_[True, (np.diff(p) != 1) | (np.diff(d) != 1)])[0]
        lengths = np.diff(np.r_[starts, len(p)]) + n - 1
        best = min(np.nonzero(lengths == lengths.max())[0], key=lambda i: (p[starts[i]], d[starts[i]]))
        at, to, words = int(p[starts[best]]), int(d[starts[best]]), int(lengths[best])
        # A run may overlap itself in the document or the item only on other diagonals.
        free_item[at : at + words] = 0
        free_doc[to : to + words] = 0
        found.append((at, to, words))
    return found


class Benchmark:
    """A block of items, ready to be matched."""

    def __init__(self, items: list[tuple[int, str | None]], min_match: int) -> None:
        self.numbers: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for key, text in items:
            words = tokens(text)
            if words:
                for w in words:
                    self.numbers.setdefault(w, len(self.numbers) + 1)
                self.items.append((key, np.array([self.numbers[w] for w in words], np.int64)))
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_size = defaultdict(list)
        for i, (_, words) in enumerate(self.items):
            by_size[min(min_match, len(words))].append(i)
        for n, members in by_size.items():
            hashes = [running_hashes(self.items[i][1], n) for i in members]
            of = np.repeat(members, [len(h) for h in hashes])
            place = np.concatenate([np.arange(len(h)) for h in hashes])
            hashes = np.concatenate(hashes)
            order = np.argsort(hashes, kind="stable")
            self.windows[n] = hashes[order], of[order], place[order]

    def match(self, batch: list[str], min_coverage: float) -> list[tuple[int, int, int, int, float]]:
        """(row, item, tiles, words covered, coverage) of the pairs that reach the coverage."""
        number = self.numbers.get
        rows, ends, total = [], [], 0
        for t in batch:
            ids = np.array([number(w, 0) for w in tokens(t)], np.int64)
            rows.append(ids)
            total += len(ids)
            ends.append(total)
        if not total:
            return []
        ids, ends = np.concatenate(rows), np.array(ends)
        found = []
        for n, (hashes, of, place) in self.windows.items():
            known = np.concatenate([[0], np.cumsum(ids != 0)])
            at = np.nonzero(known[n:] - known[:-n] == n)[0]  # windows of benchmark words only
            row = np.searchsorted(ends, at, side="right")
            at, row = at[ends[row] - at >= n], row[ends[row] - at >= n]  # within one document
            if not len(at):
                continue
            own = np.zeros(len(at), np.uint64)
            for k in range(n):
                own = own * _BASE + ids[at + k].astype(np.uint64)
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            hit = np.nonzero(high > low)[0]
            pairs: dict[tuple[int, int], list] = defaultdict(list)
            for h in hit.tolist():
                for w in range(low[h], high[h]):
                    pairs[int(row[h]), int(of[w])].append((int(place[w]), int(at[h])))
            for (r, i), seeds in pairs.items():
                key, item = self.items[i]
                begin = int(ends[r]) - len(rows[r])
                seeds = np.array(seeds, np.int64) - [0, begin]
                window = np.arange(n)
                same = (item[seeds[:, :1] + window] == rows[r][seeds[:, 1:] + window]).all(axis=1)
                cover = np.zeros(len(item), bool)
                for k in range(n):
                    cover[seeds[same, 0] + k] = True
                if cover.sum() < min_coverage * len(item):
                    continue  # tiles can't cover more than the seeds do
                tiled = tiles(item, rows[r], seeds[same], n)
                words = sum(w for *_, w in tiled)
                if words >= min_coverage * len(item):
                    found.append((r, key, len(tiled), words, words / len(item)))
        return sorted(found)


def blocks(
    benchmark: DataFrame, min_match: int, key: str = "item_id", text: str = "text", block_chars: int = 16_000_000
) -> Iterator[Benchmark]:
    """The benchmark in blocks; one block at a time is held."""
    rows = benchmark.select(F.col(key).alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_chars)
    if not n:
        return
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        yield Benchmark([tuple(r) for r in rows.where(part == i).collect()], min_match)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(id, item, tiles, words, coverage) of every pair that reaches the coverage."""
    spark = docs.sparkSession
    schema = "id long, item long, tiles int, words int, coverage double"
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    found = spark.createDataFrame([], schema)
    for block in blocks(benchmark, min_match):
        sent = spark.sparkContext.broadcast(block)  # at most block_chars

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, chars=2_000_000):
                    hits = sent.value.match(texts(batch), min_coverage)
                    if hits:
                        row, item, n, words, share = zip(*hits)
                        ids = batch.column("id").take(pa.array(row))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array(item, pa.int64()), pa.array(n, pa.int32()), pa.array(words, pa.int32()), pa.array(share)],
                            ["id", "item", "tiles", "words", "coverage"],
                        )

        found = found.union(rows.mapInArrow(run, schema))
    return found


def op10_decontamination(spark, folder: str) -> DataFrame:
    found = overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def drop_contaminated(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the rows without a benchmark passage, as they are.

    Batches pass through whole, so that nothing is joined or shuffled.
    """
    for block in blocks(table(spark, folder, "benchmark"), MIN_MATCH):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, chars=2_000_000):
                    hits = {hit[0] for hit in sent.value.match(texts(batch), MIN_COVERAGE)}
                    yield batch.filter(pa.array([i not in hits for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
