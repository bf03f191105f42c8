"""Periodic runs of words by string synchronising sets.

A run is a longest stretch of words with smallest period q (words q apart are
identical) of at least 4 q words. Runs of period t <= q < 2 t are found at scale
t, for t = 1, 2, 4, ...:

- Every stretch of t words has a name; equal stretches of a document have equal
  names. Names of 2 t are made from pairs of names of t, so they are exact.
- A place belongs to the synchronising set of scale t if the least hash among the
  names at the t + 1 places from it on is at the first or the last of them. That
  depends on the 2 t words from the place on (its context) and on nothing else, so
  equal contexts are chosen alike. Places whose t words have a period of at most
  t / 4 are left out of the comparison; these highly periodic regions are the
  runs found at smaller scales, which thereby supply the small periods omitted here.
- Of any t places in a row one is chosen, unless the 3 t - 1 words from the first
  on have a period of at most t / 4. So a run has a chosen place among its first t,
  and, as t + q + 2 t <= 4 q + 1, the place q later is chosen too and has the same
  context within the run. As the context is longer than q - 1, no nearer place has it.
- So the distances t <= p < 2 t between neighbouring chosen places of equal context
  are all periods there are; each is extended word by word as far as it holds.

Only stretches that occur twice in a document can have equal contexts, so names
are kept of those alone; most texts have none left after a few scales.

Texts are cut into words and named in tasks, some documents at once; documents
are not shuffled. A document is held whole: about 200 bytes a word.

Defined cases: a null, empty or blank text has no words, no runs and the empty
collapsed text; a null key stays null; repeated rows and keys give a row each; a text is read
whole however long; an empty table gives an empty result; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import slices, table, texts

#: A run has at least this many periods; what scales find at which period rests on it.
PERIODS = 4
MIN_WORDS = 6
_LEFT_OUT = np.int64(1) << 62
_MULTIPLIER, _BITS = np.int64(2_654_435_761), np.int64((1 << 32) - 1)
Words = list[bytes]
Prepare = Callable[[int | None, Words], Words]


def number_words(documents: list[Words]) -> tuple[np.ndarray, np.ndarray]:
    """Number the words of all documents, no number in two documents; and words per document."""
    parts, used = [], 0
    for words in documents:
        numbers = dict.fromkeys(words)
        numbers = dict(zip(numbers, range(used, used + len(numbers))))
        used += len(numbers)
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array([len(d) for d in documents], np.int64)


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of equal keys, and whether a key occurs twice or more."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names, counts[names] > 1


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each place on (fewer at the end)."""
    low, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        low[:-step] = np.minimum(low[:-step], low[step:])
        have += step
    return low


def _extent(ids: np.ndarray, low: int, high: int, p: int, first: int, last: int) -> tuple[int, int]:
    """Widen low..high, where words are equal to those ``p`` later, as far as that holds."""
    step = 16
    while high + p < last:
        n = min(step, last - p - high)
        differ = ids[high : high + n] != ids[high + p : high + p + n]
        k = int(differ.argmax())
        if differ[k]:
            high += k
            break
        high, step = high + n, step * 2
    step = 16
    while low > first:
        n = min(step, low - first)
        differ = (ids[low - n : low] != ids[low - n + p : low + p])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            low -= k
            break
        low, step = low - n, step * 2
    return low, high


def find_runs(ids: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; starts count over all documents.

    ``ids``: the words of documents one after another, numbered by :func:`number_words`.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(ids))
    reach = np.zeros(len(ids), np.int64)  # how far the highly periodic regions that begin here go
    names, twice = _repeated(ids)
    names[~twice] = -1
    found: set[tuple[int, int, int]] = set()
    omitted: list[tuple[int, int, int]] = []  # regions whose period is not small yet
    t = 1
    while True:
        at = np.flatnonzero(names >= 0)
        at = at[ends[doc[at]] - place[at] >= 2 * t]
        at = at[names[at + t] >= 0]
        contexts, twice = _repeated(names[at] * (len(ids) + 1) + names[at + t])
        at, contexts = at[twice], contexts[twice]
        if not len(at):
            return sorted((low, high - low, p) for low, high, p in found)
        wide = np.full(len(names), -1, np.int64)
        wide[at] = contexts
        alive = np.zeros(len(lengths), bool)
        alive[doc[at]] = True
        alive = alive[doc]
        if not alive.all():  # go on with the documents that still have equal contexts
            doc, place, reach, names, wide = (a[alive] for a in (doc, place, reach, names, wide))
            at = np.flatnonzero(wide >= 0)
            contexts = wide[at]

        small = [r for r in omitted if PERIODS * r[2] <= t]
        omitted = [r for r in omitted if PERIODS * r[2] > t]
        if small:
            low, high, _ = np.array(small).T
            there = np.minimum(np.searchsorted(place, low), len(place) - 1)
            known = place[there] == low
            np.maximum.at(reach, there[known], high[known])
        hashes = names * _MULTIPLIER & _BITS
        hashes[(names < 0) | (np.maximum.accumulate(reach) >= place + t)] = _LEFT_OUT
        least = _window_minima(hashes, t + 1)[at]
        chosen = (least < _LEFT_OUT) & ((hashes[at] == least) | (hashes[at + t] == least))

        order = np.argsort(contexts[chosen], kind="stable")
        context, where = contexts[chosen][order], place[at[chosen]][order]
        gap = np.diff(where)
        near = (np.diff(context) == 0) & (gap >= t) & (gap < 2 * t)
        where, gap = where[:-1][near], gap[near]
        order = np.lexsort((where, gap))
        where, gap = where[order], gap[order]
        # Proposals of one period that overlap or touch are one stretch.
        new = np.ones(len(where), bool)
        new[1:] = (np.diff(gap) != 0) | (np.diff(where) > 2 * t)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(where))[: len(heads)] - 1
        owners = np.searchsorted(ends, where[heads], side="right")
        for low, high, p, k in zip(
            where[heads].tolist(), (where[tails] + 2 * t).tolist(), gap[heads].tolist(), owners.tolist()
        ):
            low, high = _extent(ids, low, high, p, int(starts[k]), int(ends[k]))
            run = (low, high + p, p)
            if run[1] - low >= PERIODS * p and run not in found:
                found.add(run)
                omitted.append(run)
        names = wide
        t *= 2


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    prepare: Prepare | None = None,
) -> DataFrame:
    """Per document: ``key, n_words, runs, collapsed``.

    ``runs`` holds (start, length, period) of the runs of at least ``min_words``
    words, by start, then period; ``collapsed`` the words, joined by one space, that
    no run contains after its first period. ``prepare`` may change the words of a document first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, chars=2_000_000):
                yield _collapse(batch, min_words, prepare)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "key long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(run, schema)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapse(batch: pa.RecordBatch, min_words: int, prepare: Prepare | None) -> pa.RecordBatch:
    keys = batch.column("key").to_pylist()
    # Splitting bytes splits at ASCII white space, which is what separates words.
    documents = [t.encode().split() for t in texts(batch)]
    if prepare is not None:
        documents = [prepare(key, words) for key, words in zip(keys, documents)]
    ids, lengths = number_words(documents)
    ends = np.cumsum(lengths)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    covered = np.zeros(len(ids) + 1, np.int64)
    for start, length, period in find_runs(ids, lengths):
        if length >= min_words:
            k = int(np.searchsorted(ends, start, side="right"))
            runs[k].append((start - int(ends[k] - lengths[k]), length, period))
            covered[start + period] += 1
            covered[start + length] -= 1
    kept = np.cumsum(covered)[:-1] == 0
    collapsed = []
    for words, found, end in zip(documents, runs, ends.tolist()):
        if found:
            words = [words[i] for i in np.flatnonzero(kept[end - len(words) : end])]
        collapsed.append(b" ".join(words).decode())
    named = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs]
    columns = [pa.array(keys, pa.int64()), pa.array(lengths), pa.array(named, _RUNS), pa.array(collapsed, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["key", "n_words", "runs", "collapsed"])


def plant(key: int | None, words: Words) -> Words:
    """Make the end of a tenth of the documents periodic, by the crc32 of the key."""
    if key is None or not words:
        return words
    g, tenth = divmod(zlib.crc32(str(key).encode()), 10)
    if tenth:
        return words
    n = len(words)
    a = g % n
    block = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (block * (1 + (n - a) // len(block)))[: n - a]


def op13_runs(spark, folder: str) -> DataFrame:
    found = periodic_runs(table(spark, folder, "documents"), prepare=plant)
    # The greatest length; among equal ones the smallest start, then period.
    ranked = F.transform(
        "runs",
        lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer")),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("*", F.array_max(ranked).alias("best"))
    return best.select(
        F.col("key").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.finer")).alias("period"),
        F.expr("(1000 * best.length) div (-best.finer)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
