"""Mixing sources to target weights by entropy balancing.

Each document gets a rate (expected copies). Among all rates that give every
source its target number of words and lie between 0 and ``max_copies``, the ones
closest in relative entropy to one copy each are exp(lambda * size), cut off at
``max_copies``, with one lambda per source: the dual is convex and its Hessian
diagonal by source. A source's Newton iterations (kept inside a bracket) need
only how many documents it has of each size, so Spark counts those over all
documents and every source is solved in a task of its own. Such a task holds the
distinct sizes of one source, at most the words of its longest document.

Rates become whole copies on the same counts. Documents of one source and size
are dealt into 64 slices by a hash of their id; a decision is "so many copies,
and one more in the slices below a bound". Going from large to small documents,
what a size takes too much or too little is handed on to the next, so a source
ends within about one small document of its target. No document is ranked and no
group of documents meets in one task.

Defined cases: a null text has size 0; documents of size 0 keep one copy; null is
a source of its own, the last one; repeated rows are separate documents of equal
size and fall in the same slice; an empty table, or one without words, has
targets 0; other columns are carried in ``row`` and never looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import WORD, table
from shopmart.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SLICES = 64


def allocate(sizes: list[float], weights: list[float], most: float) -> list[float]:
    """Share the sum of all sizes by weight; none gets over ``most`` times its size."""
    total, targets, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(targets[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / weight > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i] = most * sizes[i]
        open_ -= over
    return targets


def solve_rates(sizes: np.ndarray, counts: np.ndarray, target: float, most: float) -> np.ndarray:
    """Rates min(most, exp(lambda * size)) whose words add up to the target."""
    words = sizes * counts
    if words.sum() == 0 or target <= 0:
        return np.where(sizes > 0, 0.0, 1.0)
    if target >= most * words.sum():
        return np.where(sizes > 0, float(most), 1.0)
    scaled = sizes / (words.sum() / counts[sizes > 0].sum())
    top = math.log(most)

    def rates(x: float) -> np.ndarray:
        return np.exp(np.minimum(scaled * x, top))

    low, high, x = -1.0, top / scaled[scaled > 0].min(), 0.0
    while (words * rates(low)).sum() > target:
        low *= 2
    for _ in range(200):
        r = rates(x)
        miss = (words * r).sum() - target
        if abs(miss) <= 1e-10 * target:
            break
        low, high = (x, high) if miss < 0 else (low, x)
        slope = (words * scaled * r)[scaled * x < top].sum()
        step = x - miss / slope if slope > 0 else math.inf
        x = step if low < step < high else (low + high) / 2
    return rates(x)


def round_copies(
    sizes: np.ndarray, counts: list[np.ndarray], rates: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per size the copies of all its documents, and the slice below which there is one more.

    ``counts`` holds per size the documents of each slice.
    """
    base = np.minimum(np.floor(rates + 1e-12), most).astype(int)
    bound = np.zeros(len(sizes), int)
    owed = 0.0
    for i in np.argsort(-sizes, kind="stable"):
        if sizes[i] == 0:
            continue
        n = counts[i].sum()
        wanted = n * rates[i] * sizes[i] + owed
        if base[i] < most:
            extra = wanted / sizes[i] - n * base[i]
            reached = np.concatenate([[0], np.cumsum(counts[i])])
            bound[i] = int(np.abs(reached - extra).argmin())
            taken = n * base[i] + reached[bound[i]]
        else:
            taken = n * base[i]
        owed = wanted - taken * sizes[i]
    return base, bound


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: int = 3,
    carry: tuple[str, ...] = ("*",),
) -> DataFrame:
    """Each row as ``row`` (its columns ``carry``) with its ``size``, its source's ``source_size`` and ``target``, and ``copies``.

    Sources in order of code points, null last, have the weights in turn.
    """
    rows = docs.select(
        F.struct(*carry).alias("row"),
        F.col(source).alias("mixed_source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(F.xxhash64(F.col(key), F.lit("mix")), F.lit(SLICES)).cast("int").alias("slice"),
    )
    counted = rows.groupBy("mixed_source", "size", "slice").agg(F.count("*").alias("n"))
    counted = counted.groupBy("mixed_source", "size").agg(F.collect_list(F.struct("slice", "n")).alias("slices"))
    counted = materialize(counted, "mix-sizes")
    documents = F.aggregate("slices", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    per_source = counted.groupBy("mixed_source").agg(F.sum(F.col("size") * documents).alias("source_size"))

    def share(frame: pd.DataFrame) -> pd.DataFrame:
        order = sorted(
            range(len(frame)),
            key=lambda i: (frame.mixed_source.iloc[i] is None, frame.mixed_source.iloc[i] or ""),
        )
        frame = frame.iloc[order]
        each = [weights[i % len(weights)] for i in range(len(frame))]
        return frame.assign(target=allocate(frame.source_size.tolist(), each, max_copies))

    # One row per source meets in one task here, as the shares depend on all sources.
    targets = per_source.groupBy(F.lit(0).alias("one")).applyInPandas(
        lambda frame: share(frame[["mixed_source", "source_size"]]),
        "mixed_source string, source_size long, target double",
    )

    def decide(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size")
        counts = []
        for found in frame.slices:
            row = np.zeros(SLICES, np.int64)
            for s in found:
                row[s["slice"]] = s["n"]
            counts.append(row)
        sizes = frame["size"].to_numpy(float)
        rates = solve_rates(sizes, np.array([c.sum() for c in counts], float), frame.target.iloc[0], max_copies)
        base, bound = round_copies(sizes, counts, rates, max_copies)
        return frame[["mixed_source", "size", "source_size", "target"]].assign(rate=rates, base=base, bound=bound)

    same = F.col("mixed_source").eqNullSafe(F.col("of"))
    decided = (
        counted.join(targets.withColumnRenamed("mixed_source", "of"), same)
        .groupBy("mixed_source")
        .applyInPandas(
            decide,
            "mixed_source string, size long, source_size long, target double, rate double, base int, bound int",
        )
    )
    decided = materialize(decided, "mix-decisions").withColumnsRenamed({"mixed_source": "of", "size": "of_size"})
    # The decisions have no proven bound, so they are joined by sorting at any size;
    # what is carried is shuffled once.
    joined = rows.join(decided.hint("merge"), same & (F.col("size") == F.col("of_size")))
    extra = (F.col("slice") < F.col("bound")).cast("int")
    return joined.select("row", "size", "source_size", "target", "rate", (F.col("base") + extra).alias("copies"))


def op1_mixing(spark, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"), carry=("doc_id",))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken, "copies", "rate")


def repeat_rows(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: every row as many times as the mix takes it."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("one")
    return mix(docs).select("row", copies).select("row.*")
