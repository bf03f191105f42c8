"""Toxicity by a chain of linear classifiers.

One logistic regression per category, in a fixed order; each later one also reads
the probabilities of the earlier ones. While training, those are out-of-fold
predictions, so that a later link learns from probabilities as uncertain as the
ones it will see. Features are the distinct words of a text and their beginnings
of 4 to 7 letters, of which each category keeps those that labels speak for
(chi-square). The threshold of a category is the out-of-fold one of the best F1.

The chain is fitted on the driver on at most ``sample`` labelled documents (those
of the smallest hash of their id); everything else runs in the tasks, where a
word's features are looked up once and cached.

Defined cases: a null or empty text has no features and gets the probability of
the intercept; labels that are null, or of unknown documents, are not used; a
category with a single value among the labels gets that value as its constant
probability; repeated rows get equal results; without labels all probabilities
are 0; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import slices, table, texts

SAMPLE = 12_000
BUCKETS = 1 << 20
FEATURES = 3_000
FOLDS = 3
MAX_WORDS = 4_000
_words = re.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> list[str]:
    return [word, *[f"^{word[:n]}" for n in range(4, 8) if len(word) > n]]


def _number(feature: str) -> int:
    import zlib

    return zlib.crc32(feature.encode()) & (BUCKETS - 1)


def text_words(text: str | None) -> set[str]:
    return set(_words((text or "").lower()))


class Linear:
    """Logistic regression on rows of feature numbers plus dense columns."""

    def __init__(self, n_features: int, n_dense: int) -> None:
        self.weights, self.dense, self.bias = np.zeros(n_features), np.zeros(n_dense), 0.0

    def fit(self, rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, y: np.ndarray, l2: float = 2.0) -> Linear:
        """``rows``, ``cols``: where the features are 1. Gradient steps scaled per weight (Adam)."""
        n = len(y)
        parameters = np.zeros(len(self.weights) + dense.shape[1] + 1)
        first, second = np.zeros_like(parameters), np.zeros_like(parameters)
        w = len(self.weights)
        share = min(max(y.mean(), 1e-6), 1 - 1e-6)
        parameters[-1] = np.log(share / (1 - share))
        for step in range(1, 161):
            z = np.bincount(rows, parameters[cols], n) + dense @ parameters[w:-1] + parameters[-1]
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            gradient = np.concatenate([np.bincount(cols, miss[rows], w), dense.T @ miss, [miss.sum()]])
            gradient[:-1] += l2 * parameters[:-1]
            gradient /= n
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            parameters -= 0.1 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        self.weights, self.dense, self.bias = parameters[:w], parameters[w:-1], parameters[-1]
        return self

    def predict(self, rows: np.ndarray, cols: np.ndarray, dense: np.ndarray) -> np.ndarray:
        z = np.bincount(rows, self.weights[cols], len(dense)) + dense @ self.dense + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Chain:
    def __init__(self, categories: list[str]) -> None:
        self.categories = categories
        self.vocabulary: dict[int, int] = {}
        self.links: list[Linear | float] = []
        self.thresholds: list[float] = []
        self.known: dict[str, tuple[int, ...]] = {}

    def fit(self, features: list[np.ndarray], labels: np.ndarray) -> Chain:
        """``features``: hashed features per document; ``labels``: documents x categories."""
        n = len(features)
        rows = np.repeat(np.arange(n), [len(f) for f in features])
        cols = np.concatenate([*features, np.empty(0, np.int64)]).astype(np.int64)
        df = np.bincount(cols, minlength=BUCKETS).astype(float)
        chosen: set[int] = set()
        for k in range(len(self.categories)):
            y = labels[:, k]
            if not n or y.min() == y.max():
                continue
            seen = np.bincount(cols, y[rows], BUCKETS)
            expected = df * y.mean()
            spread = np.maximum(df * y.mean() * (1 - y.mean()) * (1 - df / n), 1e-9)
            score = np.where(df >= 4, (seen - expected) ** 2 / spread, 0)
            top = np.argsort(-score, kind="stable")[: FEATURES // len(self.categories)]
            chosen.update(top[score[top] > 15].tolist())
        self.vocabulary = {f: i for i, f in enumerate(sorted(chosen))}
        place = np.full(BUCKETS, -1)
        place[list(self.vocabulary)] = list(self.vocabulary.values())
        kept = place[cols] >= 0
        rows, cols = rows[kept], place[cols[kept]]
        fold = np.arange(n) % FOLDS
        earlier = np.zeros((n, 0))
        for k in range(len(self.categories)):
            y = labels[:, k]
            if not n or y.min() == y.max():
                self.links.append(float(y[0]) if n else 0.0)
                self.thresholds.append(0.5)
                out = np.full(n, self.links[-1])
            else:
                out = np.zeros(n)
                for f in range(FOLDS):
                    test = fold == f
                    link = self._fit(rows, cols, earlier, y, ~test)
                    out[test] = link.predict(rows, cols, earlier)[test]
                self.links.append(self._fit(rows, cols, earlier, y, np.ones(n, bool)))
                self.thresholds.append(best_threshold(out, y))
            earlier = np.column_stack([earlier, out])
        return self

    def _fit(self, rows, cols, dense, y, use) -> Linear:
        number = np.cumsum(use) - 1
        pick = use[rows]
        return Linear(len(self.vocabulary), dense.shape[1]).fit(number[rows[pick]], cols[pick], dense[use], y[use])

    def predict(self, batch: list[str]) -> np.ndarray:
        """Documents x categories."""
        if len(self.known) > 300_000:
            self.known.clear()
        known, vocabulary, found = self.known, self.vocabulary, []
        for t in batch:
            words = text_words(t)
            for w in words:
                if w in known:
                    continue
                hits = [vocabulary.get(_number(f)) for f in word_features(w)]
                known[w] = tuple(h for h in hits if h is not None)
            found.append({h for w in words if known[w] for h in known[w]})
        rows = np.repeat(np.arange(len(batch)), [len(f) for f in found])
        cols = np.array([h for f in found for h in f], np.int64)
        dense = np.zeros((len(batch), 0))
        for link in self.links:
            new = np.full(len(batch), link) if isinstance(link, float) else link.predict(rows, cols, dense)
            dense = np.column_stack([dense, new])
        return dense


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """Midway below the lowest score that is accepted where F1 is best."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    at = int(f1.argmax())
    below = scores[order[at + 1]] if at + 1 < len(order) else 0.0
    return float(max((scores[order[at]] + below) / 2, 1e-6))


def train(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str], key: str = "doc_id", text: str = "text", sample: int = SAMPLE
) -> Chain:
    """``categories``: name and SQL condition over the labels, in the order of the chain."""
    named = labels.select(
        F.col(key).cast("long").alias("id"), *[F.expr(c).cast("double").alias(f"y{k}") for k, c in enumerate(categories.values())]
    ).dropna()
    chosen = named.orderBy(F.xxhash64("id"), "id").limit(sample)  # a top-k: no full sort
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, features array<int>, " + ", ".join(f"y{k} double" for k in range(len(categories)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = []
                for t in texts(batch):
                    words = sorted(text_words(t), key=_number)[:MAX_WORDS]  # bounds a training row
                    found.append(sorted({_number(f) for w in words for f in word_features(w)}))
                columns = [batch.column("id"), pa.array(found, pa.list_(pa.int32()))]
                columns += [batch.column(f"y{k}") for k in range(len(categories))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "features", *[f"y{k}" for k in range(len(categories))]])

    picked = rows.join(F.broadcast(chosen), "id").select("id", "text", *[f"y{k}" for k in range(len(categories))])
    found = picked.mapInArrow(hashed, schema).toArrow()  # at most ``sample`` labelled documents
    order = np.argsort(found["id"].to_numpy(), kind="stable")
    lists = found["features"].combine_chunks()
    features = [np.asarray(lists[i].values) for i in order.tolist()] if len(lists) else []
    y = np.column_stack([found[f"y{k}"].to_numpy()[order] for k in range(len(categories))]) if len(lists) else np.zeros((0, len(categories)))
    return Chain(list(categories)).fit(features, y)


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, p_<category> ..., is_<category> ...) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES weights a link
    names = chain.categories

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = sent.value.predict(texts(batch))
                columns = [batch.column("id"), *[pa.array(found[:, k]) for k in range(len(names))]]
                columns += [pa.array(found[:, k] >= sent.value.thresholds[k]) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, ["id", *[f"p_{c}" for c in names], *[f"is_{c}" for c in names]])

    schema = "id long, " + ", ".join([f"p_{c} double" for c in names] + [f"is_{c} boolean" for c in names])
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


#: The labels know two: junk texts come first, as junk hides toxic words.
CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}


def op9_toxicity(spark, folder: str) -> DataFrame:
    """The documents found toxic."""
    docs = table(spark, folder, "documents")
    chain = train(docs, table(spark, folder, "labels"), CATEGORIES)
    found = score(docs, chain).where("is_toxic")
    return found.select(F.col("id").alias("doc_id"), F.col("is_toxic").alias("toxic"), "p_toxic", "p_junk")
