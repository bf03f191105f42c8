"""Language identification by cross-parsing entropy.

Per language a suffix automaton of a labelled reference text accepts exactly the
reference's substrings. A text is parsed greedily from left to right into the
longest phrases that the reference has (a character it lacks is a phrase of its
own); the fewer phrases, the closer the language. Phrases are normalised by the
bits that name one, log2 of the reference's length. The least wins, ties go to
the first language in order; the score is 1 - least / second least.

Texts are compared in lower case, everything but letters as single spaces, and
are cut into blocks of BLOCK characters at whose ends phrases end too. Blocks of
many texts are parsed in lockstep: one table look-up per character and language,
in which a failing transition already leads on from the root and carries a mark
that is counted.

References: per language PIECES pieces of labelled documents, each the first
PIECE characters of the document with the smallest hash of its id in a slice of
the ids, together at most ``total`` characters for all languages. Only text and
label of documents whose crc32 (of the id as text) modulo 4 is not 2 are used.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
text without any known letter has equal counts and goes to the first language;
without labels all is ``und``; a null id is never held out and never learned
from; repeated rows get equal results; columns other than those named are not
looked at.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import slices, table, texts

BLOCK = 256
PIECES = 64
PIECE = 600
TOTAL = 400_000
_MARK = np.int32(1 << 30)


@functools.cache
def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], bool)


def normalise(text: str) -> np.ndarray:
    """Code points in lower case; runs of other characters become one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter_table()[points]
    keep = letters | np.r_[False, letters[:-1]] if len(points) else letters
    return np.where(letters, points, 32)[keep].astype(np.uint32)


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the states; state 0 is the root. At most twice as many states as characters."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return nexts


class Languages:
    def __init__(self, references: dict[str, str]) -> None:
        self.names = sorted(references)
        texts_ = [normalise(references[n]) for n in self.names]
        known = sorted({int(c) for t in texts_ for c in np.unique(t)})
        #: 0 is a character that no reference has.
        self.numbers = {c: i + 1 for i, c in enumerate(known)}
        self.width = len(known) + 1
        self.bits = [math.log2(len(t) + 1) for t in texts_]
        self.edges = []
        for t in texts_:
            nexts = suffix_automaton([self.numbers[int(c)] for c in t])
            flat = [(s, c, to) for s, row in enumerate(nexts) for c, to in row.items()]
            self.edges.append((len(nexts), np.array(flat, np.int32).reshape(-1, 3)))
        self._tables: list[np.ndarray] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    def tables(self) -> list[np.ndarray]:
        """Per language the next state (times the width, to save a multiplication)."""
        if self._tables is None:
            self._tables = []
            for states, edges in self.edges:
                dense = np.zeros((states, self.width), np.int32)
                root = edges[edges[:, 0] == 0]
                dense[:, root[:, 1]] = root[:, 2] * self.width
                dense |= _MARK
                dense[edges[:, 0], edges[:, 1]] = edges[:, 2] * self.width
                # The first character opens a phrase: so at the root every step is marked.
                dense[0] |= _MARK
                self._tables.append(dense.ravel())
        return self._tables

    def phrases(self, batch: list[np.ndarray]) -> np.ndarray:
        """Texts (normalised) x languages: numbers of phrases."""
        lookup = np.zeros(0x110000, np.int32)
        lookup[list(self.numbers)] = list(self.numbers.values())
        lengths = np.array([len(t) for t in batch])
        parts = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(batch)), parts)
        grid = np.zeros((len(owner), BLOCK), np.int32)
        sizes = np.full(len(owner), BLOCK)
        at = 0
        for t, n in zip(batch, parts.tolist()):
            if n:
                grid[at : at + n].ravel()[: len(t)] = lookup[t]
                sizes[at + n - 1] = len(t) - (n - 1) * BLOCK
            at += n
        order = np.argsort(-sizes, kind="stable")
        grid, sizes, owner = np.ascontiguousarray(grid[order].T), sizes[order], owner[order]
        alive = np.searchsorted(-sizes, -np.arange(BLOCK), side="left")  # blocks longer than each place
        out = np.zeros((len(batch), len(self.names)))
        for k, table_ in enumerate(self.tables()):
            state, count = np.zeros(len(owner), np.int32), np.zeros(len(owner), np.int32)
            for place in range(BLOCK):
                n = alive[place]
                if not n:
                    break
                step = table_.take(state[:n] + grid[place, :n])
                count[:n] += step >> 30
                state[:n] = step & (_MARK - 1)
            out[:, k] = np.bincount(owner, count, len(batch))
        return out

    def predict(self, batch: list[str]) -> tuple[list[str], list[float]]:
        points = [normalise(t) for t in batch]
        has = [bool(len(p)) for p in points]
        if not self.names:
            return ["und"] * len(batch), [0.0] * len(batch)
        cost = self.phrases(points) * self.bits
        best = cost.argmin(axis=1)
        least = cost.min(axis=1)
        second = np.partition(cost, 1, axis=1)[:, 1] if len(self.names) > 1 else np.full(len(batch), np.inf)
        score = 1 - np.divide(least, second, out=np.ones(len(batch)), where=second > 0)
        names = [self.names[i] if h else "und" for i, h in zip(best.tolist(), has)]
        return names, [float(s) if h else 0.0 for s, h in zip(np.clip(score, 0, 1), has)]


def references(
    docs: DataFrame, key: str, text: str, lang: str, pieces: int = PIECES, piece: int = PIECE, total: int = TOTAL
) -> dict[str, str]:
    """Reference text per language, from what may be learned."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.crc32(F.col("id").cast("string")) % 4 != 2)
    rows = rows.where("text is not null and lang is not null")
    # Two longs per language and slice: one document each, whatever the size of the language.
    hashed = F.xxhash64("id")
    chosen = rows.groupBy("lang", F.pmod(hashed, F.lit(pieces)).alias("part")).agg(F.min_by("id", hashed).alias("id"))
    picked = rows.join(F.broadcast(chosen.select("lang", "id")), ["lang", "id"])
    held = picked.select("lang", "id", F.substring("text", 1, piece).alias("t")).distinct().orderBy("lang", "id", "t").collect()
    parts: dict[str, list[str]] = {}
    for row in held:
        parts.setdefault(row["lang"], []).append(row["t"])
    share = total // max(1, len(parts))
    return {name: " ".join(p)[:share] for name, p in parts.items()}


def identify(
    docs: DataFrame, languages: Languages, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of every row, from its text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(languages)  # about 40 bytes a reference character

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                names, scores = sent.value.predict(texts(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
                )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double")


def op2_language(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    languages = Languages(references(docs, "doc_id", "text", "lang"))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False))
    return identify(docs, languages).select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score")
