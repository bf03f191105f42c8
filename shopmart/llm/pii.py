"""Personal data: exact patterns, and spans that weak labellers agree on.

Base kinds are patterns with a rule; their spans always stay. The method looks at
further candidates: names after a title or a given name, national ids, bank
accounts, local phone numbers, user handles, and what the base rules dropped. On
each candidate labellers vote yes, no or not at all: its format (length, check
digits), a gazetteer of given names and titles, and context words before it.

Reliabilities of the labellers come from expectation-maximisation over the vote
patterns of all documents: patterns are counted by Spark (at most 3**5 of each
kind), so the driver sees counts only. The posteriors then label at most
``sample`` candidates, those of the smallest hash, for a logistic regression over
votes, kind and shape; its probability decides. Without candidates nothing is
added.

Defined cases: a null text is empty; candidates that overlap a base span are not
added; repeated rows get equal results and count as often as they occur; empty
tables give empty results; columns other than id and text are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import meets, slices, table, texts
from shopmart.session import materialize

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
PRIOR = 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs of digits start after another character: the first place decides for all of them.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TITLE = r"(?:Mr|Mrs|Ms|Dr|Prof)\.? "
#: Common given names.
GIVEN = (
    "James", "Mary", "Robert", "Patricia", "John", "Jennifer", "Michael", "Linda", "David", "Elizabeth", "William",
    "Susan", "Richard", "Joseph", "Thomas", "Sarah", "Anna", "Maria", "Peter", "Paul", "Hans", "Pierre", "Jean",
    "Carlos", "Juan", "Carmen", "Sophie", "Claire", "Klaus", "Ursula",
)
_CANDIDATES = re.compile(
    rf"(?P<name>\b(?:{_TITLE}|(?:{'|'.join(GIVEN)}) )[A-Z][a-z]+\b)"
    r"|(?P<national>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<account>\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b)"
    r"|(?P<local>(?<![0-9+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-]))"
    r"|(?P<handle>(?<![\w.@])@[A-Za-z][A-Za-z0-9_]{3,}\b)"
)
EXTRA = ("name", "national", "account", "local", "handle")
_CONTEXT = re.compile(r"(?i:\b(?:name|contact|call|phone|tel|mobile|fax|ssn|social security|iban|account|user|follow|signed|dear)\b)")
_AGAINST = re.compile(r"(?i:\b(?:order|invoice|part|version|isbn|figure|table|total)\b)")
VOTES = 5


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Linear: the part before @ is the run of its characters, not before the last match's end."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in order of kind and start."""
    spans = [(0, *s) for s in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]  # int() refuses thousands of digits
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def _account_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[str, int, int, list[int]]]:
    """(kind, start, end, votes): 1 yes, -1 no, 0 no vote, of the labellers
    format, gazetteer, words before, words before that speak against, shape.
    """
    found = []
    taken = meets((s, e) for _, s, e in base)
    for m in _CANDIDATES.finditer(text):
        kind, start, end = m.lastgroup, m.start(), m.end()
        if taken(start, end):
            continue
        value, before = m.group(), text[max(0, start - 40) : start]
        form = 0
        if kind == "national":
            form = 1 if value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000" else -1
        elif kind == "account":
            form = 1 if _account_ok(value) else -1
        elif kind == "local":
            form = 1 if value.strip("(")[0] not in "01" else -1
        listed = 0
        if kind == "name":
            first = value.split(" ")[0].rstrip(".")
            listed = 1 if first in GIVEN or first in ("Mr", "Mrs", "Ms", "Dr", "Prof") else -1
        votes = [form, listed, 1 if _CONTEXT.search(before) else 0, -1 if _AGAINST.search(before) else 0]
        digits = sum(c.isdigit() for c in value)
        votes.append((1 if len(set(value)) > 4 else -1) if digits else 0)
        found.append((kind, start, end, votes))
    return found


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns: P(vote | class) per labeller, and the share of yes.

    Returns the posterior of each pattern, the table [class, labeller, vote] and the share.
    """
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=-1).astype(float)
    posterior = np.clip(0.5 + 0.2 * patterns.sum(axis=1), 0.05, 0.95)
    tables, share = np.zeros((2, patterns.shape[1], 3)), PRIOR
    for _ in range(rounds):
        for c, weight in enumerate((1 - posterior, posterior)):
            tables[c] = np.einsum("p,plv->lv", weight * counts, onehot) + 0.5
            tables[c] /= tables[c].sum(axis=1, keepdims=True)
        share = float(np.clip((posterior * counts).sum() / counts.sum(), 0.02, 0.98))
        log = np.einsum("plv,clv->pc", onehot, np.log(tables)) + np.log([1 - share, share])
        posterior = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return posterior, tables, share


def _features(kind: str, value: str, votes: list[int]) -> list[float]:
    row = [1.0, *[float(v == s) for v in votes for s in (-1, 1)], *[float(kind == k) for k in EXTRA]]
    return [*row, len(value) / 20, sum(c.isdigit() for c in value) / max(1, len(value))]


def fit_classifier(x: np.ndarray, soft: np.ndarray, steps: int = 400) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights -= 0.5 * (x.T @ (p - soft) / len(x) + 1e-3 * weights)
    return weights


def _scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Base spans and all candidates of every row."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                out = []
                for t in texts(batch):
                    base = base_spans(t)
                    row = [{"kind": KINDS[k], "start": s, "end": e, "votes": None, "x": None} for k, s, e in base]
                    for kind, s, e, votes in sorted(candidates(t, base), key=lambda c: (EXTRA.index(c[0]), c[1])):
                        row.append({"kind": kind, "start": s, "end": e, "votes": votes, "x": _features(kind, t[s:e], votes)})
                    out.append(row)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.list_(span))], ["id", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, spans array<struct<kind:string,start:int,end:int,votes:array<int>,x:array<double>>>")


def train(found: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Weights of the span classifier from scanned rows, or None if there is no candidate."""
    seen = found.select(F.explode("spans").alias("s")).where("s.votes is not null")
    seen = materialize(seen.groupBy("s.votes", "s.x").agg(F.count("*").alias("n")), "pii-votes")
    patterns = seen.groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()  # at most 3**5
    if not patterns:
        return None
    posterior, _, _ = reliabilities(np.array([p["votes"] for p in patterns]), np.array([p["n"] for p in patterns], float))
    soft = {tuple(p["votes"]): q for p, q in zip(patterns, posterior.tolist())}
    rows = seen.orderBy(F.xxhash64("x"), "x").limit(sample).collect()
    return fit_classifier(np.array([r["x"] for r in rows]), np.array([soft[tuple(r["votes"])] for r in rows]))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) of every row: base kinds as listed, then the candidates the classifier takes.

    Texts are scanned once; their spans, written down, serve training and the decision.
    """
    found = materialize(_scan(docs, key, text), "pii-spans")
    weights = train(found)
    takes = lambda s: s["votes"].isNull()
    if weights is not None:
        constant = F.array(*[F.lit(w) for w in weights.tolist()])

        def takes(s: Column) -> Column:
            terms = F.zip_with(s["x"], constant, lambda x, w: x * w)
            return s["votes"].isNull() | (F.aggregate(terms, F.lit(0.0), lambda total, t: total + t) >= 0)

    return found.select("id", F.filter("spans", takes).alias("spans"))


def op7_pii(spark, folder: str) -> DataFrame:
    found = find(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["votes"].isNull())
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
