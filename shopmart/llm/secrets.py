"""Secret scans: exact patterns, and values in credential contexts that are hard to guess.

The base kinds are patterns with a length rule. The method adds kind ``guess``:
the value after a credential word and a separator ("pwd: ...", "passphrase is
...") if guessing it costs at least 10**MIN_LOG10 tries. The cost is that of the
cheapest way to cut the value into words (rank in the list), dates (days in the
years 1900 to 2099), repeats (of one character or a group), keyboard walks
(starts, turns) and brute-force spans (10 tries a character), found by dynamic
programming over its places: costs multiply, and a way of k parts costs k! more.
Values that overlap a base span are not added again.

Words are those of the list below and, after them, at most 20,000 words of the
corpus ranked by how many documents have them (``dictionary``). Values after a
credential word are left out of that count, and so are words of fewer than
MIN_DOCUMENTS documents, or a secret would be its own dictionary word.

Defined cases: a null text is empty; a value longer than MAX_VALUE characters is
hard to guess if one of its windows of MAX_VALUE characters is, which half
overlap and cover all of it, so the time grows with its length; repeated rows get
equal results; empty tables give empty results; columns other than id and text
are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import meets, slices, table, texts
from shopmart.session import materialize

KINDS = ("assign", "access", "hex", "guess")
MIN_LOG10 = 10.0
MAX_VALUE = 64
MIN_DOCUMENTS = 3


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api")).replace(
    _either_case("api"), _either_case("api") + "_?" + _either_case("key")
)
_ASSIGN = re.compile(rf"""(?:{_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT_WORDS = ("password", "passwd", "passphrase", "passcode", "pass", "pwd", "pin", "secret", "token", "credentials", "credential", "bearer")
_CONTEXT = re.compile(
    rf"""(?<![A-Za-z])(?:{"|".join(_either_case(w) for w in _CONTEXT_WORDS)})["']?(?:\x20*[:=]\x20*|\x20+(?:is|was)\x20+)["']?([^\s"'<>]+)"""
)
#: The same values for Java's patterns.
_VALUES = (
    rf"""(?:(?:{_KEYWORDS})["']?\x20*[:=]|(?<![A-Za-z])(?:{"|".join(_either_case(w) for w in _CONTEXT_WORDS)})["']?"""
    r"""(?:\x20*[:=]|\x20+(?:is|was)\x20))\x20*["']?[^\s"'<>]+"""
)
#: Any match of the patterns holds one of these.
_HINTS = ("pass", "pwd", "pin", "secret", "token", "api", "credential", "bearer")

#: Very common passwords and parts of them, most common first.
COMMON = (
    "password", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "iloveyou", "master", "sunshine",
    "princess", "football", "baseball", "shadow", "login", "abc", "secret", "test", "user", "root", "pass", "hello",
    "freedom", "whatever", "trustno", "love", "summer", "winter", "spring", "autumn", "changeme", "default", "guest",
    "server", "access", "token", "key", "my", "the", "is", "new", "home", "work", "example", "sample", "null", "none",
)
_KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")


def _neighbours() -> dict[str, set[str]]:
    place = {c: (r, k) for r, row in enumerate(_KEYBOARD) for k, c in enumerate(row)}
    return {
        c: {d for d, (r2, k2) in place.items() if d != c and abs(r2 - r) <= 1 and abs(k2 - k) <= 1} for c, (r, k) in place.items()
    }


_NEAR = _neighbours()
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
_LEET = str.maketrans("430157$@", "aeoist" + "sa")


class Ranks(dict):
    """Words with their rank, and the length of the longest."""

    def __init__(self, ranks: dict[str, int]) -> None:
        super().__init__(ranks)
        self.longest = max(map(len, ranks), default=0)


def guess_cost(value: str, ranks: dict[str, int] | None = None) -> float:
    """log10 of the tries of the cheapest segmentation. The time grows with the square of the length."""
    ranks = ranks if isinstance(ranks, Ranks) else Ranks(ranks or _COMMON_RANKS)
    n, low = len(value), value.lower()
    plain = low.translate(_LEET)
    spans: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by end: (start, log10)
    for i in range(n):
        for j in range(i + 2, min(n, i + ranks.longest) + 1):
            rank = ranks.get(low[i:j]) or ranks.get(plain[i:j])
            if rank:
                cost = math.log10(rank + 1)
                cost += math.log10(2) * (value[i:j] != low[i:j]) + math.log10(2) * (low[i:j] not in ranks)
                spans[j].append((i, cost))
        match = _DATE.match(value, i)
        if match:
            years = 200
            spans[match.end()].append((i, math.log10(years * (1 if match.end() - i == 4 else 365))))
        j = i + 1
        turns, step = 0, None
        while j < n and low[j] in _NEAR.get(low[j - 1], ()):
            move = ord(low[j]) - ord(low[j - 1])
            turns, step = turns + (move != step), move
            j += 1
            if j - i >= 3:
                spans[j].append((i, math.log10(47 * (j - i)) + min(turns, 4) * 0.5))
        j = i + 1
        while j < n and ord(value[j]) - ord(value[j - 1]) in (1, -1) and ord(value[j]) - ord(value[j - 1]) == ord(value[i + 1]) - ord(value[i]):
            j += 1
            if j - i >= 3:
                spans[j].append((i, math.log10(26 * (j - i))))
        for group in range(1, min(8, (n - i) // 2) + 1):
            times = 1
            while value[i + times * group : i + (times + 1) * group] == value[i : i + group]:
                times += 1
                if times * group >= 3:
                    spans[i + times * group].append((i, group * 1.3 + math.log10(times)))
    # best[k][j]: cheapest way to cut the first j characters into k parts.
    best = [[math.inf] * (n + 1) for _ in range(n + 1)]
    best[0][0] = 0.0
    for j in range(1, n + 1):
        options = spans[j] + [(i, float(j - i)) for i in range(j)]
        for k in range(1, min(j, 8) + 1):
            best[k][j] = min(best[k - 1][i] + cost for i, cost in options)
    return min((best[k][n] + math.log10(math.factorial(k)) for k in range(1, min(n, 8) + 1)), default=0.0)


_COMMON_RANKS = Ranks({w: i + 1 for i, w in enumerate(COMMON)})


def hard_to_guess(value: str, min_log10: float = MIN_LOG10, ranks: dict[str, int] | None = None) -> bool:
    """Does the value, or a window of a long one, cost at least 10**min_log10 tries?"""
    step = MAX_VALUE // 2
    windows = dict.fromkeys(value[i : i + MAX_VALUE] for i in range(0, max(1, len(value) - step), step))
    return any(guess_cost(w, ranks) >= min_log10 for w in windows)


def find_secrets(text: str, min_log10: float = MIN_LOG10, ranks: dict[str, int] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order."""
    spans = [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    low = text.lower()
    if any(h in low for h in _HINTS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
        taken = meets((s, e) for s, _, e in spans)
        for m in _CONTEXT.finditer(text):
            start, value = m.start(1), m.group(1).rstrip(".,;:!?)")
            end = start + len(value)
            if len(value) >= 6 and not taken(start, end) and hard_to_guess(value, min_log10, ranks):
                spans.append((start, 3, end))
    return sorted(spans)


def corpus_words(docs: DataFrame, text: str = "text", most: int = 20_000, least: int = 1) -> dict[str, int]:
    """The ``most`` words in the most documents, at least ``least``, with their rank; a bounded dictionary for ``guess_cost``."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"))).alias("word"))
    counted = words.where(F.length("word") >= 3).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    # Written first: each task that sorts sends ``most`` rows to the driver, so a few of them sort.
    counted = materialize(counted, "secret-words").coalesce(8)
    return {r["word"]: i + 1 for i, r in enumerate(counted.orderBy(F.desc("n"), "word").limit(most).collect())}


def dictionary(docs: DataFrame, text: str = "text", least: int = MIN_DOCUMENTS) -> Ranks:
    """The list, then the words of all documents outside of values after a credential word."""
    hinted = F.lower(text).rlike("|".join(_HINTS))
    prose = docs.select(F.when(hinted, F.regexp_replace(text, _VALUES, " ")).otherwise(F.col(text)).alias("text"))
    ranks = dict(_COMMON_RANKS)
    for word in corpus_words(prose, least=least):
        ranks.setdefault(word, len(ranks) + 1)
    return Ranks(ranks)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: dict[str, int] | None = None) -> DataFrame:
    """(id, spans) of every row, spans as an array of (start, kind, end) in code points."""
    kind = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # at most the list and 20,000 words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = [[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in find_secrets(t, ranks=sent.value)] for t in texts(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(kind))], ["id", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, spans array<struct<start:int,kind:string,end:int>>")


def op8_secrets(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = scan(docs, ranks=dictionary(docs))
    base = F.filter("spans", lambda x: x["kind"] != "guess")
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS[:3]]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
