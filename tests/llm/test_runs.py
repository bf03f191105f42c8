"""Periodic runs against a brute-force search for every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shopmart.llm import runs
from shopmart.llm.registry import run

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, key string, n_words int, collapsed string"


def brute_runs(words, least=0):
    """Every stretch of smallest period q and at least 4 q words that cannot be widened."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            if j > i and len(stretch) >= max(least, 4 * q):
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, len(stretch), q))
            i = j + 1
    return sorted(found)


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, 6)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(found),
        start,
        length,
        period,
        None if length is None else 1000 * length // period,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def nested(rng, depth, letters):
    if not depth:
        return [rng.choice(letters) for _ in range(rng.randint(1, 5))]
    words = nested(rng, depth - 1, letters)
    if rng.random() < 0.5:
        words = words * rng.randint(2, 7)
    if rng.random() < 0.6:
        words = words + nested(rng, depth - 1, letters)
    return words[: rng.randint(0, 300)] if rng.random() < 0.3 else words[:300]


def numbered(documents):
    return runs.number_words([[w.encode() for w in d] for d in documents])


def test_runs_of_nested_repeats():
    rng = random.Random(5)
    seen = 0
    for _ in range(150):
        documents = [nested(rng, rng.randint(0, 5), "abcdefgh"[: rng.randint(1, 5)]) for _ in range(rng.randint(1, 6))]
        want, base = [], 0
        for words in documents:
            want += [(base + s, n, q) for s, n, q in brute_runs(words)]
            base += len(words)
        assert runs.find_runs(*numbered(documents)) == sorted(want)
        seen += len(want)
    assert seen > 1000


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=3))
def test_runs_of_two_letters(documents):
    want, base = [], 0
    for words in documents:
        want += [(base + s, n, q) for s, n, q in brute_runs(words)]
        base += len(words)
    assert runs.find_runs(*numbered(documents)) == sorted(want)


def test_long_periods_and_long_runs():
    rng = np.random.default_rng(0)
    block = rng.integers(0, 1000, 12_345)
    ids = np.concatenate([np.full(50_000, 7), [1], np.tile(block, 5)[:-17], [2_000]]).astype(np.int64)
    found = runs.find_runs(ids, np.array([len(ids)]))
    assert (0, 50_000, 1) in found and (50_001, 5 * 12_345 - 17, 12_345) in found


def test_equal_documents_do_not_meet():
    words = "a b c d".split()
    assert runs.find_runs(*numbered([words] * 8)) == []


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    texts = [" ".join(nested(rng, 5, ["x", "yy", "Z", "é", "中", "1"])) for _ in range(150)]
    texts += ["", None, " \t\n\x0b\f\r ", "a a a a\x1c", "one", "w " * 3000, "s\tt\n" * 2000, "\x85 " * 9]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b " * 8), (3, texts[3]), (3, "c " * 7), (-5, "d e " * 20)]
    frame = spark.createDataFrame([(*r, "en", "s", 1, "k", 2, "c") for r in rows], FIELDS)
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = run("op13_runs", spark, str(tmp_path))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert got.columns == names
    want = [brute_row(*r) for r in rows]
    assert any(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in want)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], FIELDS).write.parquet(f"{tmp_path}/documents.parquet")
    assert run("op13_runs", spark, str(tmp_path)).collect() == []


def test_runs_and_collapsed_text_of_the_operator(spark):
    frame = spark.createDataFrame([(1, "go go go go go go now")], "doc_id long, text string")
    row = runs.periodic_runs(frame).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 6, 1)] and row["collapsed"] == "go now" and row["n_words"] == 7
    assert runs.periodic_runs(frame, min_words=7).first()["runs"] == []
