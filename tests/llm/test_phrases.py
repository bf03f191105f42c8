"""Phrase mining against SQL and a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from shopmart.llm import phrases
from shopmart.llm.registry import run

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, phrase string, shard int, n int, `start` int"
FOLD = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows, most=5):
    counts = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            words = re.findall(r"[^ \t]+", piece)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", " ".join(words[i : i + size]), size] += 1
    return counts


def corpus(seed, documents=120):
    rng = random.Random(seed)
    common = [["New", "york", "City"], ["a", "b", "a", "b", "a"], ["ein", "É\x1c", "\xa0x"], ["long", "phrase", "of", "five", "words"]]
    rows = []
    for i in range(documents):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += rng.choice(common) if rng.random() < 0.4 else [rng.choice("the of and x y z Q".split())]
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    # One word that becomes frequent in the last rows only, one hot repeated text.
    rows += [("late bird", "en")] * 6 + [("go go go go go go go", "en")] * 40
    return rows + [("", "en"), (None, "en"), (None, None), (" \t ", "de"), ("only", "fr"), ("w " * 2_000, "es")]


@pytest.mark.parametrize("shards, cell_bits, min_count", [(1, 24, 5), (3, 24, 5), (4, 12, 20), (5, 2, 5), (2, 0, 60)])
def test_counts_are_exact_whatever_the_shards_and_the_filter(spark, shards, cell_bits, min_count):
    rows = corpus(shards)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found, totals = phrases.frequent_phrases(frame, min_count=min_count, shards=shards, cell_bits=cell_bits)
    counts = brute_counts(rows)
    want = sorted((*key, n) for key, n in counts.items() if n >= min_count)
    assert sorted(tuple(r) for r in found.collect()) == want
    words = Counter()
    for (lang, _, size), n in counts.items():
        words[lang] += n if size == 1 else 0
    assert {r["lang"]: r["n_words"] for r in totals.collect()} == words


def test_a_phrase_is_counted_for_one_cycle_from_its_activation():
    reached = phrases.Reached(16)
    texts = ["a b c. a b d"]

    def counted(step):
        found = phrases.count_phrases(phrases.Slice("en", texts), reached, step, 3, 5)
        return {(p, s): n for names, _, starts, counts in found for p, s, n in zip(names.to_pylist(), starts.tolist(), counts.tolist())}

    assert counted(0) == {("a", 0): 2, ("b", 0): 2, ("c", 0): 1, ("d", 0): 1}
    a, b = phrases.word_hashes("en", [b"a", b"b"])
    for word, step in ((a, 0), (b, 1)):
        reached.set(np.concatenate(phrases.cells_of(np.array([word]), 1 << 16)), step)
    assert [counted(t).get(("a b", 2)) for t in (2, 3, 4, 5)] == [2, 2, 2, None]
    assert set(counted(4)) == {("a b", 2)}
    # Set again by another phrase, a cell keeps its first step.
    reached.set(np.concatenate(phrases.cells_of(np.array([b]), 1 << 16)), 3)
    assert reached.steps(np.array([b]))[0] == 1


def test_a_key_holds_all_of_a_phrase(spark):
    """Counts are shuffled by one string, whatever is in the language or the phrase."""
    rows = []
    for lang in ("en", "", "e\nn\n001002x", " 001"):
        words = pa.array(["a", "002 b", "\xa0\x1c", "a"], pa.large_string())
        keys = phrases.keys_of(words, 2, np.array([0, 3, 12, 255]), lang)
        rows += [(key, n) for n, key in enumerate(keys.to_pylist())]
    got = phrases._named(spark.createDataFrame(rows, phrases._COUNTS)).collect()
    want = [(lang, p, 2, start, n) for lang in ("en", "", "e\nn\n001002x", " 001")
            for n, (p, start) in enumerate(zip(words.to_pylist(), (0, 3, 12, 255)))]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_what_is_left_for_longer_phrases():
    reached = phrases.Reached(20)
    words = [b"a", b"b", b"c", b"x"]
    hashes = dict(zip("abcx", phrases.word_hashes("en", words)))
    for phrase in ("a", "b", "c", "x", "a b", "b c", "c a"):
        first, *rest = phrase.split()
        total = np.array([hashes[first]])
        for word in rest:
            total = phrases.longer_hashes(total, hashes[word])
        reached.set(np.concatenate(phrases.cells_of(total, 1 << 20)), 0)
    part = phrases.Slice("en", ["a b x b c. a B C a rare a b", " ", "c a b, c a", "a b a b c"])
    assert phrases.frequent_stretches(part, reached).split(" \n") == ["a b c a", " c a b", " a b c", ""]
    assert phrases.frequent_stretches(phrases.Slice("en", ["", "rare"]), reached) == ""


def duck(folder):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from read_parquet('{folder}')")
    result = connection.execute(phrases.OP12_SQL)
    return [c[0] for c in result.description], sorted(map(repr, result.fetchall()))


def test_query_matches_sql_on_odd_rows(spark, tmp_path):
    rows = [(i, text, lang) for i, (text, lang) in enumerate(corpus(9, 900))]
    rows += [(None, "null id. null id", "en"), (3, "same id", "en"), (3, "same id", "en")]
    frame = spark.createDataFrame([(*r, "s", 1, "p", 2, 3, 4) for r in rows], FIELDS)
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = run("op12_phrases", spark, str(tmp_path))
    names, want = duck(f"{tmp_path}/documents.parquet/*.parquet")
    assert len(want) > 30
    assert sorted(repr(tuple(r[n] for n in names)) for r in got.collect()) == want


def test_scores_beyond_64_bits(spark):
    a, n = 10**12, 10**15
    counts = [("en", "x y z", 3, a), ("en", "x y", 2, a + 1), ("en", "y z", 2, a + 2)]
    counts += [("en", w, 1, a + 10 * k) for k, w in enumerate("xyz", 1)]
    found = phrases.collocations(
        spark.createDataFrame(counts, "lang string, phrase string, size int, n long"),
        spark.createDataFrame([("en", n)], "lang string, n_words long"),
    ).collect()
    by_phrase = {r["phrase"]: r for r in found}
    cuts = [(1000 * a * n // ((a + 10) * (a + 2)), 1), (1000 * a * n // ((a + 1) * (a + 30)), 2)]
    assert by_phrase["x y z"]["score"] == min(cuts)[0]
    assert by_phrase["x y"]["score"] == 1000 * (a + 1) * n // ((a + 10) * (a + 20))
    assert sorted(r["rank"] for r in found) == [1, 2, 3]


def test_the_first_of_many_phrases(spark):
    counts = [("en", w, 1, 200) for w in "abcdefghij"]
    counts += [("en", f"{x} {y}", 2, 100 + 7 * i) for i, (x, y) in enumerate(zip("abcdefghi", "bcdefghij"))]
    frequent = spark.createDataFrame(counts, "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", 5000)], "lang string, n_words long")
    got = phrases.collocations(frequent, totals, top=3).orderBy("rank").collect()
    assert [(r["rank"], r["phrase"]) for r in got] == [(1, "i j"), (2, "h i"), (3, "g h")]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], FIELDS).write.parquet(f"{tmp_path}/documents.parquet")
    assert run("op12_phrases", spark, str(tmp_path)).collect() == []


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables not present")
def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = run("op12_phrases", spark, folder)
    names, want = duck(f"{folder}/documents.parquet")
    assert sorted(repr(tuple(r[n] for n in names)) for r in got.collect()) == want
