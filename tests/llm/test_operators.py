"""Every operator against a plain second version, and on the cases its docstring defines."""

from __future__ import annotations

import io
import math
import re
import struct
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopmart.llm import common, decontaminate, html_text, language, mixing, pii, quality, secrets, simhash, tokens, toxicity
from shopmart.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, fp long, `size` int"
LONG = "the quick brown fox jumps over a lazy dog and runs. " * 2000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, long and repeated texts, repeated ids, clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
        (2, "", "en", "a", 0),
        (3, None, None, None, None),
        (None, "a text without an id, and with words", "fr", "b", 3),
        (4, LONG, "en", "b", 5),
        (5, " \t\n\x0b\f\r ", "xx", "c", 6),
        (6, "éàü ñ 中文 <|endoftext|> a  b \n c", "fr", None, 7),
        (7, "1234567890 !!", "de", "c", 8),
    ]
    return spark.createDataFrame([(*r, "r", 0.5, 9, 3) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_mixing_targets_and_cases(spark, odd, empty):
    assert mixing.mix(empty).count() == 0
    got = mixing.mix(odd).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(got) == odd.count()
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert all(r["copies"] == 1 for r in got if r["size"] == 0)
    again = mixing.mix(odd).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    rows = [(i, "w " * (1 + i * 7 % 40), "abc"[i % 3] if i % 5 else None) for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = got.select("row.source", "size", "target", "copies").collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        targets[r["source"]] = r["target"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.allocate([sizes[s] for s in order], [5, 2, 1, 5], 3)
    assert [targets[s] for s in order] == pytest.approx(want)
    assert sum(want) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - targets[s]) <= 40 for s in order)


def test_rates_solve_the_dual():
    sizes, counts = np.array([1.0, 5, 20, 80]), np.array([10.0, 8, 5, 2])
    for share in (0.05, 0.7, 1.0, 2.4, 3.0):
        target = share * (sizes * counts).sum()
        rates = mixing.solve_rates(sizes, counts, target, 3)
        assert (sizes * counts * rates).sum() == pytest.approx(target)
        assert ((rates >= 0) & (rates <= 3 + 1e-9)).all()
        inner = (rates < 2.999) & (rates > 1e-12)
        slopes = np.log(rates[inner]) / sizes[inner]
        assert np.allclose(slopes, slopes[0] if len(slopes) else 0)


def _fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd, empty):
    assert simhash.near_duplicates(empty).count() == 0
    got = simhash.near_duplicates(odd).collect()
    text = {r["doc_id"]: r["text"] for r in odd.collect()}
    assert len(got) == odd.count()
    for r in got:
        assert r["fp"] & (2**64 - 1) == _fingerprint(text[r["id"]])
    assert {r["component"] for r in got if r["id"] in (2, 3, 5)} == {2}


def test_links_are_all_pairs_within_three_bits(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = set(base.tolist())
    for v in base.tolist():
        for n in (1, 2, 3, 4):
            values.add(v ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)))
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    for bits in (0, 1, 2, 3):
        want = {
            (min(a, b), max(a, b))
            for i, a in enumerate(signed)
            for b in signed[i + 1 :]
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits
        }
        assert {(r["a"], r["b"]) for r in simhash.links(frame, bits).collect()} == want
    with pytest.raises(ValueError):
        simhash.links(frame, 4)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    root = {r["node"]: r["root"] for r in got}
    assert len({root[i] for i in range(61)}) == 1 and len({root[i] for i in (100, 101, 102)}) == 1
    assert root[0] != root[100]


pieces = st.sampled_from(["a", "the", "'s", " ", "  ", "\n", "\t", "é", "中", "12", "#", "<|endoftext|>", " ", ".", "Ab"])


marks = st.sampled_from([*".,;:!?'\"-_()", "'s", "'ll", "a", "Wort", "é", "ÿ", "×", "÷", "ª", "²", "½", "ǅ", "ɏ", "ɐ", "я", "中", "e\u0301", "7", " ", "  ", "\n", "…", "🙂"])


@settings(max_examples=300, deadline=None)
@given(st.lists(marks, max_size=24).map("".join))
def test_words_and_marks_are_encoded_as_by_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    (ids,) = tokens.encoder_of(path).encode([text])
    assert ids.tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 2]


def _held_mb():
    text = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", text))) / 1024


def test_a_worker_holds_little_between_tasks():
    """What the pipeline's next stages would have to share an executor with."""
    import public_tokenizers

    name = public_tokenizers.path("byte_bpe_50k.json")
    encoder = tokens.Encoder(name, rested=1_000)
    common.give_back()
    began = _held_mb()
    rows = [" ".join(f"w{i}x{k}" for i in range(4_000)) for k in range(100)]
    want = [ids.tolist() for ids in encoder.encode(rows[:1])]
    encoder.encode(rows)
    encoder.rest()
    common.give_back()
    assert len(encoder.known) <= 1_000 and not encoder.old
    assert _held_mb() - began < 60
    assert [ids.tolist() for ids in encoder.encode(rows[:1])] == want



@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(pieces, max_size=20).map("".join), max_size=4))
def test_encoder_equals_the_library(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    global _ENCODER
    if "_ENCODER" not in globals():
        name = public_tokenizers.path("byte_bpe_50k.json")
        _ENCODER = tokens.Encoder(name), Tokenizer.from_file(name)
    own, library = _ENCODER
    assert [a.tolist() for a in own.encode(rows)] == [library.encode(t, add_special_tokens=False).ids + [2] for t in rows]


class _Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_shard_round_trip(planes):
    rng = np.random.default_rng(2)
    docs = [(i if i % 3 else None, rng.integers(0, 70_000, n).astype("<u4")) for i, n in enumerate([0, 1, 65_535, 3, 200_000, 7])]

    class Sink(io.BytesIO):
        def close(self):
            pass

    sink = Sink()
    writer = tokens.ShardWriter(sink, planes)
    for key, ids in docs:
        writer.add(key, ids)
    writer.close()
    reader = tokens.ShardReader(_Bytes(sink.getvalue()))
    back = list(reader.documents())
    assert [k for k, _ in back] == [k for k, _ in docs]
    assert all((a == b).all() for (_, a), (_, b) in zip(back, docs))
    whole = np.concatenate([ids for _, ids in docs])
    assert (reader.block(2) == whole[2 * tokens.BLOCK : 3 * tokens.BLOCK]).all()
    assert struct.unpack("<q", sink.getvalue()[-8:])[0] == len(reader.index)


def test_token_files(spark, odd, empty):
    assert tokens.token_files(spark, empty).count() == 0
    got = sorted(tokens.token_files(spark, odd).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == 1


def _base_quality(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_base_and_cases(spark, odd, empty):
    assert quality.assess(empty).count() == 0
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = quality.assess(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert tuple(r[c] for c in columns) == _base_quality(r["row"]["text"])
    kept = quality.keep_good(spark, odd, "")
    assert kept.columns == odd.columns


def test_quality_distance(spark):
    rng = np.random.default_rng(3)
    words = np.array(["the", "of", "and", "to", "in"] + [f"w{i}" for i in range(200)])
    weights = np.r_[np.full(5, 0.1), np.full(200, 0.5 / 200)]
    rows = [(i, " ".join(rng.choice(words, 120, p=weights)), "en") for i in range(60)]
    rows.append((100, " ".join("#%d%%" % i for i in range(150)), "en"))
    rows.append((101, " ".join(rng.choice(words, 120, p=weights)), None))
    got = {r["row"]["doc_id"]: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert all(got[i]["kept"] for i in [*range(60), 101])
    p, q = np.array([0.2, 0.8, 0.0]), np.array([0.5, 0.25, 0.25])
    m = (p + q) / 2
    want = math.sqrt(sum(a * math.log2(a / b) / 2 for x in (p, q) for a, b in zip(x, m) if a))
    frame = spark.createDataFrame([(p.tolist(), q.tolist())], "p array<double>, q array<double>")
    assert frame.select(quality.js_distance(frame.p, frame.q)).first()[0] == pytest.approx(want)


def test_one_row_of_each_group_stays(spark):
    """Ids that are repeated or null: rows are kept, not ids."""
    rng = np.random.default_rng(6)
    a, b, c, d = (" ".join(f"w{k}" for k in rng.integers(0, 10**6, 60)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (2, c), (3, b), *[(None, d)] * 50, (None, a), (4, c.upper())]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, place string")
    got = simhash.keep_first(spark, frame, "")
    assert got.columns == frame.columns
    assert sorted(got.select("text", "doc_id").collect()) == sorted([(a, 1), (b, 2), (c, 2), (d, None)])


@pytest.mark.parametrize("most", [1000, 0])
def test_quality_of_small_languages(spark, monkeypatch, most):
    """Clean texts of another script stay, also beside a big language; null has a reference."""
    monkeypatch.setattr(quality, "MAX_BROADCAST", most, raising=False)
    rng = np.random.default_rng(4)

    def clean(letters):
        words = np.array(["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(150)])
        weights = np.r_[np.full(5, 0.1), np.full(145, 0.5 / 145)]
        return lambda n=150: " ".join(rng.choice(words, n, p=weights))

    latin, russian, greek = clean("abcdefghijklm"), clean("абвгдежзиклмн"), clean("αβγδεζηθ")
    junk = " ".join("#%d%%" % i for i in range(150))
    rows = [(i, latin(1000), "en") for i in range(200)] + [(1000 + i, russian(), "ru") for i in range(40)]
    rows += [(2000, greek(), "el"), (3000, junk, "ru")]
    rows += [(4000 + i, latin(), None) for i in range(40)] + [(5000, junk, None), (6000, russian(), None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality.assess(frame, quality.references(frame)).collect()
    assert {r["row"]["doc_id"] for r in got if not r["base_failed"] and not r["kept"]} == {3000, 5000}
    assert all((r["class_distance"] is None) == (r["row"]["doc_id"] in (2000, 6000)) for r in got)
    alone = quality.assess(frame.where("lang is null").withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["row"]["doc_id"] for r in alone if not r["kept"]} == {5000}


def _phrases(text, reference):
    points = "".join(chr(c) for c in language.normalise(text))
    reference = "".join(chr(c) for c in language.normalise(reference))
    n = 0
    for at in range(0, len(points), language.BLOCK):
        block, i = points[at : at + language.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j < len(block) and block[i:j] in reference and block[i : j + 1] in reference:
                j += 1
            i, n = j, n + 1
    return n


def test_cross_parsing_equals_brute_force():
    references = {"en": "the cat sat on the mat and ate the rat", "de": "die katze sass auf der matte", "fr": "le chat é"}
    own = language.Languages(references)
    batch = ["the mat sat", "die matte", "é chat zz 12 the", "", "x" * 600, "the cat " * 90]
    got = own.phrases([language.normalise(t) for t in batch])
    assert got.tolist() == [[_phrases(t, references[n]) for n in own.names] for t in batch]
    assert own.predict(["der 12 katze", "", "12 !", None or ""])[0] == ["de", "und", "und", "und"]


def test_language_cases(spark, odd, empty):
    own = language.Languages(language.references(odd, "doc_id", "text", "lang"))
    got = {r["id"]: r for r in language.identify(odd, own).collect()}
    assert got[3]["lang_pred"] == got[2]["lang_pred"] == got[7]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = language.Languages(language.references(empty, "doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}


def test_pages():
    field = html_text.Field().fit(html_text.labelled_layouts(30))
    wrong = total = 0
    for blocks in html_text.labelled_layouts(60)[30:]:
        wrong += sum(a != b.main for a, b in zip(field.decode(blocks), blocks))
        total += len(blocks)
    assert wrong <= 0.02 * total
    page = "<nav><a href=x>Home</a></nav><article><h1>A  title</h1><p>One &amp; two,<br>three is here.<p>Four &am</article><footer>&copy; x</footer"
    assert field.extract(page) == "A title\nOne & two, three is here.\nFour &am"
    assert field.extract("") == ""


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p>a</p><svg-icon name="x"></svg-icon><article><p>b</p></article>', ["a", "b"]),
        ("<button-group><p>a</p></button-group><select-box/><p>b</p>", ["a", "b"]),
        ('<p>a <svg class="i"/> b</p><p>c</p>', ["a b", "c"]),
        ("<p>a <svg><g><title>t</title><path d='m'/></g></svg> b</p><p>c</p>", ["a b", "c"]),
        ("<p>a <button>no <b>way</b></button> b</p>c", ["a b", "c"]),
        ("<div><button>no</div><article><p>b</p></article>", ["b"]),
        ("<div>a<button>no</div>b<p>c <svg><path></p>d", ["a", "b", "c", "d"]),
        ("<body>a<button>no<article><p>b</p></article><button>no</button><p>c</p></body>", ["a", "b", "c"]),
        ("<div><select><option>no<option>no</div><p>b</p><select><option>no</select><p>c</p>", ["b", "c"]),
        ("<noscript><p>no</p></noscript><p>b</p><noscript>no<p>c</p>", ["b", "c"]),
        ("<template><div><p>no</p></div></template>b", ["b"]),
        ("<p>a</p><script>no</script ><style>no</style><textarea><p>no</p></textarea><p>b</p><iframe>no", ["a", "b"]),
    ],
)
def test_text_around_hidden_elements(page, want):
    assert [b.text for b in html_text.leaf_blocks(page)] == want


def test_page_table(spark):
    schema = "page_id long, url string, html string, text string, id int"
    rows = [(1, None, None, "t", 1), (2, "u", "", "t", 1), (None, "u", "<article><p>Some text here. It goes on.</article>", "t", 1)]
    frame = spark.createDataFrame(rows, schema)
    got = html_text.extract(frame, html_text.train(frame)).collect()
    assert [(r["id"], r["text"]) for r in got] == [(1, ""), (2, ""), (None, "Some text here. It goes on.")]
    none = spark.createDataFrame([], schema)
    assert html_text.extract(none, html_text.train(none)).count() == 0


_LUHN = {"4111111111111111": True, "4111111111111112": False}
bits = st.sampled_from(["a.b", "@", "x@y.com", "1.2.3.4", "999.1.1.1", " ", "-", "4111111111111111", "4111111111111112", "+1 (555) 010-1234", "+", "5", ".", "é", "token", "=", '"', "abcdef0123456789abcdef0123", "AKIA", "ABCDEFGH12345678", "PassWD: ", "api_key"])


@settings(max_examples=300, deadline=None)
@given(st.lists(bits, max_size=14).map("".join))
def test_base_spans_equal_the_patterns(text):
    want = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            want.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            want.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            want.append((3, m.start(), m.end()))
    assert pii.base_spans(text) == want
    assert all(pii.luhn(d) == ok for d, ok in _LUHN.items())
    want = []
    for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            want.append((m.start(), 0, m.end()))
    want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    assert [s for s in secrets.find_secrets(text) if s[1] < 3] == sorted(want)


def test_spans_in_very_long_texts():
    taken = [(0, 4), (2, 3), (10, 12), (11, 20)]
    asked = [(4, 6), (6, 11), (15, 16), (20, 22)]
    overlaps = common.meets(taken)
    assert [overlaps(*a) for a in asked] == [any(s < a[1] and a[0] < e for s, e in taken) for a in asked]
    zeros = "0" * 6000
    assert pii.base_spans(f"{zeros}1.2.3.4 {zeros}.1.1.999") == [(1, 0, 6007)]
    text = "x@y.org Dr. Smith, pwd: kX9v2LqP7zRt 1.2.3.4 " * 20_000
    base = pii.base_spans(text)
    assert len(base) == 40_000 and len(pii.candidates(text, base)) == 20_000
    assert len(secrets.find_secrets(text)) == 20_000


def test_pii_votes_and_table(spark, odd, empty):
    votes = np.array([[1, 1, 1], [1, 1, 0], [-1, -1, 0], [-1, -1, -1]])
    posterior, _, share = pii.reliabilities(votes, np.array([30.0, 10, 30, 30]))
    assert (posterior[:2] > 0.9).all() and (posterior[2:] < 0.1).all() and 0.3 < share < 0.5
    assert pii.find(empty).count() == 0
    texts = [(i, "Call Dr. Smith on 212-555-0147 or write x@y.org", None) for i in range(20)] + [(99, "order 000-12-0000 total", None)]
    got = {r["id"]: [s["kind"] for s in r["spans"]] for r in pii.find(spark.createDataFrame(texts, "doc_id long, text string, x string")).collect()}
    assert got[0][0] == "email" and "name" in got[0]
    assert pii.find(odd).count() == odd.count()


def test_guess_cost(spark, odd, empty):
    easy = ["password", "qwertyuiop", "aaaaaaaaaaaa", "19991231", "abcdefgh", "Password2020", "abcabcabc"]
    assert all(secrets.guess_cost(v) < secrets.MIN_LOG10 for v in easy)
    assert secrets.guess_cost("kX9v2LqP7zRt") >= secrets.MIN_LOG10
    assert secrets.guess_cost("kx9") == pytest.approx(3.0)
    found = secrets.find_secrets("the pwd is kX9v2LqP7zRt, the pin: password")
    assert [("guess", found[0][0], found[0][2])] == [("guess", 11, 23)] and len(found) == 1
    # Whole values count: hard at the end of a long easy one, and never so far without an end.
    assert secrets.find_secrets("pwd: " + "z" * 500 + "kX9v2LqP7zRt") == [(5, 3, 517)]
    assert secrets.find_secrets("pwd: " + "z" * 200_000) == []
    assert secrets.scan(empty).count() == 0 and secrets.scan(odd).count() == odd.count()
    # Eight words are in three rows each; ties go by the word.
    ranks = secrets.corpus_words(odd)
    assert ranks["brown"] == 1 and ranks["the"] == 8


def test_secrets_query_knows_words_of_the_corpus(spark, tmp_path):
    prose = "The documentation of umbrella and telescope, geschäftsführung"
    secret = "the secret is qhvzkwpjxmrt"  # many copies don't make it a word
    texts = [prose, prose, prose, "the secret is documentation", "passphrase: UmbrellaTelescope", "pwd was geschäftsführung", secret, secret, secret, secret]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["spans"] for r in secrets.op8_secrets(spark, str(tmp_path)).collect()}
    assert got == {k: "guess:14:26" if t == secret else "" for k, t in enumerate(texts)}


def test_toxicity(spark, odd, empty):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        words = list(rng.choice([f"word{chr(97 + k)}" for k in range(20)], 30)) + (["nastiest"] if bad and i % 8 else []) + (["foulestx"] if bad else [])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad and i % 8 != 0), int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frame = spark.createDataFrame(labels, "doc_id long, insult int, toxic int")
    chain = toxicity.train(docs, frame, {"insult": "insult", "toxic": "toxic"})
    got = {r["id"]: r["is_toxic"] for r in toxicity.score(docs, chain).collect()}
    assert all(got[i] == bool(t) for i, _, t in labels)
    none = toxicity.train(docs, frame.limit(0), {"toxic": "toxic"})
    assert {r["is_toxic"] for r in toxicity.score(odd, none).collect()} == {False}
    assert toxicity.score(empty, chain).count() == 0 and toxicity.score(odd, chain).count() == odd.count()


def _tile_brute(item, doc, n):
    free_i, free_d, covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k] and free_i[i + k] and free_d[d + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, d)
        if best[0] < n:
            return covered
        k, i, d = best
        free_i[i : i + k] = [False] * k
        free_d[d : d + k] = [False] * k
        covered += k


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=14), st.lists(st.sampled_from("abcdx"), max_size=40))
def test_tiling_equals_brute_force(item, doc):
    block = decontaminate.Benchmark([(9, " ".join(item))], 3)
    got = block.match([" ".join(doc), "z"], 0.01)
    n = min(3, len(item))
    want = _tile_brute(item, doc, n)
    assert ([g[3] for g in got] or [0]) == [want]


def test_decontamination(spark, odd, empty):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, None), (3, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, "x one two three four five six seven eight nine ten y", 0),
            (2, "six seven, eight nine ten. Then: One two three four five!", 0),
            (3, "one two three four five only", 0),
            (None, "one two three four five six seven eight nine ten", 0),
            (5, None, 0),
        ],
        "doc_id long, text string, item int",
    )
    got = decontaminate.overlaps(docs, items).collect()
    assert sorted((r["id"] or 0, r["tiles"], r["words"]) for r in got) == [(0, 1, 10), (1, 1, 10), (2, 2, 10)]
    assert decontaminate.overlaps(empty, items).count() == 0
    assert decontaminate.overlaps(odd, items.limit(0)).count() == 0
    blocks = list(decontaminate.blocks(items, 5, block_chars=10))
    assert sum(len(b.items) for b in blocks) == 1


def test_pipeline_keeps_columns(spark, tmp_path):
    import corpus_pipeline
    from shopmart.llm import registry

    rng = np.random.default_rng(5)
    words = np.array(["the", "of", "and", "to", "in"] + [f"w{i}" for i in range(500)])
    weights = np.r_[np.full(5, 0.1), np.full(500, 0.5 / 500)]
    text = [" ".join(rng.choice(words, 90, p=weights)) for _ in range(30)]
    passage = " ".join(f"item{k}" for k in range(12))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(text)]
    rows += [(100, text[0], "en", "s0", 1), (101, text[1] + " " + passage, "en", "s1", 1), (102, "short", "en", "s1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "token files":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), schema)
            seen.append(sorted(r["doc_id"] for r in docs.collect()))
    assert seen[0] == [*range(30), 100, 101]
    assert seen[1] == [*range(30), 101] and seen[2] == list(range(30))
    assert set(seen[3]) <= set(range(30))
    assert sorted(r["doc_id"] for r in out.collect()) == seen[3]
    assert "pipeline" in registry.queries()
