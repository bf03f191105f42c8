"""Quality rules: distance of a document's histograms to its language's reference.

DataFrame functions only. Two histograms are compared by Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1): the shares of five character
classes, and the shares of the language's common words. The references are
learned from all documents: per language the pooled counts, and as common words
those that make up at least ``common_share`` of the language's words (at most
1 / common_share of them). Texts whose language is null count as languages by
their bytes a character, see _key(). A language gets a reference
if it holds at least ``least_words`` words, below which a histogram is not stable.
Up to MAX_BROADCAST references are broadcast, more are joined by sorting.

Guards: the class histogram counts from ``min_chars`` characters on, the
common-word histogram from ``min_words`` words on. Rows that fail the base rules
are rejected without a look at the distances.

Defined cases: a null text has no words and fails the base; of a language
without a reference (too few words) distances are null and only the base rules
count; repeated rows each get their verdict; an empty table gives an empty
result; other columns, whatever their names, are carried in
``row`` and never looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import table, word_array
from shopmart.session import materialize

MIN_WORDS_BASE = 50
CHAR_CLASSES = ("upper", "digit", "punctuation", "other", "plain")
#: Distances above these reject.
MAX_CLASS_DISTANCE = 0.16
MAX_WORD_DISTANCE = 0.45
MIN_CHARS = 200
MIN_WORDS = 50
#: Words from which on a language gets a reference.
LEAST_WORDS = 5_000
#: Languages; each has at most 1 / common_share words.
MAX_BROADCAST = 1_000


def _without(text: Column, characters: str) -> Column:
    """How many of ``characters`` a text holds."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _rest(text: Column) -> Column:
    """A text without lower case letters, blanks and what is not ASCII: short, and quick to count in."""
    return F.regexp_replace(text, r"[a-z\x20\x09-\x0D\x80-\x{10FFFF}]+", "")


def _class_counts(text: Column, rest: Column) -> Column:
    """Characters by class, in the order of CHAR_CLASSES. Of "other" the bytes beyond
    one a character count; lower case letters and blanks are "plain".
    """
    counted = [
        _without(rest, string.ascii_uppercase),
        _without(rest, string.digits),
        _without(rest, string.punctuation),
        F.octet_length(text) - F.length(text),
    ]
    plain = F.length(text)
    for c in counted:
        plain = plain - c
    return F.array(*[c.cast("double") for c in [*counted, F.greatest(plain, F.lit(0))]])


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def _shares(counts: Column, total: Column) -> Column:
    """``total`` is a column of its own, so that it is added up once a row."""
    return F.transform(counts, lambda x: F.coalesce(F.try_divide(x, total), F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two aligned arrays of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / F.greatest(a + b, F.lit(1e-300)))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _key(lang: Column, text: Column) -> Column:
    """Of a language. Where it is null, of the texts with as many bytes a character, in quarters: other
    scripts aren't judged by Latin ones.
    """
    width = F.floor(F.coalesce(F.try_divide(4 * F.octet_length(text), F.length(text)), F.lit(0)))
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.concat(F.lit("?"), width.cast("string")))


def _held(refs: DataFrame, small: bool) -> DataFrame:
    """What is known of the languages, for a join."""
    return F.broadcast(refs) if small else refs.hint("merge")


def references(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    common_share: float = 0.01,
    least_words: int = LEAST_WORDS,
    buckets: int = 8192,
) -> DataFrame:
    """One row per ``lang`` (its _key) with ``words``, ``word_shares`` (the last: all others)
    and ``class_shares``.
    """
    rows = docs.select(_key(F.col(lang), F.coalesce(F.col(text), F.lit(""))).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    counts = _class_counts(F.col("t"), F.col("rest"))
    rows = rows.withColumn("w", word_array(F.col("t"))).withColumn("rest", _rest(F.col("t")))
    # A word of that share lies in a bucket of at least that share, so that only
    # the words of the few heavy buckets are counted one by one: exact, and the
    # vocabulary is never shuffled. Each word carries its part of its document's
    # character classes, which saves a pass.
    # Computed below the explode, or it would be once a word.
    rows = rows.select("lang", "w", F.size("w").alias("of"), counts.alias("c"))
    rows = rows.select("lang", "w", *[F.try_divide(F.col("c")[i], F.col("of")).alias(f"c{i}") for i in range(len(CHAR_CLASSES))])
    spread = rows.select("lang", *[f"c{i}" for i in range(len(CHAR_CLASSES))], F.explode("w").alias("word"))
    spread = spread.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(CHAR_CLASSES))]
    weights = spread.groupBy("lang", "bucket").agg(F.count("*").alias("n"), *sums)
    weights = materialize(weights, "quality-buckets")
    totals = weights.groupBy("lang").agg(F.sum("n").alias("total"))
    classes = (
        weights.groupBy("lang")
        .agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(CHAR_CLASSES))])
        .withColumn("c", F.array(*[F.col(f"c{i}") for i in range(len(CHAR_CLASSES))]))
        .withColumn("of", _total(F.col("c")))
        .select("lang", _shares(F.col("c"), F.col("of")).alias("class_shares"))
    )
    known = totals.where(F.col("total") >= least_words).join(classes, "lang")
    known = materialize(known, "quality-languages")
    small = known.count() <= MAX_BROADCAST
    # At most 1 / common_share rows per language.
    heavy = (
        weights.join(_held(known.select("lang", "total"), small), "lang")
        .where(F.col("n") >= F.col("total") * common_share)
        .select("lang", "bucket", "total")
    )
    common = (
        spread.select("lang", "word", "bucket").join(_held(heavy, small), ["lang", "bucket"])
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"), F.first("total").alias("total"))
        .where(F.col("n") >= F.col("total") * common_share)
        .select("lang", "word", (F.col("n") / F.col("total")).alias("share"), "total")
    )
    lists = (
        common.groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("share")).alias("s"), "word"))).alias("l"))
        .select(
            "lang",
            F.col("l.word").alias("words"),
            F.transform("l", lambda x: -x["s"]).alias("s"),
        )
    )
    rest = F.greatest(1 - F.aggregate("s", F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
    joined = known.join(lists, "lang", "left").select(
        "lang",
        F.coalesce("words", F.array().cast("array<string>")).alias("words"),
        F.coalesce(F.concat("s", F.array(rest)), F.array(F.lit(1.0))).alias("word_shares"),
        "class_shares",
    )
    return materialize(joined, "quality-references")


def assess(
    docs: DataFrame,
    refs: DataFrame | None = None,
    text: str = "text",
    lang: str = "lang",
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Each row as ``row`` with its counts, distances, ``base_failed`` and ``kept``."""
    refs = references(docs, text, lang) if refs is None else refs
    t, words, windows = F.col("t"), F.col("w"), F.col("g")
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", F.coalesce(F.col(f"row.{text}"), F.lit("")).alias("t"), _key(F.col(f"row.{lang}"), F.coalesce(F.col(f"row.{text}"), F.lit(""))).alias("k"))
    own = refs.select(F.col("lang").alias("k"), F.struct("words", "word_shares", "class_shares").alias("ref"))
    rows = rows.join(_held(own, refs.count() <= MAX_BROADCAST), "k", "left").select("row", "t", "ref")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("row", "t", "ref", word_array(t).alias("w"), lines.alias("l"), _rest(t).alias("rest"))
    triples = F.arrays_zip(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))).alias("x"),
        F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))).alias("y"),
        F.slice(words, 3, F.greatest(F.size(words) - 2, F.lit(0))).alias("z"),
    )
    rows = rows.select(
        "row",
        "t",
        "ref",
        "w",
        "rest",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _without(F.col("rest"), "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.transform(triples, lambda x: F.xxhash64(x)).alias("g"),
    )
    # Only where a window is found twice: windows in order of their hash, with their place.
    ordered = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    rows = rows.withColumn("s", ordered)
    near = F.transform(
        "s",
        lambda e, i: F.when(
            (F.get("s", i - 1)["h"] == e["h"]) | (F.get("s", i + 1)["h"] == e["h"]),
            F.array(e["i"], e["i"] + 1, e["i"] + 2),
        ),
    )
    covered = F.size(F.array_distinct(F.flatten(F.array_compact(near))))
    rows = rows.withColumn("n_repeat_words", F.when(F.col("s").isNull(), 0).otherwise(covered).cast("long"))
    rows = rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS_BASE) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )
    rows = rows.withColumn("common", F.col("ref.words"))
    found = F.transform("common", lambda r: (F.size("w") - F.size(F.array_remove("w", r))).cast("double"))
    rows = rows.withColumn("found", F.when(~F.col("base_failed"), found))
    counts = F.concat("found", F.array(F.col("n_words") - _total(F.col("found"))))
    rows = rows.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.length("t").cast("long").alias("length"),
        F.when(~F.col("base_failed"), counts).alias("word_counts"),
        F.when(~F.col("base_failed"), _class_counts(t, F.col("rest"))).alias("class_counts"),
        "ref",
    )
    for name in ("word", "class"):
        counts, total = F.col(f"{name}_counts"), F.col(f"{name}_total")
        rows = rows.withColumn(f"{name}_total", _total(counts))
        distance = js_distance(_shares(counts, total), F.col(f"ref.{name}_shares"))
        rows = rows.withColumn(f"{name}_distance", F.when(F.col("ref").isNotNull(), distance))
    odd = ((F.col("length") >= min_chars) & (F.col("class_distance") > max_class_distance)) | (
        (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance)
    )
    kept = ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False))
    return rows.withColumn("kept", kept).drop(
        "ref", "word_counts", "class_counts", "word_total", "class_total", "length"
    )


def op5_quality(spark, folder: str) -> DataFrame:
    rows = assess(table(spark, folder, "documents"))
    return rows.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "class_distance",
        "word_distance",
    )


def keep_good(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the rows that are kept, as they are.

    A filter would be pushed down through the steps of assess(), each time with
    the whole expression of its column; a column that is not deterministic stops it.
    """
    rows = assess(docs).withColumn("place", F.monotonically_increasing_id())
    return rows.where(F.col("kept") & (F.col("place") >= 0)).select("row.*")
