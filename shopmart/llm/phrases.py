"""Phrase collocations by dynamic itemset counting.

Texts are dealt into shards once, and the shards are scanned in turn, round and
round. Single words are counted from the first step on. A longer phrase is
activated as soon as both phrases one word shorter, its beginning and its end, have
reached the threshold in the counts so far, whatever their own counting still has to
do; it is then counted for exactly one cycle, so that its count is complete. Phrases
of all lengths are thus counted in the same scans. As no phrase occurs more often than
its parts, every phrase that reaches the threshold is activated in the end.

What tasks have to know is when a phrase reached the threshold. That is kept in a
filter of fixed size, ``2**cell_bits`` bytes, which is all that is broadcast: the
step is written to two cells chosen by the phrase's hash unless an earlier one
stands there, and the later of the two is the step of the phrase. Cells never
change once set, so all tasks and steps agree on when a phrase's cycle begins. A
phrase whose cells were set by others is only counted in vain: counts are kept by the
words themselves and are exact. The fuller the filter, the more is counted in vain.

A task names the phrases of a slice of texts by the numbers of their words and sends
each once with its count; counts are added up in Spark before and after the shuffle.
Between steps the counts of unfinished phrases are written to the shared folder, those
that end below the threshold are dropped, and those that reach it are written to the result.
There are at most 5 cycles, as a phrase waits for one cycle of its parts. After two of them all
frequent pairs are known, and the shards are written anew with nothing but the stretches
of frequent pairs, which is all that longer phrases can be made of.

Scores are exact in DECIMAL(38, 0): 1000 times a count times the words of a language has to
be below 10**38, else the job fails.

Defined cases: a null or empty text has no words; a null language counts as ``und``,
together with the rows that say so; a language without frequent phrases has no rows; ties go
by count, then by the bytes of the phrase; repeated rows count each; an empty table gives
an empty result; a text is read whole however long, one at a time if it is over a slice;
other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmart.llm.common import slices, table, texts
from shopmart.session import checkpoint_dir, materialize

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
SHARDS = 3
CELL_BITS = 24
NEVER = 255

_BREAK = b"\xff"  # never part of a UTF-8 text
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10,
)
#: A phrase's key is its size and the step at which its cycle begins, three digits each, itself and its language:
#: one string, as each column of a row takes bytes and time in a shuffle. A phrase has no line feed.
_COUNTS = "key string, n long"
_TEXTS = "lang string, text string, shard int"


class Reached:
    """At which step phrases reached the threshold, by their hash."""

    def __init__(self, cell_bits: int) -> None:
        self.cell_bits = cell_bits
        self.cells = np.full(1 << cell_bits, NEVER, np.uint8)

    def __reduce__(self):
        """Sent as the cells that are set while they are few, as all cells at most."""
        places = np.flatnonzero(self.cells != NEVER).astype(np.uint32)
        few = 5 * len(places) < len(self.cells)
        return Reached.of, (self.cell_bits, places if few else None, self.cells[places] if few else self.cells)

    @classmethod
    def of(cls, cell_bits: int, places: np.ndarray | None, steps: np.ndarray) -> Reached:
        made = cls(cell_bits)
        made.cells[slice(None) if places is None else places] = steps
        return made

    def set(self, cells: np.ndarray, step: int) -> None:
        self.cells[cells] = np.minimum(self.cells[cells], step)

    def steps(self, hashes: np.ndarray) -> np.ndarray:
        first, second = cells_of(hashes, len(self.cells))
        return np.maximum(self.cells[first], self.cells[second])


def cells_of(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(n - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def longer_hashes(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases made longer by a word."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) + last


class Slice:
    """The words of some texts of a language, numbered, with a break after each piece."""

    def __init__(self, lang: str, rows: list[str]) -> None:
        joined = _BREAK.join([t.encode().translate(_FOLD) for t in rows])
        joined = joined.replace(_BREAK, b" " + _BREAK + b" ")
        ends = pa.py_buffer(np.array([0, len(joined)], np.int64))
        whole = pa.Array.from_buffers(pa.large_string(), 1, [None, ends, pa.py_buffer(joined)])
        # All white space left is the blank; nothing stands before the first or after the last one.
        words = pc.ascii_split_whitespace(whole).flatten().dictionary_encode()
        self.ids = words.indices.to_numpy().astype(np.int64)
        self.spelled = words.dictionary
        plain = self.spelled.cast(pa.large_binary()).to_pylist()
        self.is_word = np.array([w not in (b"", _BREAK) for w in plain], bool)
        self.hashes = word_hashes(lang, plain)

    def pairs(self, reached: Reached) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of reached words, their steps, hashes and names."""
        when = np.where(self.is_word, reached.steps(self.hashes), np.uint8(NEVER))[self.ids]
        at = np.flatnonzero(when != NEVER)
        return at, when[at], self.hashes[self.ids[at]], self.ids[at]

    def longer(
        self, at: np.ndarray, steps: np.ndarray, hashes: np.ndarray, size: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where a phrase of ``size`` words begins whose beginning and end have been reached: which
        of the given places, when its cycle begins, its last word and its hash.
        """
        pair = np.flatnonzero(np.diff(at) == 1)
        start = np.maximum(steps[pair], steps[pair + 1]).astype(np.int64) + 1
        last = self.ids[at[pair] + size - 1]
        return pair, start, last, longer_hashes(hashes[pair], self.hashes[last])


def count_phrases(
    part: Slice, reached: Reached, step: int, shards: int, max_words: int
) -> Iterator[tuple[pa.Array, int, np.ndarray, np.ndarray]]:
    """Counts of the phrases whose cycle covers this step: phrases, their size, starts and counts."""
    if step < shards:
        known = np.flatnonzero(part.is_word)
        counts = np.bincount(part.ids, minlength=len(part.is_word))[known]
        yield part.spelled.take(pa.array(known)), 1, np.zeros(len(known), np.int64), counts
    at, steps, hashes, names = part.pairs(reached)
    for size in range(2, max_words + 1):
        pair, start, last, hashes = part.longer(at, steps, hashes, size)
        at, names = at[pair], names[pair] * len(part.is_word) + last
        due = step < start + shards
        steps = reached.steps(hashes)
        used = due | (steps != NEVER)
        at, start, steps, hashes, due, names = (a[used] for a in (at, start, steps, hashes, due, names))
        if not len(at):
            return
        _, names, counts = np.unique(names, return_inverse=True, return_counts=True)
        first = np.empty(len(counts), np.int64)
        first[names] = np.arange(len(names))
        counted = due[first]
        place, starts = at[first[counted]], start[first[counted]]
        if len(place):
            parts = [part.spelled.take(pa.array(part.ids[place + k])) for k in range(size)]
            yield pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())), size, starts, counts[counted]
        kept = steps != NEVER
        at, steps, hashes, names = at[kept], steps[kept], hashes[kept], names[kept]


def frequent_stretches(part: Slice, reached: Reached) -> str:
    """The stretches of three words or more of which any two in a row are a reached phrase, a piece each."""
    at, steps, hashes, _ = part.pairs(reached)
    pair, _, _, hashes = part.longer(at, steps, hashes, 2)
    at = at[pair][reached.steps(hashes) != NEVER]
    beside = np.diff(at) == 1
    at = at[np.append(beside, False) | np.append(False, beside)] if len(at) else at
    words = np.union1d(at, at + 1)
    ends = np.flatnonzero(~np.isin(words, at, assume_unique=True))
    ids = np.insert(part.ids[words], ends + 1, len(part.spelled))
    spelled = pa.concat_arrays([part.spelled, pa.array(["\n"], pa.large_string())])
    return " ".join(spelled.take(pa.array(ids)).to_pylist())


def _slices(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, Slice]]:
    for whole in batches:
        for batch in slices(whole, chars=8_000_000):
            groups: dict[tuple, list[str]] = {}
            for key, text in zip(zip(*(batch.column(c).to_pylist() for c in by)), texts(batch)):
                groups.setdefault(key, []).append(text)
            for key, rows in groups.items():
                yield key, Slice(key[0], rows)


def keys_of(phrases: pa.Array, size: int, start: np.ndarray, lang: str) -> pa.Array:
    """The keys of phrases of one size and language."""
    steps, places = np.unique(start, return_inverse=True)
    begins = pa.array([f"{size:03d}{step:03d}" for step in steps.tolist()], pa.large_string()).take(pa.array(places))
    end, nothing = (pa.scalar(x, pa.large_string()) for x in (f"\n{lang}", ""))
    return pc.binary_join_element_wise(begins, phrases, end, nothing)


def _step(shard: DataFrame, sent: Broadcast[Reached], step: int, shards: int, max_words: int) -> DataFrame:
    """(key, n) of a shard, partly added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang,), part in _slices(batches, ["lang"]):
            for phrases, size, start, n in count_phrases(part, sent.value, step, shards, max_words):
                columns = [keys_of(phrases, size, start, lang).cast(pa.string()), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n"])

    return shard.select("lang", "text").mapInArrow(run, _COUNTS)


def _named(counts: DataFrame) -> DataFrame:
    """(lang, phrase, size, start, n) of counts by key."""
    cut = F.locate("\n", F.col("key"))
    return counts.select(
        F.expr("substring(key, locate('\n', key) + 1)").alias("lang"),
        F.substring("key", F.lit(7), cut - 7).alias("phrase"),
        F.substring("key", 1, 3).cast("int").alias("size"),
        F.substring("key", 4, 3).cast("int").alias("start"),
        "n",
    )


def _trimmed(dealt: DataFrame, sent: Broadcast[Reached]) -> DataFrame:
    """The shards without what no phrase of three words or more can be part of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, shard), part in _slices(batches, ["lang", "shard"]):
            text = frequent_stretches(part, sent.value)
            if text:
                columns = [pa.array([lang]), pa.array([text]), pa.array([shard], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "text", "shard"])

    return dealt.select("lang", "text", "shard").mapInArrow(run, _TEXTS)


def _cells(phrases: DataFrame, cell_bits: int) -> np.ndarray:
    """The filter's cells of the phrases: no more than it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                first, *rest = word_hashes(row["lang"], row["phrase"].encode().split(b" "))
                total = np.array([first])
                for h in rest:
                    total = longer_hashes(total, h)
                found += cells_of(total, 1 << cell_bits)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["cell"])

    cells = phrases.select("lang", "phrase").mapInArrow(run, "cell long").distinct()
    return cells.toArrow().column("cell").to_numpy()


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    shards: int = SHARDS,
    cell_bits: int = CELL_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``max_words`` words with their exact counts, ``lang, phrase, size, n``,
    of at least ``min_count``; and the number of all words, ``lang, n_words``.
    """
    if not 1 <= shards * max_words <= NEVER:
        raise ValueError(f"shards times words must be within 1 and {NEVER}")
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/shopmart/phrases-{uuid.uuid4().hex}"
    dealt = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.col(text).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    )
    dealt.where("text <> ''").write.partitionBy("shard").parquet(f"{folder}/shards")
    dealt = spark.read.schema(_TEXTS).parquet(f"{folder}/shards")

    reached = Reached(cell_bits)
    running = n_words = None
    step, until = 0, shards - 1
    while step <= until:
        sent = spark.sparkContext.broadcast(reached)
        if step == 2 * shards:
            # Words are counted after one cycle and pairs after two.
            _trimmed(dealt, sent).write.partitionBy("shard").parquet(f"{folder}/trimmed")
            dealt = spark.read.schema(_TEXTS).parquet(f"{folder}/trimmed")
        counted = _step(dealt.where(F.col("shard") == step % shards), sent, step, shards, max_words)
        if running is not None:
            counted = counted.unionByName(running)
        counts = materialize(counted.groupBy("key").agg(F.sum("n").alias("n")), f"counts{step}")
        sent.destroy()
        if step == shards - 1:
            words = _named(counts.where(F.col("key").startswith("001")))
            n_words = words.groupBy("lang").agg(F.sum("n").alias("n_words"))
        ended = F.substring("key", 4, 3) <= f"{step + 1 - shards:03d}" if step + 1 >= shards else F.lit(False)
        enough = _named(counts.where(F.col("n") >= min_count))
        whole = enough.where(F.col("start") + shards - 1 <= step).select("lang", "phrase", "size", "n")
        whole.write.mode("append").parquet(f"{folder}/frequent")
        running = counts.where(~ended)
        # Those that reached it at an earlier step are set already, which changes nothing.
        cells = _cells(enough.where(F.col("size") < max_words), cell_bits)
        if (reached.cells[cells] == NEVER).any():
            # What they activate is counted in the next steps, one for each shard.
            reached.set(cells, step)
            until = max(until, step + shards)
        step += 1
    found = spark.read.schema("lang string, phrase string, size int, n long").parquet(f"{folder}/frequent")
    return found, n_words


def collocations(frequent: DataFrame, n_words: DataFrame, top: int = TOP) -> DataFrame:
    """The phrases of two words or more of each language by their least score over all cuts.

    ``lang, rank, phrase, a, l, r, n, score``. Phrases that lie within a longer one just as
    frequent are left out.
    """
    longer = frequent.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    # A longer phrase around it that is as frequent: then so is one longer by one word.
    words = F.split("phrase", " ")
    inner = F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "),
    )
    within = longer.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.join(within, ["lang", "phrase", "a"], "left_anti")

    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    first = F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", first.alias("first"), rest.alias("rest"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr(
        "(cast(1000 as decimal(4, 0)) * cast(a as decimal(18, 0)) * cast(n_words as decimal(18, 0)))"
        " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    )
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(n_words, "lang")
    scored = scored.withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a", F.col("n_words").alias("n")).agg(lowest)
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First within slices of a language, so that no task gets all its phrases.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    for window in (Window.partitionBy("lang", part), Window.partitionBy("lang")):
        best = best.withColumn("rank", F.row_number().over(window.orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(*frequent_phrases(table(spark, folder, "documents")))


OP12_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]'
        )) as piece
    from documents
),
listed as (
    select lang, regexp_extract_all(piece, '[^ \x09]+') as words from pieces
),
placed as (
    select lang, words, unnest(range(1, len(words) + 1)) as i from listed
),
spans as (
    select lang, size, array_to_string(words[i:i + size - 1], ' ') as phrase
    from placed, (select unnest(range(1, 6)) as size)
    where i + size - 1 <= len(words)
),
counts as (
    select lang, phrase, size, count(*) as a from spans group by all
),
totals as (
    select lang, sum(a)::bigint as n from counts where size = 1 group by lang
),
candidates as (
    select lang, phrase, size, a, string_split(phrase, ' ') as words from counts where size > 1 and a >= 100
),
inner_phrases as (
    select b.lang, array_to_string(b.words[s.i:s.j], ' ') as phrase, max(b.a) as longest
    from candidates b,
        (select i, j from (select unnest(range(1, 6)) as i), (select unnest(range(1, 6)) as j)) s
    where s.j <= b.size and s.j > s.i and s.j - s.i + 1 < b.size
    group by all
),
kept as (
    select c.* from candidates c left join inner_phrases w on w.lang = c.lang and w.phrase = c.phrase
    where w.longest is null or 100 * w.longest < 100 * c.a
),
cuts as (
    select lang, phrase, a, k,
        array_to_string(words[1:k], ' ') as first_part,
        array_to_string(words[k + 1:size], ' ') as rest
    from kept, (select unnest(range(1, 5)) as k)
    where k < size
),
scored as (
    select c.lang, c.phrase, c.a, c.k, f.a as l, g.a as r, t.n,
        (1000::hugeint * c.a * t.n) // (f.a::hugeint * g.a) as score
    from cuts c
    join counts f on f.lang = c.lang and f.phrase = c.first_part
    join counts g on g.lang = c.lang and g.phrase = c.rest
    join totals t on t.lang = c.lang
),
best as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""
