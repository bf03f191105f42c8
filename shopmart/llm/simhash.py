"""Near duplicates: SimHash fingerprints linked by anchor-point covering.

Two fingerprints of 64 bits that differ in at most t <= 3 bits differ in at most
one bit of their upper or of their lower half. The anchors of a half are the
words of a perfect code: the Hamming code of 31 bits, whose balls of radius 1
fill the space, with the 32nd bit kept as it is. A fingerprint is at home at the
one anchor within the covering radius 1, and is replicated to every anchor within
the radius plus the half's threshold, 2: 2 or 17 anchors. A fingerprint's partner
is therefore found at the fingerprint's home. Per anchor only homes are compared
with replicas, and the exact distance over all 64 bits decides.

Equal fingerprints are one node, so copies are never paired; components are found
by contraction (`components`). Nothing is capped.

Defined cases: a null or empty text, or one of blanks, has fingerprint 0 and is
linked like any other; fewer words than a shingle count as one shingle; repeated
rows have equal results; null ids never name a component unless a component has
no other (then its id is null); an empty table gives an empty result; columns
other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import give_back, slices, table, texts
from shopmart.llm.components import components
from shopmart.session import materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 3
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    words = text.encode().lower().split()  # bytes: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return hashed(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    hashes = [hashed(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    values = np.array(hashes, np.uint64)
    # Eight counters of a byte in each sum; 255 values can't overflow them.
    padded = np.zeros(-(-len(values) // 255) * 255, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(-1, 255)
    result = 0
    for shift in range(8):
        sums = ((padded >> np.uint64(shift)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.nonzero(2 * counts > len(values))[0].tolist():
            result |= 1 << (8 * byte + shift)
    return result


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE, others: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp) and the columns ``others``, longs; the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64)
                columns = [batch.column("id"), pa.array(found.view(np.int64)), *map(batch.column, others)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "fp", *others])
        give_back()

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), *others)
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in ("id", "fp", *others)))


def _syndromes(half: np.ndarray) -> np.ndarray:
    """Exclusive or of the places (1 to 31) of the bits that are set; 0 on the code."""
    syndrome = np.zeros(len(half), np.uint32)
    for place in range(1, 32):
        syndrome ^= ((half >> np.uint32(place - 1)) & np.uint32(1)) * np.uint32(place)
    return syndrome


def anchors(half: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and anchor of every anchor within 1 + ``reach`` bits (reach 0 or 1), and the homes."""
    syndrome = _syndromes(half)
    one = np.where(syndrome > 0, np.uint32(1) << (np.maximum(syndrome, 1) - 1).astype(np.uint32), np.uint32(0))
    home = half ^ one
    rows, found = [np.arange(len(half))], [home]
    if reach:
        rows.append(rows[0])
        found.append(home ^ np.uint32(1 << 31))
        off = np.nonzero(syndrome)[0]
        for a in range(1, 32):
            # Two bits a < b whose places give the syndrome.
            b = syndrome[off] ^ np.uint32(a)
            pick = b > a
            at, b = off[pick], b[pick]
            rows.append(at)
            found.append(half[at] ^ np.uint32(1 << (a - 1)) ^ (np.uint32(1) << (b - 1)))
    return np.concatenate(rows), np.concatenate(found), home


def links(values: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` at most ``max_bits`` apart."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the code of the anchors covers 0 to 3 differing bits")
    reach = max_bits // 2

    def replicate(batches: Iterator[pa.RecordBatch], homes: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            bits = fp.view(np.uint64)
            for side in (0, 1):
                half = ((bits >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows, found, home = anchors(half, reach)
                rows, found = (np.arange(len(half)), home) if homes else (rows, found)
                where = found.astype(np.int64) | (side << 32)
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(fp[rows])], ["anchor", "a" if homes else "b"])

    at_home = values.select("fp").mapInArrow(lambda it: replicate(it, True), "anchor long, a long")
    replicas = values.select("fp").mapInArrow(lambda it: replicate(it, False), "anchor long, b long")
    near = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    met = at_home.join(replicas, (at_home.anchor == replicas.anchor) & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fp, component): the smallest id that links reach, per row."""
    rows = materialize(fingerprints(docs, key, text, shingle), "simhash")
    values = materialize(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-values")
    reached = components(links(values, max_bits)).select(F.col("node").alias("fp"), "root")
    reached = materialize(reached.join(values, "fp"), "simhash-roots")
    least = reached.groupBy("root").agg(F.min("first").alias("least"))
    named = materialize(reached.join(least, "root").select("fp", "least"), "simhash-named")
    joined = rows.join(values, "fp").join(named, "fp", "left")
    return joined.select("id", "fp", F.coalesce("least", "first").alias("component"))


def op3_simhash(spark, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), text.alias("fingerprint"), F.col("component").alias("component_id"))


def keep_first(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: of each component one row, the one of the smallest id.

    Rows, not ids, are chosen and kept: an id may have several texts, or be null
    (last in order). Among rows of one id the smallest hash of the text decides,
    among equal texts any one stays. Places are written with the rows, so that
    all passes see the same ones.
    """
    placed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))
    placed = materialize(placed, "simhash-docs")
    told = placed.select("row.doc_id", "row.text", "place", F.xxhash64("row.text").alias("hash"))
    rows = materialize(fingerprints(told, "doc_id", "text", others=("place", "hash")), "simhash")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "place")
    values = materialize(rows.groupBy("fp").agg(F.min(order).alias("first")), "simhash-values")
    reached = components(links(values)).select(F.col("node").alias("fp"), "root")
    roots = values.join(reached, "fp", "left").select(F.coalesce("root", "fp").alias("root"), "first")
    kept = roots.groupBy("root").agg(F.min("first").alias("first")).select("first.place")
    return placed.join(kept, "place", "left_semi").select("row.*")
