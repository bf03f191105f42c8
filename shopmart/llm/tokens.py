"""Token ids in binary files of bit-plane shuffled blocks.

A shard file holds, in this order (integers little-endian):

    b"BPLANES1"
    blocks: ids in blocks of BLOCK (the last one shorter), each block as one
        zstandard frame per byte plane: plane k has byte k of every id
    document index: zstandard frame of three int64 arrays: has an id, id, number of tokens
    chunk index: int64 per block: offset, ids, sizes of its four planes
    int64 x 4: offset of the document index, offset of the chunk index, documents, blocks

``planes="bit"`` goes further and transposes each byte plane into eight bit
planes within its frame; the magic then ends in 2.

Documents are dealt to shards by ranges of (id, hash of the text) and sorted
within; a task tokenizes its range and writes one shard. It writes to a name of
its own attempt and then renames it to the shard's name, and a repeated task
writes the same bytes, so lost executors and repeated tasks leave whole files.
Memory is one batch of texts and one block. The folder must be one that all
executors share, as a path or URI that pyarrow can open (file, hdfs, s3, gs).

Defined cases: a null or empty text is the end id alone; null ids come first;
rows of equal id are ordered by their text, repeated rows are written each; an
empty table makes no file and an empty result; a text is tokenized whole however
long; columns other than id and text are not looked at.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm.common import give_back, slices, table, texts
from shopmart.session import checkpoint_dir

BLOCK = 1 << 16
END_ID = 2
_END = np.array([END_ID], "<u4").tobytes()
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_CUT = "\x01"
MAGIC = {"byte": b"BPLANES1", "bit": b"BPLANES2"}


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    uri = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", uri))
    return pafs.FileSystem.from_uri(uri)


def pack_block(ids: np.ndarray, planes: str = "byte") -> list[bytes]:
    compress = zstandard.ZstdCompressor(level=3).compress
    split = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if planes == "bit":
        # Eight rows of bits, most significant first, per byte plane.
        split = [np.packbits(np.unpackbits(row[:, None], axis=1).T, axis=1) for row in split]
    return [compress(np.ascontiguousarray(plane).tobytes()) for plane in split]


def unpack_block(frames: list[bytes], n: int, planes: str = "byte") -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    out = np.empty((n, 4), np.uint8)
    for k, frame in enumerate(frames):
        row = np.frombuffer(expand(frame), np.uint8)
        if planes == "bit":
            bits = np.unpackbits(row.reshape(8, -1), axis=1)[:, :n]
            row = np.packbits(bits.T, axis=1).ravel()
        out[:, k] = row
    return out.reshape(-1).view("<u4")


class ShardWriter:
    def __init__(self, sink, planes: str = "byte") -> None:
        self.sink, self.planes = sink, planes
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.index: list[list[int]] = []
        self.docs: list[tuple[int, int, int]] = []
        sink.write(MAGIC[planes])

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.docs.append((key is not None, key or 0, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= BLOCK:
            ids = np.concatenate(self.held)
            whole = len(ids) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                self._block(ids[at : at + BLOCK])
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        frames = pack_block(ids, self.planes)
        self.index.append([self.sink.tell(), len(ids), *map(len, frames)])
        for frame in frames:
            self.sink.write(frame)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        at_docs = self.sink.tell()
        docs = np.array(self.docs, "<i8").reshape(-1, 3).T
        self.sink.write(zstandard.ZstdCompressor().compress(np.ascontiguousarray(docs).tobytes()))
        at_index = self.sink.tell()
        self.sink.write(np.array(self.index, "<i8").tobytes())
        self.sink.write(struct.pack("<4q", at_docs, at_index, len(self.docs), len(self.index)))
        self.sink.close()


class ShardReader:
    """Any block can be read on its own through the chunk index."""

    def __init__(self, source) -> None:
        self.source = source
        magic = source.read_at(8, 0)
        self.planes = {v: k for k, v in MAGIC.items()}[bytes(magic)]
        size = source.size()
        at_docs, at_index, n_docs, n_blocks = struct.unpack("<4q", source.read_at(32, size - 32))
        docs = zstandard.ZstdDecompressor().decompress(source.read_at(at_index - at_docs, at_docs))
        self.docs = np.frombuffer(docs, "<i8").reshape(3, n_docs)
        self.index = np.frombuffer(source.read_at(size - 32 - at_index, at_index), "<i8").reshape(n_blocks, 6)

    def block(self, i: int) -> np.ndarray:
        offset, n, *sizes = self.index[i].tolist()
        whole, frames = self.source.read_at(sum(sizes), offset), []
        for size in sizes:
            frames.append(whole[:size])
            whole = whole[size:]
        return unpack_block(frames, n, self.planes)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(id, token ids) in the order of the file, holding one block and one document."""
        blocks = (self.block(i) for i in range(len(self.index)))
        rest = np.empty(0, "<u4")
        for known, key, n in self.docs.T.tolist():
            parts, missing = [], n
            while missing:
                if not len(rest):
                    rest = next(blocks)
                parts.append(rest[:missing])
                missing -= len(parts[-1])
                rest = rest[len(parts[-1]) :]
            yield (key if known else None), np.concatenate(parts) if parts else np.empty(0, "<u4")


class Encoder:
    """Whole texts to ids, the pieces of words looked up once each.

    A byte-level pre-tokenizer never joins what stands before a run of white space
    with the run, nor a letter or digit with a mark like the comma behind it. So a
    text in which every blank begins such a run may be cut at its blanks and marks, and a word is
    the same piece with or without a mark. That is done in Arrow, and only what is different among the pieces
    is seen by Python. Texts with a blank inside a run, with other white space or control
    characters, and with special tokens go through the library whole.

    Latin letters, with a blank before them or none, are one unit of the pre-tokenizer
    already and are encoded without it. Pieces are kept in two generations of at most
    ``most``, so that memory is bounded and frequent ones stay. Between tasks only the first
    ``rested`` are held, among which are the frequent ones: a worker may not get another task.
    """

    def __init__(self, vocabulary: str, most: int = 600_000, rested: int = 100_000) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.of_units = Tokenizer.from_file(vocabulary)
        self.of_units.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        odd = "\x01\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.is_whole = re.compile("|".join([f"[{odd}]", "[ \n\t\r] ", *map(re.escape, special)])).search
        self.is_unit = re.compile(f" ?[{_LETTERS}]+").fullmatch
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.most = most
        self.rested = rested

    def rest(self) -> None:
        """Hold little until the next task."""
        self.known, self.old = dict(itertools.islice(self.known.items(), self.rested)), {}

    def encode(self, rows: list[str]) -> list[np.ndarray]:
        whole = [self.is_whole(t) is not None for t in rows]
        uncut = iter(self._library(self.tokenizer, [t for t, w in zip(rows, whole) if w]))
        cut = iter(self._encode_cut([t for t, w in zip(rows, whole) if not w]))
        return [np.frombuffer(next(uncut) + _END, np.uint32) if w else next(cut) for w in whole]

    def _encode_cut(self, rows: list[str]) -> Iterator[np.ndarray]:
        if not rows:
            return
        marked = pc.replace_substring(pa.array(rows, pa.large_string()), " ", _CUT + " ")
        marked = pc.replace_substring_regex(marked, f"([0-9{_LETTERS}])([.,;:!?])", rf"\1{_CUT}\2")
        lists = pc.split_pattern(marked, _CUT)
        pieces = lists.flatten().dictionary_encode()
        places, bounds = pieces.indices.to_numpy(), lists.offsets.to_numpy()
        ids = self._pieces(pieces.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        lengths = sizes[places]
        ends = np.cumsum(lengths)
        # Where each piece's ids are, one after another.
        shift = (np.cumsum(sizes) - sizes)[places] - (ends - lengths)
        taken = flat[np.repeat(shift, lengths) + np.arange(ends[-1])]
        stops = ends[bounds[1:] - 1].tolist()
        for start, stop in zip([0, *stops], stops):
            yield np.append(taken[start:stop], np.uint32(END_ID))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces of text that the pre-tokenizer does not join with what is around them."""
        if len(self.known) > self.most:
            self.known, self.old = {"": b""}, self.known
        ids = list(map(self.known.get, pieces))
        units, others = [], []
        for place, found in enumerate(ids):
            if found is None:
                ids[place] = self.old.get(pieces[place])
                if ids[place] is None:
                    (units if self.is_unit(pieces[place]) else others).append(place)
                else:
                    self.known[pieces[place]] = ids[place]
        for tokenizer, new in ((self.of_units, units), (self.tokenizer, others)):
            spelled = [pieces[place] for place in new]
            encoded = self._library(tokenizer, spelled)
            self.known.update(zip(spelled, encoded))
            for place, found in zip(new, encoded):
                ids[place] = found
        return ids

    @staticmethod
    def _library(tokenizer, texts: list[str]) -> list[bytes]:
        encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]


@functools.cache
def encoder_of(vocabulary: str) -> Encoder:
    """One per Python worker: later tasks find the pieces of earlier ones."""
    return Encoder(vocabulary)


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str | None = None, key: str = "doc_id", text: str = "text", planes: str = "byte"
) -> list[tuple[int, str, int, int]]:
    """Write the shards; returns (shard, path, documents, ids) of each, in order.

    ``vocabulary``: file of the tokenizer, the same on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path_of = vocabulary
        if path_of is None:
            import public_tokenizers

            path_of = public_tokenizers.path("byte_bpe_50k.json")
        encoder = writer = None
        shard = TaskContext.get().partitionId()
        files, root = open_folder(folder)
        name, own = f"{root}/shard-{shard:06d}.bpl", f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex}"
        for whole in batches:
            for batch in slices(whole, chars=4_000_000):
                if writer is None:
                    encoder = encoder_of(path_of)
                    files.create_dir(root, recursive=True)
                    writer = ShardWriter(files.open_output_stream(own, compression=None), planes)
                for i, ids in zip(batch.column("id").to_pylist(), encoder.encode(texts(batch))):
                    writer.add(i, ids)
            give_back()
        if writer is not None:
            writer.close()
            files.move(own, name)
            encoder.rest()
            del whole, batch, ids
            give_back()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "path": [name], "docs": [len(writer.docs)], "ids": [writer.n_ids]}
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")
    written = rows.mapInArrow(run, "shard int, path string, docs long, ids long").collect()  # a row per shard
    return sorted(tuple(r) for r in written)


def read_digests(spark: SparkSession, folder: str, shards: list[tuple[int, str, int, int]]) -> DataFrame:
    """Per document, from the files: its id, ``start``, ``n_tokens`` and the crc32 of its ids."""
    starts = [0, *itertools.accumulate(ids for *_, ids in shards)]
    rows = [(path, start) for (_, path, *_), start in zip(shards, starts)]
    listed = spark.createDataFrame(rows, "path string, start long")
    listed = listed.repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(row["path"]) as source:
                    reader, start = ShardReader(source), row["start"]
                    found: list[tuple] = []
                    for key, ids in reader.documents():
                        found.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                for at in range(0, len(found), 10_000):
                    columns = [pa.array(c, pa.int64()) for c in zip(*found[at : at + 10_000])]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32"])
                del found
                give_back()

    return listed.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/shopmart/tokens-{uuid.uuid4().hex}"
    found = read_digests(spark, folder, write_tokens(docs, folder))
    return found.withColumnRenamed("id", "doc_id")


def op4_tokens(spark, folder: str) -> DataFrame:
    return token_files(spark, table(spark, folder, "documents"))


def write_stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the digest of the files it writes, a row per document and copy."""
    return token_files(spark, docs)
