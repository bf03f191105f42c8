"""Landing: CSV files to versioned raw tables, with an audit of every file."""

from __future__ import annotations

import csv
import hashlib
import re
import sys
from collections.abc import Iterator, Mapping
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmart.session import materialize
from shopmart.sources.contracts import (
    RAW_COLUMNS,
    SourceFiles,
    clean_header,
    difference,
    header_faults,
    raw_schema,
    require_headers,
)
from shopmart.sources.publish import Publisher

# Stands for a quoted empty field while reading, so that "" is not NULL.
_QUOTED_EMPTY = "\u0000quoted-empty\u0000"
_CHUNK = 1 << 20
_SOURCE = "_source"

# The helpers below run in tasks: ship them along, so that executors do not need
# the package installed.
register_pickle_by_value(sys.modules[__name__])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, file_name, parent, length`` of the files below ``folder``; reads no content."""
    steps = F.split("path", "/")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            "path",
            F.element_at(steps, -1).alias("file_name"),
            F.element_at(steps, -2).alias("parent"),
            "length",
        )
    )


def source_files(spark: SparkSession, folder: str, files: SourceFiles = SourceFiles()) -> DataFrame:
    """Add ``table_name`` to the listed files; other files are left out.

    What a table's file name refers to may be one file or a folder of files.
    """
    by_name = F.create_map(*[F.lit(x) for t, n in files.all().items() for x in (n, t)])
    table = F.coalesce(by_name[F.col("file_name")], by_name[F.col("parent")])
    hidden = F.col("file_name").rlike("^[._]")
    listed = list_files(spark, folder).filter(~hidden).withColumn("table_name", table)
    return listed.filter(F.col("table_name").isNotNull())


def check_source_files(
    spark: SparkSession, folder: str, files: SourceFiles = SourceFiles()
) -> DataFrame:
    """The source files, or an error that lists every table whose file is missing."""
    found_files = source_files(spark, folder, files)
    # At most one row per expected table.
    found = {r["table_name"] for r in found_files.select("table_name").distinct().collect()}
    missing = [name for table, name in files.all().items() if table not in found]
    # A scan skips files without content, so tell those from absent ones.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    empty = {path.rsplit("/", 1)[-1] for path in listed.inputFiles()} & set(missing)
    if empty:
        raise ValueError(f"{', '.join(sorted(empty))} is empty")
    if missing:
        raise FileNotFoundError(f"missing files in {folder}: {', '.join(missing)}")
    return found_files


def _open(path: str) -> pafs.NativeFile:
    """A listed file: Hadoop names its stores differently, and its paths are not encoded."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        local = rest if colon and scheme == "file" else path
        return pafs.LocalFileSystem().open_input_stream("/" + local.lstrip("/"))
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    filesystem, inner = pafs.FileSystem.from_uri(f"{known}:{quote(rest, safe='/:@')}")
    return filesystem.open_input_stream(inner)


def _chunks(path: str) -> Iterator[bytes]:
    with _open(path) as stream:
        while chunk := stream.read(_CHUNK):
            yield chunk


def _hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            for chunk in _chunks(path):
                digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


class _Inspection:
    """What one reading of a file tells: its hash, its first record, and if fields hold line breaks.

    Quotes come in pairs, doubled ones too, so a line break after an odd number
    of them is inside a field.
    """

    def __init__(self) -> None:
        self.digest = hashlib.sha256()
        self.head: bytes | None = b""
        self.quoted = self.breaks = False

    def add(self, chunk: bytes) -> None:
        self.digest.update(chunk)
        if self.head is not None:
            self.head += chunk
            end = self._end_of_record(self.head)
            if end is not None:
                self.header, self.head = self._record(self.head[:end]), None
        for place, piece in enumerate(chunk.split(b'"')):
            if place:
                self.quoted = not self.quoted
            if self.quoted and not self.breaks:
                self.breaks = b"\n" in piece or b"\r" in piece

    @staticmethod
    def _end_of_record(text: bytes) -> int | None:
        at = -1
        while (at := text.find(b"\n", at + 1)) >= 0:
            if text.count(b'"', 0, at) % 2 == 0:
                return at
        return None

    @staticmethod
    def _record(line: bytes) -> list[str]:
        text = line.decode("utf-8-sig").rstrip("\r")
        return next(csv.reader([text]), [])

    def result(self) -> tuple[str, list[str], bool]:
        header = self.header if self.head is None else self._record(self.head)
        return self.digest.hexdigest(), header, self.breaks


def _inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for path in batch["path"]:
            inspection = _Inspection()
            for chunk in _chunks(path):
                inspection.add(chunk)
            found.append(inspection.result())
        digests, headers, breaks = zip(*found) if found else ((), (), ())
        yield batch.assign(sha256=list(digests), header=list(headers), has_breaks=list(breaks))


def _first_record(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        headers = []
        for path in batch["path"]:
            inspection = _Inspection()
            for chunk in _chunks(path):
                inspection.add(chunk)
                if inspection.head is None:
                    break
            headers.append(inspection.result()[1])
        yield batch.assign(header=headers)


def file_hashes(files: DataFrame) -> DataFrame:
    """Add ``sha256``: files are spread over the tasks and read in small chunks."""
    schema = T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType())])
    return _spread(files).mapInPandas(_hash, schema)


def file_headers(files: DataFrame) -> DataFrame:
    """Add ``header``, the fields of the first record of each CSV file, without a BOM."""
    names = T.StructField("header", T.ArrayType(T.StringType()))
    return files.mapInPandas(_first_record, T.StructType([*files.schema.fields, names]))


def inspect_files(files: DataFrame) -> DataFrame:
    """Add ``sha256``, ``header`` and ``has_breaks`` (line breaks inside fields), reading each file once."""
    schema = T.StructType(
        [
            *files.schema.fields,
            T.StructField("sha256", T.StringType()),
            T.StructField("header", T.ArrayType(T.StringType())),
            T.StructField("has_breaks", T.BooleanType()),
        ]
    )
    return _spread(files).mapInPandas(_inspect, schema)


def _spread(files: DataFrame) -> DataFrame:
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism, "path")


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, without byte-order mark."""
    first = file_headers(list_files(spark, path)).first()
    header = clean_header(first["header"] if first else None)
    require_headers({path.rsplit("/", 1)[-1]: header_faults(header)})
    return header


def _scan(spark: SparkSession, paths: list[str], header: list[str], has_breaks: bool) -> DataFrame:
    return (
        spark.read.schema(raw_schema(header))
        .option("header", "true")
        # The header comes from these very files and may have been trimmed.
        .option("enforceSchema", "true")
        .option("mode", "FAILFAST")
        .option("multiLine", str(has_breaks).lower())
        .option("escape", '"')
        .option("emptyValue", _QUOTED_EMPTY)
        .csv([as_pattern(path) for path in paths])
    )


def as_pattern(path: str) -> str:
    """A path that Spark takes by the letter, whatever marks of patterns it holds."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_raw(
    spark: SparkSession, paths: list[str], header: list[str], has_breaks: bool = False
) -> DataFrame:
    """Rows of CSV files, all columns text, and the file each comes from in ``_source``.

    A row with too many or too few fields fails the job. Files whose fields hold
    line breaks are read by one task each, all others are split.
    """
    columns = [
        F.when(F.col(c) == _QUOTED_EMPTY, F.lit("")).otherwise(F.col(c)).alias(c) for c in header
    ]
    return _scan(spark, paths, header, has_breaks).select(
        *columns, F.col("_metadata.file_path").alias(_SOURCE)
    )


def _file_part(path: Column) -> Column:
    """The part of a raw table a file's rows make: its path, told as a safe name."""
    return F.md5(F.regexp_replace(path, "^file:/+", "file:/"))


def _load_table(
    spark: SparkSession, files: list[Row], header: list[str], publisher: Publisher, table: str, version: int
) -> dict[str, str]:
    """Write one raw table from its files in a single scan; the folder of each file's rows."""
    scans = [
        read_raw(spark, paths, header, has_breaks)
        for has_breaks in (False, True)
        if (paths := [r["path"] for r in files if r["has_breaks"] == has_breaks])
    ]
    rows = reduce(DataFrame.unionByName, scans)
    # The scan gives paths encoded, and a plus sign as it is.
    path = F.url_decode(F.replace(F.col(_SOURCE), F.lit("+"), F.lit("%2B")))
    return publisher.write_parts(rows, table, version, _file_part(path), drop=(_SOURCE,), spread=False)


def load_raw(
    spark: SparkSession,
    folder: str,
    publisher: Publisher,
    files: SourceFiles = SourceFiles(),
) -> dict[str, DataFrame]:
    """Reload every raw table, publish them together and return them.

    Nothing is visible to readers before all tables and the audit are written,
    so a failed load leaves the previous one in place. Each CSV file is read twice,
    once as it is and once as rows: the rows of a file are a part of its table, so
    that the audit counts them where they were written. A listed file without a part has no rows; a part that
    belongs to no listed file fails the load.
    """
    found = check_source_files(spark, folder, files).drop("parent", "length")
    found = materialize(inspect_files(found), "source_files")
    version = publisher.next_version()
    locations: dict[str, str | dict[str, str]] = {}
    # The file list: names only, never content.
    listed = found.select("table_name", "file_name", "path", "header", "has_breaks").collect()
    headers = _agreed_headers(listed, publisher)
    counts = []
    for table in RAW_COLUMNS:
        mine = [r for r in listed if r["table_name"] == table]
        parts = _load_table(spark, mine, headers[table], publisher, table, version)
        counts += [publisher.part_counts(table, version).withColumn("table_name", F.lit(table))] if parts else []
        locations[table] = parts or publisher.write(
            spark.createDataFrame([], raw_schema(headers[table])), table, version
        )
    unlisted = F.raise_error(F.concat(F.lit("rows of an unlisted file in "), "table_name")).cast("string")
    audit = (
        found.withColumn("part", _file_part(F.col("path")))
        .join(_counted(spark, counts), ["table_name", "part"], "full")
        .select(
            F.coalesce("file_name", unlisted).alias("file_name"),
            "table_name",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            "sha256",
        )
        .withColumn("loaded_at", F.current_timestamp())
    )
    locations["load_audit"] = publisher.append(audit.coalesce(1), "load_audit", version)
    publisher.commit(version, locations)
    return {table: publisher.read(table) for table in RAW_COLUMNS}


def _counted(spark: SparkSession, counts: list[DataFrame]) -> DataFrame:
    nothing = spark.createDataFrame([], "part string, row_count bigint, table_name string")
    return reduce(DataFrame.unionByName, counts, nothing)


def _agreed_headers(listed: list[Row], publisher: Publisher) -> dict[str, list[str]]:
    """The header of each table, after all files of all tables have been looked at.

    The files of a table have the columns of the published table, in its order,
    or on a first load those of the contract, all in the order of its first file.
    """
    agreed: dict[str, list[str]] = {}
    faults: dict[str, list[str]] = {}
    for row in sorted(listed, key=lambda r: r["path"]):
        table, header = row["table_name"], clean_header(row["header"])
        found = header_faults(header)
        if not found and table in agreed:
            found = difference(header, agreed[table], ordered=True)
        elif not found and publisher.exists(table):
            agreed[table] = publisher.read(table).columns
            found = difference(header, agreed[table], ordered=True)
        elif not found:
            agreed[table] = header
            found = difference(header, RAW_COLUMNS[table], ordered=False)
        faults[row["path"]] = found
    require_headers(faults)
    return agreed


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for every table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
