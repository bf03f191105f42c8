"""Versioned parquet tables that become visible together.

Every load writes new folders and then a manifest, one small file that names the
folders of all tables; readers open the newest manifest and nothing else of the
log. Nothing a reader may be using is ever overwritten. A table may be made of
several folders (one per month), so an incremental load only writes the months it
touches. Two writers cannot publish the same version: a manifest is created only if there is
none, and the second of them fails with nothing changed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.sources.files import Folder

_PART = "__part"
_LOG = "_versions"
#: Hashes and keys, which other codecs cannot make smaller, take half their length.
_CODEC = "zstd"
WHOLE = "all"
#: The part of rows that have none.
NO_PART = "__HIVE_DEFAULT_PARTITION__"

Location = str | dict[str, str]


def part_name(part: Column) -> Column:
    """The part as stored: a folder cannot tell the empty text from none."""
    return F.coalesce(F.nullif(part, F.lit("")), F.lit(NO_PART))


class ConflictError(RuntimeError):
    """Another writer has published the version first."""


class Publisher:
    """The tables below ``root``; one writer at a time wins, any number of readers."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._files = Folder(spark, self.root)

    # --- versions ---------------------------------------------------------------

    def versions(self) -> list[int]:
        """The published versions that have not expired, oldest first."""
        names = (re.fullmatch(r"(\d+)\.json", name) for name in self._files.names(_LOG))
        return [int(match[1]) for match in names if match]

    def _manifest(self, version: int | None = None) -> dict:
        """``tables`` (folder by part, below the root, by table) and ``batches`` (by sink)."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return {"version": 0, "tables": {}, "batches": {}}
        return json.loads(self._files.read(f"{_LOG}/{version:012d}.json"))

    def next_version(self) -> int:
        return max(self.versions(), default=0) + 1

    def last_batch(self, sink: str) -> int:
        """The newest micro-batch a sink has published, -1 if none."""
        return self._manifest()["batches"].get(sink, -1)

    def commit(
        self, version: int, tables: Mapping[str, Location], batch: tuple[str, int] | None = None
    ) -> None:
        """Make all ``tables`` visible at once; the others stay as they are.

        ``batch``: the sink and number of the micro-batch the version comes from.
        """
        manifest = self._manifest()
        manifest["version"] = version
        for table, location in tables.items():
            parts = location if isinstance(location, dict) else {WHOLE: location}
            manifest["tables"][table] = {p: self._below_root(path) for p, path in parts.items()}
        if batch:
            manifest["batches"][batch[0]] = batch[1]
        text = json.dumps(manifest, indent=0, sort_keys=True)
        if not self._files.create(f"{_LOG}/{version:012d}.json", text):
            raise ConflictError(f"version {version} below {self.root} has been published by another writer")

    def expire(self, keep: int) -> None:
        """Forget all but the newest ``keep`` versions, and delete the folders only those used.

        Folders of versions not published yet are left alone.
        """
        if keep < 1:
            raise ValueError("the newest version cannot expire")
        versions = self.versions()
        kept = [self._manifest(v) for v in versions[-keep:]]
        used = {p for m in kept for parts in m["tables"].values() for p in parts.values()}
        for version in versions[:-keep]:
            self._files.remove(f"{_LOG}/{version:012d}.json")
        for table in self._files.names():
            for name in self._files.names(table) if table != _LOG else []:
                folder = f"{table}/{name}"
                number = re.fullmatch(r"v(\d+)", name)
                if not number or int(number[1]) > versions[-1] or folder in used:
                    continue
                parts = [f"{folder}/{part}" for part in self._files.names(folder)]
                if not used.intersection(parts):
                    self._files.remove(folder)
                    continue
                for part in parts:
                    if part not in used and f"/{_PART}=" in part:
                        self._files.remove(part)

    # --- reading ----------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return table in self._manifest()["tables"]

    def parts(self, table: str) -> dict[str, str]:
        """Folder by part of the newest version: one entry per part, e.g. per month."""
        parts = self._manifest()["tables"].get(table)
        if parts is None:
            raise LookupError(f"{table} has not been published below {self.root}")
        return {part: f"{self.root}/{path}" for part, path in parts.items()}

    def read(self, table: str, parts: Sequence[str] | None = None) -> DataFrame:
        """The newest version of a table, or only some of its parts."""
        return self.read_at(self.parts(table), parts)

    def read_at(self, location: Location, parts: Sequence[str] | None = None) -> DataFrame:
        """A table, or some of its parts, from the folders it was written to."""
        folders = location if isinstance(location, dict) else {WHOLE: location}
        # Columns are only ever appended, so the folder written last has all.
        last = max(folders.values(), key=self._version_of)
        schema = self.spark.read.parquet(last).schema
        asked = None if parts is None else set(parts)
        wanted = [path for part, path in folders.items() if asked is None or part in asked]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    # --- writing ----------------------------------------------------------------

    def _folder(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v{version}"

    def _below_root(self, path: str) -> str:
        return path.removeprefix(self.root).lstrip("/")

    def _version_of(self, path: str) -> int:
        return int(self._below_root(path).split("/")[1].removeprefix("v"))

    def write(self, df: DataFrame, table: str, version: int) -> str:
        """Write a whole table; invisible until committed."""
        path = self._folder(table, version)
        df.write.mode("overwrite").option("compression", _CODEC).parquet(path)
        return path

    def append(self, df: DataFrame, table: str, version: int) -> dict[str, str]:
        """Write more rows of a table; returns all its folders."""
        return (self.parts(table) if self.exists(table) else {}) | {
            f"v{version}": self.write(df, table, version)
        }

    def write_parts(
        self,
        df: DataFrame,
        table: str,
        version: int,
        part_of_row: Column,
        drop: Sequence[str] = (),
        spread: bool = True,
        derived: Mapping[str, Column] | None = None,
    ) -> dict[str, str]:
        """Write one folder per value of the text column ``part_of_row``, without columns in ``drop``.

        ``spread``: rows are brought together by part first, and a part with many
        rows is split over several tasks and files. Otherwise tasks write what they have.
        ``derived`` columns of ``df`` are not moved but computed again where rows are written.
        Rows without a part, or with an empty one, make up the part :data:`NO_PART`.
        """
        path = self._folder(table, version)
        split = df.withColumn(_PART, part_name(part_of_row)).drop(*drop)
        columns = split.columns
        if spread:
            split = split.drop(*(derived or ())).hint("rebalance", F.col(_PART))
            split = split.withColumns(dict(derived or {})).select(*columns)
        split.write.mode("overwrite").option("compression", _CODEC).partitionBy(_PART).parquet(path)
        # Folder names have some characters of the part encoded.
        start = f"{_PART}="
        names = [n for n in self._files.names(self._below_root(path)) if n.startswith(start)]
        return {unquote(name.removeprefix(start)): f"{path}/{name}" for name in names}

    def part_counts(self, table: str, version: int) -> DataFrame:
        """``part, row_count`` of the parts written for a version; reads no columns."""
        written = self.spark.read.schema(f"{_PART} string").parquet(self._folder(table, version))
        return written.groupBy(F.col(_PART).alias("part")).agg(F.count("*").alias("row_count"))
