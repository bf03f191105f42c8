"""Small reference files a user keeps: typed, under the header contract of the raw files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.sources import landing
from shopmart.sources.contracts import clean_header, difference, header_faults, require_headers

# Columns of each seed and their types.
SEED_COLUMNS: dict[str, dict[str, str]] = {
    "national_holidays": {"holiday_date": "date", "holiday_name": "string"},
    "category_overrides": {"category_name": "string", "category_name_en": "string"},
}


def read_seeds(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Seeds by name, from a CSV file (or a folder of them) each.

    All faulty headers are told together; a field that does not fit its type, or a
    row with too many or too few, fails the job that reads it. Columns may come in any
    order; unknown ones are faults, so that a seed does not drift unseen.
    """
    unknown = sorted(set(paths) - set(SEED_COLUMNS))
    if unknown:
        raise ValueError(f"no such seed: {', '.join(unknown)}")
    seeds, faults = {}, {}
    for name, path in paths.items():
        files = landing.list_files(spark, landing.as_pattern(path))
        listed = landing.inspect_files(files.filter(~F.col("file_name").rlike("^[._]"))).collect()
        if not listed:
            raise FileNotFoundError(f"no file of the seed {name} at {path}")
        columns = SEED_COLUMNS[name]
        for row in listed:
            header = clean_header(row["header"])
            faults[row["path"]] = header_faults(header) or difference(header, list(columns), ordered=False)
        seeds[name] = (listed, columns)
    require_headers(faults)
    return {name: _typed(spark, listed, columns) for name, (listed, columns) in seeds.items()}


def _typed(spark: SparkSession, listed, columns: Mapping[str, str]) -> DataFrame:
    rows = None
    for row in listed:  # a seed has few files
        read = landing.read_raw(spark, [row["path"]], clean_header(row["header"]), row["has_breaks"])
        read = read.select(*[F.trim(F.col(c)).cast(kind).alias(c) for c, kind in columns.items()])
        rows = read if rows is None else rows.unionByName(read)
    return rows
