"""Telling the content of a table in one number, whatever the order of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType

_NULL = "~"


def _text(column: Column, kind: DataType) -> Column:
    """A cell as text; DOUBLE in millionths, so that it does not depend on how it is printed."""
    if isinstance(kind, DoubleType):
        column = F.round(column * 1_000_000).cast("bigint")
    return F.coalesce(column.cast("string"), F.lit(_NULL))


def content_digest(df: DataFrame) -> DataFrame:
    """One row: ``row_count, digest``.

    The digest is the sum of the first 60 bits of every row's md5, its cells
    taken by column name. Rows may come in any order and from any partitions; repeated
    rows count each. It is a partial aggregate: no rows are moved.
    """
    cells = [_text(F.col(f"`{f.name}`"), f.dataType) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    first_bits = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(first_bits), F.lit(0)).cast("decimal(30,0)").cast("string").alias("digest"),
    )
