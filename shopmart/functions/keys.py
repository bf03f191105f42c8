"""Key expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(columns: Iterable[Column]) -> Column:
    """MD5 of the key columns, joined by ``-``."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))
