"""CSV export of the marts for tools that cannot read parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_MOMENT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Stands for a quoted empty field while reading, so that "" is not NULL.
_QUOTED_EMPTY = "\u0000quoted-empty\u0000"


def export_csv(
    marts: Mapping[str, DataFrame], folder: str, compression: str = "none"
) -> dict[str, int]:
    """Write every mart below ``folder`` and return its row count.

    Booleans are ``true``/``false``, NULL is an empty field, the empty
    text is ``""``, blanks are kept and quotes are doubled.  Each mart becomes a folder of files with a header, written in
    parallel; rows are counted while they are written. ``compression`` (``gzip``, ...) makes
    the files smaller; their names then end accordingly.
    """
    counts = {}
    for name, df in marts.items():
        seen = Observation(f"export {name}")
        (
            df.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .option("header", "true")
            .option("compression", compression)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .option("timestampNTZFormat", _MOMENT)
            .csv(f"{folder.rstrip('/')}/{name}")
        )
        counts[name] = seen.get["rows"]
    return counts


def read_exported(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """One exported mart with its types; a row that does not fit them fails the job."""
    rows = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "FAILFAST")
        .option("multiLine", "true")
        .option("escape", '"')
        .option("emptyValue", _QUOTED_EMPTY)
        .option("enforceSchema", "false")
        .option("timestampNTZFormat", _MOMENT)
        .csv(f"{folder.rstrip('/')}/{name}")
    )
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    return rows.withColumns(
        {c: F.when(F.col(c) == _QUOTED_EMPTY, F.lit("")).otherwise(F.col(c)) for c in texts}
    )
