"""From raw documents to token files: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopmart.llm import decontaminate, mixing, quality, simhash, tokens
from shopmart.llm.registry import send_package
from shopmart.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_package(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        send_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality rules", _with_package(quality.keep_good)),
    ("near duplicates", _with_package(simhash.keep_first)),
    ("benchmark decontamination", _with_package(decontaminate.drop_contaminated)),
    ("mixing", _with_package(mixing.repeat_rows)),
    ("token files", _with_package(tokens.write_stage)),
]

#: Fingerprints, tiling, Newton iterations and tokenizers are beyond SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage{k}")
    return docs
