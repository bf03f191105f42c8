"""The queries of this package and their SQL."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let the tasks import this library, once per application."""
    application = spark.sparkContext.applicationId
    if application in _sent:
        return
    _sent.add(application)
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="shopmart-package-")) / "shopmart-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted((root / "shopmart").rglob("*.py")):
            z.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))  # Spark copies it to the executors


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline
    from shopmart.llm import (
        chat,
        decontaminate,
        html_text,
        language,
        mixing,
        phrases,
        pii,
        quality,
        runs,
        secrets,
        simhash,
        tokens,
        toxicity,
    )

    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_language": language.op2_language,
        "op3_simhash": simhash.op3_simhash,
        "op4_tokens": tokens.op4_tokens,
        "op5_quality": quality.op5_quality,
        "op6_html": html_text.op6_html,
        "op7_pii": pii.op7_pii,
        "op8_secrets": secrets.op8_secrets,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_decontamination": decontaminate.op10_decontamination,
        "op11_chat": chat.op11_chat,
        "op12_phrases": phrases.op12_phrases,
        "op13_runs": runs.op13_runs,
        "pipeline": corpus_pipeline.run,
    }


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    send_package(spark)
    return _queries()[name](spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(run, name) for name in _queries()}


def oracle_sql() -> dict[str, str]:
    from shopmart.llm import chat, phrases

    return {"op11_chat": chat.OP11_SQL, "op12_phrases": phrases.OP12_SQL}
