"""From raw documents to packed training sequences: five stages, each over all documents that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablegrade.llm.decontamination import decontamination_stage
from tablegrade.llm.language import language_stage
from tablegrade.llm.lsh_forest import deduplication_stage
from tablegrade.llm.packing import pack
from tablegrade.llm.toxicity import toxicity_stage
from tablegrade.sources.state_files import stored_once


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences; one row per piece."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", deduplication_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express the stages; their tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored_once(stage(spark, docs, sf_dir))
    return docs
