"""Quality rules, near-dedup, decontamination, pseudonyms and packing as one pipeline over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codeloom.llm import decontaminate, packing, pseudonyms, quality, simhash
from codeloom.llm.common import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the posterior of the voting rules."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values in their texts replaced by pseudonyms."""
    return pseudonyms.replace_text(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in windows of 2048."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

# The stages run models and iterations that SQL does not express; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    docs = documents(spark, sf_dir)
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
