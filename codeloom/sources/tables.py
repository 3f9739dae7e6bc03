"""The given tables and what the registered queries derive from them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.operators import extract
from codeloom.schemas import FEATURE_ORDER
from codeloom.session import ensure_checkpoint_dir
from codeloom.sources import corpus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Even out a table that arrives in fewer splits than there are cores.

    Extraction costs far more than its input is large, so a table of one small
    file is dealt out once. A table of many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def corpus_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C files derived from every line item and from every document."""
    lines = corpus.sources_from_lineitem(spread(table(spark, sf_dir, "lineitem")))
    documents = corpus.sources_from_documents(spread(table(spark, sf_dir, "documents")))
    return lines.unionByName(documents)


def corpus_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_functions(corpus_sources(spark, sf_dir))


def corpus_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The function table with flat counts: a reader of one count computes only that."""
    return extract.function_facts(extract.function_slices(corpus_sources(spark, sf_dir)))


def label_list(label: Column) -> Column:
    """Label list of an ``embeddings`` row."""
    found = F.array_compact(
        F.array(
            F.when(label % 2 == 0, "hardware"),
            F.when(label % 3 == 0, "io"),
            F.when(label % 5 == 0, "memory"),
        )
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("none")))


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", label_list(F.col("label")).alias("labels")
    )


def text_features(text: Column) -> Column:
    """Eight counts of a text in the place of the counts of a function."""

    def occurrences(part: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))

    return F.struct(
        occurrences("a").cast("int").alias("if_count"),
        occurrences("e").cast("int").alias("loop_count"),
        occurrences(".").cast("int").alias("return_count"),
        F.size(corpus.words(text)).alias("call_count"),
        occurrences(" ").cast("int").alias("nesting_depth"),
        (occurrences("\n") + 1).cast("int").alias("line_count"),
        occurrences(",").cast("int").alias("param_count"),
        F.length(text).alias("pointer_count"),
    )


def vectors_with_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector and every document, joined by number. A document without a vector gets one that
    follows from its number, and a vector without a document counts of 0."""
    documents = spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("vec_id"), text_features(F.col("text")).alias("ast_features")
    )
    number = F.col("vec_id")
    made = F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: (((number * 31 + i * 17) % 129 - 64) / 64).cast("float")
    )
    none = F.struct(*(F.lit(0).alias(f) for f in FEATURE_ORDER))
    joined = labelled_vectors(spark, sf_dir).join(documents, "vec_id", "full")
    return joined.select(
        "vec_id",
        F.coalesce("embedding", made).alias("embedding"),
        F.coalesce("labels", label_list(number % 10)).alias("labels"),
        F.coalesce("ast_features", none).alias("ast_features"),
    )
