"""Vectors per row: user-supplied encoders, the hashing encoder, fusion."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.functions import vectors as V
from codeloom.schemas import FEATURE_ORDER


def embed(
    df: DataFrame,
    text_col: str,
    encoder_factory: Callable[[], Callable[[list[str]], list[list[float]]]],
    dim: int,
    batch_size: int = 8,
    out_col: str = "embedding",
) -> DataFrame:
    """Add a vector per row from a user-supplied encoder.

    ``encoder_factory`` runs once per task and returns a function from a list of
    texts to a list of vectors; every vector must have ``dim`` entries. Null texts get
    null and never reach the encoder.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoder_factory()
        for texts in batches:
            known = [t for t in texts if t is not None]
            out: list = []
            for start in range(0, len(known), batch_size):
                out.extend(encoder(known[start : start + batch_size]))
            wrong = [len(v) for v in out if len(v) != dim]
            if wrong:
                raise ValueError(f"encoder returned {wrong[0]} entries, expected {dim}")
            vectors = iter(np.asarray(out, dtype=np.float32).reshape(len(out), dim))
            yield pd.Series([None if t is None else next(vectors) for t in texts], dtype=object)

    return df.withColumn(out_col, encode(F.col(text_col)))


def hash_embed(
    df: DataFrame, tokens_col: str, dim: int = 768, out_col: str = "embedding"
) -> DataFrame:
    """Built-in encoder: token counts per md5 bucket, scaled to unit length.

    Each row is encoded where it is, in the JVM: tokens become bucket names and a
    fixed bucket vocabulary counts them. No token is shuffled.
    """
    counter = CountVectorizerModel.from_vocabulary(
        [str(b) for b in range(dim)], inputCol="_buckets", outputCol="_counts"
    )
    buckets = F.transform(
        F.coalesce(F.col(tokens_col), F.array().cast("array<string>")),
        lambda t: V.md5_bucket(t, dim).cast("string"),
    )
    unit = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit")
    encoded = unit.transform(counter.transform(df.withColumn("_buckets", buckets)))
    return encoded.select(*df.columns, vector_to_array("_unit", "float32").alias(out_col))


def truncation_flag(
    df: DataFrame, tokens_col: str, max_tokens: int = 512, special_tokens: int = 2
) -> DataFrame:
    """Add ``truncated`` and ``head_tokens``, the tokens an encoder of
    ``max_tokens`` positions sees beside its special tokens."""
    n = F.coalesce(F.size(tokens_col), F.lit(0))
    return df.withColumns(
        {
            "truncated": n + special_tokens > max_tokens,
            "head_tokens": F.slice(F.col(tokens_col), 1, max_tokens - special_tokens),
        }
    )


def truncated_count(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.coalesce(F.col("truncated"), F.lit(False))).alias("n_truncated"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def missing_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: how many rows lack each required value."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def require_columns(df: DataFrame, cols: list[str], step: str) -> DataFrame:
    """``df`` itself, or an error naming the missing values and the step to run."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"no column {absent[0]}; run the step '{step}' first")
    counts = missing_counts(df, cols).first().asDict()
    for col, n in counts.items():
        if n:
            raise ValueError(f"{n} rows without '{col}'; run the step '{step}' first")
    return df


def pending_embeddings(df: DataFrame, col: str = "embedding") -> DataFrame:
    return df.where(F.col(col).isNull())


# --- standardised counts and fusion -----------------------------------------------


def fit_scaler(df: DataFrame, columns: dict) -> DataFrame:
    """Table ``(feature, mean, std)`` from one aggregate over ``{name: Column}``.

    Population deviation; a constant column gets the divisor 1.
    """
    pairs = []
    for name, col in columns.items():
        std = F.stddev_pop(col.cast("double"))
        pairs.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.avg(col.cast("double")).alias("mean"),
                F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"),
            )
        )
    return df.agg(F.array(*pairs).alias("_p")).select(F.inline("_p"))


def feature_columns(features_col: str = "ast_features") -> dict:
    return {
        f: F.coalesce(F.col(features_col)[f].cast("double"), F.lit(0.0)) for f in FEATURE_ORDER
    }


def scaler_values(params: DataFrame) -> dict[str, tuple[float, float]]:
    """Scaler table as a dictionary; it has one row per feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in params.collect()}


def apply_scaler(
    df: DataFrame, columns: dict, params: DataFrame, out_col: str = "scaled_features"
) -> DataFrame:
    """Add ``out_col`` = array of (x - mean) / std in the order of ``columns``.

    The parameters are read as one scalar subquery: the plan stays lazy and needs
    no join.
    """
    one = params.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std"))))
    ).scalar()
    scaled = [
        (col.cast("double") - F.col("_params")[name]["mean"]) / F.col("_params")[name]["std"]
        for name, col in columns.items()
    ]
    return df.withColumn("_params", one).select(*df.columns, F.array(*scaled).alias(out_col))


def fuse(
    df: DataFrame,
    emb_col: str = "embedding",
    feat_col: str = "scaled_features",
    expect_dim: int | None = None,
    normalize_embedding: bool = False,
    out_col: str = "fused_embedding",
) -> DataFrame:
    """Add the vector followed by the scaled counts; any other length fails.

    The vector itself is left as it is unless ``normalize_embedding`` is set.
    """
    vector = F.col(emb_col).cast("array<double>")
    if normalize_embedding:
        norm = F.sqrt(V.dot(vector, vector))
        vector = F.when(norm > 0, F.transform(vector, lambda x: x / norm)).otherwise(vector)
    fused = F.concat(vector, F.col(feat_col).cast("array<double>"))
    if expect_dim is not None:
        fused = V.with_length(fused, expect_dim, out_col)
    return df.withColumn(out_col, fused)
