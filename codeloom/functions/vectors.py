"""Column expressions on vectors held as arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from codeloom.schemas import FEATURE_ORDER


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, 0 for a zero vector. For few pairs; rankings go
    through ``operators.retrieval.top_k_neighbours``."""
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(dot(a, b) / norm)


def feature_vector(features: Column) -> Column:
    """The eight counts in canonical order as doubles, missing ones as 0."""
    return F.array(
        *[F.coalesce(features[f].cast("double"), F.lit(0.0)) for f in FEATURE_ORDER]
    )


def preview(vector: Column, n: int = 3) -> Column:
    return F.slice(vector, 1, n)


def with_length(vector: Column, dim: int, name: str) -> Column:
    """``vector`` if it has ``dim`` entries; any other length fails the job."""
    return F.when(F.size(vector) == dim, vector).otherwise(
        F.raise_error(
            F.concat(
                F.lit(f"{name}: expected {dim} entries, got "),
                F.coalesce(F.nullif(F.size(vector), F.lit(-1)).cast("string"), F.lit("null")),
            )
        )
    )


def md5_bucket(token: Column, dim: int) -> Column:
    """Bucket 0..dim-1 of a token from the first 32 bits of its md5."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % dim


def to_matrix(vectors: pd.Series) -> np.ndarray:
    """Row-per-vector matrix of a batch; the arrays of a batch share one length."""
    return np.vstack(vectors.to_numpy()).astype(np.float64, copy=False)


def _matrix(batch: pa.Array) -> np.ndarray:
    """Row-per-vector matrix of an Arrow batch of lists of one length, without an object per row."""
    lengths = pc.unique(pc.list_value_length(batch))
    if batch.null_count or len(lengths) != 1:
        raise ValueError("the vectors of a batch must share one length")
    return batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(batch), -1)


def _shared(rows: list[list[float]]):
    """A parameter matrix of any size, sent to each executor once."""
    return SparkSession.active().sparkContext.broadcast(np.asarray(rows, dtype=np.float64))


def linear_scores(vector: Column, weights: list[list[float]], intercepts: list[float]) -> Column:
    """``weights @ vector + intercepts`` as array<double>, a batch at a time."""
    matrix, bias = _shared(weights), np.asarray(intercepts, dtype=np.float64)

    @F.arrow_udf("array<double>")
    def scores(batch: pa.Array) -> pa.Array:
        if not len(batch):
            return pa.array([], pa.list_(pa.float64()))
        found = _matrix(batch) @ matrix.value.T + bias
        ends = np.arange(len(batch) + 1, dtype=np.int32) * len(bias)
        return pa.ListArray.from_arrays(ends, found.ravel())

    return scores(vector)


def nearest_centroid(vector: Column, centroids: list[list[float]]) -> Column:
    """Number of the nearest centroid (Euclidean), the smaller one on a tie."""
    shared = _shared(centroids)

    @F.pandas_udf("int")
    def nearest(batch: pd.Series) -> pd.Series:
        matrix = shared.value
        distance = (matrix**2).sum(axis=1) - 2.0 * (to_matrix(batch) @ matrix.T)
        return pd.Series(np.round(distance, 9).argmin(axis=1).astype(np.int32))

    return nearest(vector)
