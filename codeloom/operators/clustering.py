"""k-means, cluster profiles and a two-dimensional projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from codeloom.functions import vectors as V
from codeloom.functions.effects import DOMINANCE_ORDER, dominant_label
from codeloom.operators.logistic import summed


def fit_kmeans(
    df: DataFrame, vec_col: str, k: int = 3, n_init: int = 10, seed: int = 42, max_iter: int = 100
) -> KMeansModel:
    """Best of ``n_init`` seeded starts by inertia."""
    data = df.select(
        array_to_vector(F.col(vec_col).cast("array<double>")).alias("features")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        best = None
        for start in range(n_init):
            model = KMeans(
                k=k, seed=seed + start, maxIter=max_iter, tol=1e-6, featuresCol="features"
            ).fit(data)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
    finally:
        data.unpersist()
    return best


@dataclass(frozen=True)
class SharedFit:
    """The best of several starts: its centres and inertia, and the passes over the rows that all starts took."""

    centres: list[list[float]]
    inertia: float
    passes: int


# Rows and bytes of the sample that starts are drawn from.
START_ROWS = 10_000
START_BYTES = 16 << 20


def _starts(sample: np.ndarray, k: int, n_init: int, seed: int) -> np.ndarray:
    """``n_init`` times ``k`` rows of the sample, each new one drawn by its squared distance to those before."""
    out = []
    for start in range(n_init):
        draw = np.random.default_rng(seed + start)
        centres = [sample[draw.integers(len(sample))]]
        near = ((sample - centres[0]) ** 2).sum(axis=1)
        while len(centres) < k:
            share = near / near.sum() if near.sum() > 0 else None
            centres.append(sample[draw.choice(len(sample), p=share)])
            near = np.minimum(near, ((sample - centres[-1]) ** 2).sum(axis=1))
        out.append(centres)
    return np.array(out)


def fit_kmeans_shared(
    df: DataFrame, vec_col: str, k: int = 3, n_init: int = 10, seed: int = 42, max_iter: int = 100, tol: float = 1e-6
) -> SharedFit:
    """k-means from ``n_init`` starts that take their steps together: one pass moves the centres of all.

    Starts are drawn from a bounded sample, steps and inertia cover all rows. A start that no longer moves by more than
    ``tol`` leaves the passes; a centre without rows stays. The best inertia wins, the earlier start on a tie. An empty table has no fit.
    """
    x = F.col(vec_col).cast("array<double>")
    dim = df.agg(F.coalesce(F.max(F.size(vec_col)), F.lit(0))).first()[0]
    data = df.select(V.with_length(x, dim, vec_col).alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = min(START_ROWS, max(k, START_BYTES // (8 * max(dim, 1))))
        drawn = data.orderBy(F.xxhash64("x"), "x").limit(rows).toArrow().column(0).combine_chunks()
        if not len(drawn):
            raise ValueError("no rows to cluster")
        sample = drawn.flatten().to_numpy(zero_copy_only=False).reshape(len(drawn), dim)
        centres = _starts(sample, k, n_init, seed)
        parts = data.rdd.getNumPartitions()
        moving, inertia, passes = list(range(n_init)), np.zeros(n_init), 0
        while moving:
            sums, members, inertia[moving] = _lloyd(data, parts, centres[moving])
            passes += 1
            means = np.where(members[..., None] > 0, sums / np.maximum(members, 1)[..., None], centres[moving])
            moved = ((means - centres[moving]) ** 2).sum(axis=2).max(axis=1)
            going = [] if passes > max_iter else [s for s, m in zip(moving, moved) if m > tol * tol]
            for i, s in enumerate(moving):
                if s in going:
                    centres[s] = means[i]
            moving = going
    finally:
        data.unpersist()
    best = int(inertia.argmin())
    return SharedFit(centres[best].tolist(), float(inertia[best]), passes)


def _lloyd(data: DataFrame, parts: int, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per start and centre the sum and number of the rows nearest to it, and per start the inertia; a row per partition."""
    starts, k, dim = centres.shape
    flat = centres.reshape(starts * k, dim)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members, inertia = np.zeros((starts, k, dim)), np.zeros((starts, k)), np.zeros(starts)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            own = (x * x).sum(axis=1)
            away = ((flat * flat).sum(axis=1) - 2 * (x @ flat.T)).reshape(len(x), starts, k)
            nearest = away.argmin(axis=2)
            inertia += np.maximum(away.min(axis=2) + own[:, None], 0).sum(axis=0)
            for s in range(starts):
                hot = np.zeros((len(x), k))
                hot[np.arange(len(x)), nearest[:, s]] = 1
                sums[s] += hot.T @ x
                members[s] += hot.sum(axis=0)
        data = np.concatenate([sums.reshape(-1), members.reshape(-1), inertia]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    found = summed(data.mapInArrow(step, "data binary"), parts)
    a, b = starts * k * dim, starts * k * (dim + 1)
    return found[:a].reshape(starts, k, dim), found[a:b].reshape(starts, k), found[b:]


def centroids_of(model: KMeansModel | SharedFit) -> list[list[float]]:
    if isinstance(model, SharedFit):
        return model.centres
    return [[float(x) for x in c] for c in model.clusterCenters()]


def assign_clusters(
    df: DataFrame, vec_col: str, centroids: list[list[float]], out_col: str = "cluster"
) -> DataFrame:
    return df.withColumn(out_col, V.nearest_centroid(F.col(vec_col), centroids))


def cluster_profile(
    df: DataFrame, cluster_col: str, label_col: str, k: int, order: list[str] = DOMINANCE_ORDER
) -> DataFrame:
    """Size, most common dominant label, purity and distribution per cluster.

    Rows collapse to (cluster, label) counts first, so a cluster that holds most
    rows is summed on the map side. An empty cluster has label ``?`` and purity 0.
    A tie of counts goes to the label of higher priority.
    """
    dominant = dominant_label(F.col(label_col), order)
    counts = (
        df.select(F.col(cluster_col).alias("cluster"), dominant.alias("label"))
        .groupBy("cluster", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.coalesce(
        F.when(
            F.array_position(F.array(*[F.lit(x) for x in order]), F.col("label")) > 0,
            F.array_position(F.array(*[F.lit(x) for x in order]), F.col("label")),
        ),
        F.lit(len(order) + 1),
    )
    folded = counts.groupBy("cluster").agg(
        F.sum("n").alias("size"),
        F.min(F.struct((-F.col("n")).alias("m"), rank.alias("r"), F.col("label"))).alias("_top"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias(
            "distribution"
        ),
    )
    clusters = df.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    return clusters.join(folded, "cluster", "left").select(
        "cluster",
        F.coalesce("size", F.lit(0)).alias("size"),
        F.coalesce(F.col("_top.label"), F.lit("?")).alias("dominant_label"),
        F.coalesce(F.round(-F.col("_top.m") / F.col("size"), 3), F.lit(0.0)).alias("purity"),
        F.coalesce(
            "distribution", F.create_map().cast("map<string,bigint>")
        ).alias("distribution"),
    )


def overall_purity(profile: DataFrame) -> DataFrame:
    """Size-weighted purity beside the share of the most common label."""
    top = F.aggregate(
        F.map_values("distribution"), F.lit(0).cast("bigint"), lambda m, n: F.greatest(m, n)
    )
    sizes = profile.agg(F.sum(top).alias("_hit"), F.sum("size").alias("n"))
    labels = (
        profile.select(F.explode("distribution").alias("label", "n"))
        .groupBy("label")
        .agg(F.sum("n").alias("n"))
        .agg(F.max("n").alias("_major"))
    )
    return sizes.withColumn("_major", labels.scalar()).select(
        F.when(F.col("n") > 0, F.col("_hit") / F.col("n")).otherwise(0.0).alias("purity"),
        F.when(F.col("n") > 0, F.col("_major") / F.col("n")).otherwise(0.0).alias(
            "majority_share"
        ),
    )


def misfits(df: DataFrame, profile: DataFrame, cluster_col: str, label_col: str) -> DataFrame:
    """Rows whose dominant label differs from that of their cluster.

    The profile has one row per cluster, so it is broadcast.
    """
    sides = profile.select(
        F.col("cluster").alias(cluster_col), F.col("dominant_label").alias("cluster_label")
    )
    return (
        df.withColumn("true_label", dominant_label(F.col(label_col)))
        .join(F.broadcast(sides), cluster_col)
        .where(F.col("true_label") != F.col("cluster_label"))
    )


def misfit_report(rows: DataFrame, id_col: str, n: int = 10) -> DataFrame:
    """First ``n`` misfits by key, each with the number of misfits in all."""
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rows.orderBy(id_col).limit(n).withColumn("n_misfits", total)


def drill_down(df: DataFrame, key: str, key_col: str = "function_id") -> DataFrame:
    """Labels, call count and source of one row, found by key.

    A function's key names its file, so only that file has to be extracted.
    """
    if key_col == "function_id" and "file_path" in df.columns:
        df = df.where(F.col("file_path") == key.rpartition("#")[0])
    return df.where(F.col(key_col) == F.lit(key)).select(
        key_col,
        F.col("labels.side_effects").alias("side_effects"),
        F.col("ast_features.call_count").alias("call_count"),
        "side_effects_source",
    )


def project_2d(df: DataFrame, vec_cols: dict[str, str], id_col: str, label_col: str) -> DataFrame:
    """Principal components 1 and 2 per row, vector column and label.

    ``vec_cols`` maps a view name to its vector column; a row appears once per
    label, as the per-label series of a scatter plot need it.
    """
    out = None
    for view, vec_col in vec_cols.items():
        data = df.select(
            id_col,
            label_col,
            array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"),
        )
        model = PCA(k=2, inputCol="features", outputCol="pc").fit(data)
        points = model.transform(data).select(
            F.lit(view).alias("view"),
            id_col,
            F.explode(F.array_distinct(label_col)).alias("label"),
            vector_to_array("pc")[0].alias("x"),
            vector_to_array("pc")[1].alias("y"),
        )
        out = points if out is None else out.unionByName(points)
    return out
