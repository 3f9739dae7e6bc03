"""L2 logistic models of all labels and vector columns at once: one pass over the rows per step of all of them."""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from codeloom.functions.vectors import with_length

# Partial sums that meet in one task, or on the driver; more are added up in a tree.
FAN_IN = 64
# Steps that the direction remembers, and trial points of a line search at most.
MEMORY = 40
TRIALS = 25
# A step must lower the value by this share of the slope, and flatten the slope to that.
DECREASE, CURVATURE = 1e-4, 0.9

Evaluation = tuple[float, np.ndarray]


def minimise(start: np.ndarray, max_iter: int, tol: float) -> Generator[np.ndarray, Evaluation, np.ndarray]:
    """L-BFGS as a generator: it yields points, is sent ``(value, gradient)`` for each, and returns the minimum.

    It ends where no entry of the gradient is above ``tol``, or no trial point is any better.
    """
    x = start
    value, slope = yield x
    known: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=MEMORY)
    for _ in range(max_iter):
        if np.abs(slope).max(initial=0.0) <= tol:
            break
        way = -_inverse_times(slope, known)
        fall = slope @ way
        if fall >= 0:
            known.clear()
            way, fall = -slope, -(slope @ slope)
        step, low, high = 1.0 if known else min(1.0, 1 / np.linalg.norm(slope)), 0.0, np.inf
        for _ in range(TRIALS):
            other = x + step * way
            other_value, other_slope = yield other
            if other_value > value + DECREASE * step * fall + 1e-15 * abs(value):
                high = step
            elif other_slope @ way < CURVATURE * fall:
                low = step
            else:
                break
            step = (low + high) / 2 if np.isfinite(high) else 2 * step
        else:
            break
        moved, turned = other - x, other_slope - slope
        if moved @ turned > 1e-16:
            known.append((moved, turned))
        x, value, slope = other, other_value, other_slope
    return x


def _inverse_times(slope: np.ndarray, known: deque) -> np.ndarray:
    """The slope times the inverse curvature that the last steps showed."""
    out, shares = slope.copy(), []
    for moved, turned in reversed(known):
        share = (moved @ out) / (moved @ turned)
        shares.append(share)
        out -= share * turned
    if known:
        moved, turned = known[-1]
        out *= (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(known, reversed(shares)):
        out += (share - (turned @ out) / (moved @ turned)) * moved
    return out


def summed(partials: DataFrame, n_parts: int) -> np.ndarray:
    """The sum of equally long double vectors, one for each of ``n_parts`` partitions, in the column ``data``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(0).to_pylist():
                one = np.frombuffer(data)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["data"])

    while n_parts > FAN_IN:
        n_parts = -(-n_parts // FAN_IN)
        partials = partials.repartition(n_parts).mapInArrow(add, "data binary")
    return sum(np.frombuffer(row["data"]) for row in partials.collect())


def fit_all(
    train: DataFrame,
    vec_cols: dict[str, str],
    label_col: str,
    classes: list[str],
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-6,
) -> dict[str, dict[str, tuple[float, list[float]] | bool]]:
    """For each vector column and class ``(intercept, coefficients)``, or the one value of a label that never changes.

    The optimum of ``|w|^2 / 2 + c * sum(loss)``, the intercept unpenalised; ``tol`` bounds each entry of its
    gradient divided by ``c`` times the rows. All models take their steps together: a pass over the rows gives
    the values and gradients of all that still move, as one vector for each partition. Without rows all labels are constant.
    """
    sizes = train.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.array_contains(label_col, x)).alias(f"n_{i}") for i, x in enumerate(classes)),
        *(F.coalesce(F.max(F.size(v)), F.lit(0)).alias(f"d_{j}") for j, v in enumerate(vec_cols.values())),
    ).first()
    n = sizes["n"]
    dims = {name: sizes[f"d_{j}"] for j, name in enumerate(vec_cols)}
    constant = {x: sizes[f"n_{i}"] > 0 for i, x in enumerate(classes) if sizes[f"n_{i}"] in (0, n)}
    out: dict = {name: {x: constant[x] for x in constant} for name in vec_cols}
    wanted = [(name, i) for name in vec_cols for i, x in enumerate(classes) if x not in constant]
    if not wanted:
        return out
    names = list(vec_cols)
    data = train.select(
        F.array(*(F.coalesce(F.array_contains(label_col, x), F.lit(False)).cast("double") for x in classes)).alias("labels"),
        *(
            with_length(F.col(v).cast("array<double>"), dims[name], v).alias(f"v{j}")
            for j, (name, v) in enumerate(vec_cols.items())
        ),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = data.rdd.getNumPartitions()
        moving = {p: minimise(np.zeros(dims[p[0]] + 1), max_iter, tol) for p in wanted}
        points = {p: next(steps) for p, steps in moving.items()}
        while points:
            for p, evaluation in _evaluated(data, parts, points, names, dims, len(classes), c, n).items():
                try:
                    points[p] = moving[p].send(evaluation)
                except StopIteration as end:
                    del points[p]
                    name, i = p
                    out[name][classes[i]] = float(end.value[-1]), end.value[:-1].tolist()
    finally:
        data.unpersist()
    return out


def _evaluated(data: DataFrame, parts: int, points: dict, names: list[str], dims: dict, width: int, c: float, n: int) -> dict:
    """Value and gradient of each problem at its point, per ``c * n``, by one pass."""
    order = sorted(points, key=lambda p: (names.index(p[0]), p[1]))
    tables = []
    for j, name in enumerate(names):
        own = [p for p in order if p[0] == name]
        if own:
            weights = np.stack([points[p] for p in own])
            tables.append((1 + j, [p[1] for p in own], weights[:, :-1], weights[:, -1]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(own), w.shape[1] + 2)) for _, own, w, _ in tables]
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            labels = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(rows, width)
            for total, (column, own, weights, bias) in zip(totals, tables):
                x = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(rows, weights.shape[1])
                y = labels[:, own]
                score = x @ weights.T + bias
                total[:, 0] += (np.logaddexp(0.0, score) - y * score).sum(axis=0)
                wrong = np.exp(-np.logaddexp(0.0, -score)) - y
                total[:, 1:-1] += wrong.T @ x
                total[:, -1] += wrong.sum(axis=0)
        flat = np.concatenate([t.reshape(-1) for t in totals])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], ["data"])

    flat = summed(data.mapInArrow(sums, "data binary"), parts)
    out, at = {}, 0
    for p in order:
        size = dims[p[0]] + 2
        loss, slope = flat[at], flat[at + 1 : at + size].copy()
        at += size
        weights = points[p][:-1]
        slope[:-1] += weights / c
        out[p] = (loss + weights @ weights / (2 * c)) / n, slope / n
    return out
