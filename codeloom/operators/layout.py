"""Two-dimensional layout of vectors by the graph of their nearest neighbours."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from codeloom.operators.neighbours import nearest
from codeloom.session import stored

# Neighbours of a row, products of the graph with a vector, and vectors that are multiplied at once.
NEIGHBOURS = 10
PRODUCTS = 24
STARTS = 2


@dataclass(frozen=True)
class Layout:
    """``points(id, x, y)`` and, for each axis, its eigenvalue; ``edges(src, dst, weight)`` is the normalised graph."""

    points: DataFrame
    values: list[float]
    edges: DataFrame


def neighbour_graph(hits: DataFrame) -> DataFrame:
    """Symmetric edges ``(src, dst, weight)`` of ``hits(query_id, neighbour_id)``.

    Two rows are joined if either is a neighbour of the other; the weight is 1 over the root of the product of their
    degrees. A row without neighbours has no edge.
    """
    one = hits.select(F.col("query_id").alias("src"), F.col("neighbour_id").alias("dst"))
    both = one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    both = stored(both, "graph")
    degree = both.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    other = degree.select(F.col("src").alias("dst"), F.col("degree").alias("other"))
    weight = 1 / F.sqrt(F.col("degree") * F.col("other"))
    return both.join(degree, "src").join(other, "dst").select("src", "dst", weight.alias("weight"))


def _dots(table: DataFrame, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The products of the first ``count`` vectors of ``q`` with the ``width`` of ``raw``, and of those with each other."""
    pairs = [(i, j) for j in range(width) for i in range(j + 1)]
    row = table.agg(
        *(F.sum(F.col("q")[i] * F.col("raw")[j]) for j in range(width) for i in range(count)),
        *(F.sum(F.col("raw")[i] * F.col("raw")[j]) for i, j in pairs),
    ).first()
    known = np.array([x or 0.0 for x in row])
    own = np.zeros((width, width))
    for (i, j), x in zip(pairs, known[width * count :]):
        own[i, j] = own[j, i] = x
    return known[: width * count].reshape(width, count).T, own


def _combined(weights: np.ndarray) -> Column:
    """``sum(weights[i] * q[i])``."""
    known = F.array(*(F.lit(float(w)) for w in weights))
    return F.aggregate(F.zip_with("q", known, lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)


def _orthonormal(own: np.ndarray) -> list[np.ndarray]:
    """Shares by which vectors with these products combine to orthonormal ones; none for what depends on those before."""
    out: list[np.ndarray] = []
    for j in range(len(own)):
        share = np.eye(len(own))[j]
        for known in out:
            share = share - (known @ own @ share) * known
        length = share @ own @ share
        if length > 1e-18 and length > 1e-12 * own[j, j]:
            out.append(share / length**0.5)
    return out


def neighbour_layout(
    df: DataFrame, vec_col: str, id_col: str, k: int = NEIGHBOURS, products: int = PRODUCTS, edges: DataFrame | None = None
) -> Layout:
    """The two leading eigenvectors of the normalised neighbour graph besides the trivial one.

    Lanczos steps by blocks of ``STARTS`` vectors, so that a graph of several parts shows them: each multiplies the graph with the last
    block, a join and sums per row, and makes the result orthogonal to all before, sums over the rows. A row holds its entries of
    the vectors, about ``products`` numbers, the driver only the products of the vectors; there is no matrix of rows by rows.
    Entries are divided by the root of the degree, the usual spectral layout; the sign makes the entry of the smallest id positive. Rows
    without an edge, and an empty table, give no points.
    """
    if edges is None:
        edges = stored(neighbour_graph(nearest(df, df, k, id_col, vec_col)), "edges")
    nodes = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).withColumnRenamed("src", "id")
    # Starts that depend on the id alone, and the trivial eigenvector, the roots of the degrees.
    starts = F.array(*(F.xxhash64("id", F.lit(i)).cast("double") / 2.0**63 for i in range(STARTS)))
    table = stored(nodes.select("id", "degree", F.array(F.sqrt("degree")).alias("q"), starts.alias("raw")), "layout")
    total = table.agg(F.sum("degree")).first()[0]
    if not total:
        empty = table.select("id", F.col("raw")[0].alias("x"), F.col("raw")[1].alias("y"))
        return Layout(empty, [], edges)
    scale = float(total) ** 0.5
    table = table.withColumn("q", F.array(F.col("q")[0] / scale))
    near = edges.repartition("src").persist(StorageLevel.MEMORY_AND_DISK)
    count, width, made = 1, STARTS, 0
    matrix = np.zeros((products + 2 * STARTS + 1,) * 2)
    while True:
        # Twice, because one subtraction leaves what rounding left.
        first, _ = _dots(table, count, width)
        left = [F.col("raw")[j] - _combined(first[:, j]) for j in range(width)]
        table = table.withColumn("raw", F.array(*left))
        second, own = _dots(table, count, width)
        if made:
            block = slice(count - made, count)
            matrix[:count, block] = first + second
            matrix[block, :count] = (first + second).T
        if count > products:
            break
        shares = _orthonormal(own - second.T @ second)
        if not len(shares):
            break
        # The new vectors are combinations of what is left of the products.
        rest = [F.col("raw")[j] - _combined(second[:, j]) for j in range(width)]
        fresh = [sum((r * float(s) for r, s in zip(rest, share)), F.lit(0.0)) for share in shares]
        table = table.select("id", "degree", F.concat("q", F.array(*fresh)).alias("q"))
        made = width = len(shares)
        last = table.select(F.col("id").alias("src"), *(F.col("q")[count + j].alias(f"e{j}") for j in range(made)))
        product = near.join(last, "src").groupBy("dst").agg(
            F.array(*(F.sum(F.col("weight") * F.col(f"e{j}")) for j in range(made))).alias("raw")
        )
        table = stored(table.join(product.withColumnRenamed("dst", "id"), "id"), "layout")
        count += made
    near.unpersist()
    # The trivial vector is left out; the block that was reached last is known by what it shares with the others.
    matrix = matrix[1:count, 1:count]
    values, vectors = np.linalg.eigh(matrix)
    steps = count - 1
    best = np.argsort(-values)[:2]
    axes = [np.concatenate([[0.0], vectors[:, i]]) for i in best] + [np.zeros(steps + 1)] * (2 - len(best))
    points = table.select("id", *((_combined(a) / F.sqrt("degree")).alias(n) for a, n in zip(axes, "xy")))
    points = stored(points, "layout-points")
    least = points.agg(F.min_by("x", "id").alias("x"), F.min_by("y", "id").alias("y")).first()
    signs = {n: -1.0 if (least[n] or 0.0) < 0 else 1.0 for n in "xy"}
    points = points.select("id", *((F.col(n) * signs[n]).alias(n) for n in "xy"))
    return Layout(points, [float(values[i]) for i in best], edges)


def residuals(layout: Layout) -> DataFrame:
    """``(axis, length, residual)``: how far the graph times each axis is from its eigenvalue times the axis, taken anew."""
    degree = layout.edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).withColumnRenamed("src", "id")
    values = dict(zip("xy", layout.values))
    known = layout.points.join(degree, "id").select(
        "id", F.explode(F.array(*(F.struct(F.lit(n).alias("axis"), (F.col(n) * F.sqrt("degree")).alias("entry"), F.lit(v).alias("value")) for n, v in values.items()))).alias("one")
    ).select("id", "one.*")
    product = layout.edges.join(known.withColumnRenamed("id", "src"), "src").groupBy("dst", "axis").agg(
        F.sum(F.col("weight") * F.col("entry")).alias("product")
    )
    both = known.join(product.withColumnRenamed("dst", "id"), ["id", "axis"])
    off = F.col("product") - F.col("value") * F.col("entry")
    return both.groupBy("axis").agg(
        F.sqrt(F.sum(F.col("entry") * F.col("entry"))).alias("length"), F.sqrt(F.sum(off * off)).alias("residual")
    )
