"""Exact nearest neighbours by cosine that leave out blocks which cannot hold one.

Rows are dealt to their nearest pivot and, around each pivot, into shells of equal angles. Angles between
vectors obey the triangle inequality, so a shell that lies between the angles a and b from its pivot holds
nothing nearer to a query at angle t than ``max(t - b, a - t)``. A first round compares every query with its own
surroundings; a second visits only the cells that can still reach its k-th similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.vectors import with_length
from codeloom.operators import retrieval as Q
from codeloom.session import stored

# Pivots, and shells around each, at most. The cells that all tasks know are so many whatever the input.
PIVOTS = 256
SHELLS = 64
# Rows and bytes of the sample that pivots are made from; any pivots give the same result.
SAMPLE_ROWS = 8192
SAMPLE_BYTES = 16 << 20
PIVOT_ROUNDS = 5
# Corpus blocks from which on cells are made.
FEWEST_BLOCKS = 8
# Share of all pairs of rows from which on all are compared by plain blocks.
WORTH = 0.5
# What rounding may add to an angle and to a similarity.
ANGLE_SLACK = 1e-6
SIMILARITY_SLACK = 1e-8
# Rows whose bounds are taken at once, queries that are sent together, and queries of near cells that are multiplied at once.
_ROWS = 128
CHUNK_ROWS = 512
PRODUCT_ROWS = 64
# Vectors of tiles, in both precisions, that a task keeps.
KEPT_BYTES = 64 << 20


@dataclass(frozen=True)
class Cells:
    """The non-empty cells of the corpus. Cell of pivot -1: vectors of zeros, whose similarity to all is 0."""

    pivots: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    block_rows: int

    def homes(self, k: int) -> list[np.ndarray]:
        """For each cell the cells that its queries meet first: itself, and the nearest others until they hold more than ``k`` rows."""
        middle = (self.low + self.high) / 2
        turns = np.arccos(np.clip(self.pivots @ self.pivots.T, -1, 1)) if len(self.pivots) else np.zeros((0, 0))
        every = np.arange(len(self.pivot))
        of_pivot = {p: np.flatnonzero(self.pivot == p) for p in np.unique(self.pivot).tolist()}
        out = []
        for c in range(len(self.pivot)):
            # Cells of the own pivot come first, others only count where those hold too few rows.
            near = of_pivot[int(self.pivot[c])]
            near = near if self.rows[near].sum() > k else every
            apart = np.abs(middle[near] - middle[c])
            if self.pivot[c] >= 0 and near is every:
                far = np.where(self.pivot >= 0, turns[self.pivot[c], np.maximum(self.pivot, 0)], np.pi)
                apart = np.where(self.pivot == self.pivot[c], apart, np.pi + far)
            apart[near == c] = -1
            order = near[np.argsort(apart, kind="stable")]
            enough = int(np.searchsorted(np.cumsum(self.rows[order]), k + 1)) + 1
            out.append(order[:enough])
        return out

    def reach(self, unit: np.ndarray) -> np.ndarray:
        """Upper bound of the similarity of each unit row to anything in each cell."""
        angles = np.arccos(np.clip(unit @ self.pivots.T, -1, 1))
        at = angles[:, np.maximum(self.pivot, 0)]
        gap = np.maximum(np.maximum(at - self.high, self.low - at) - ANGLE_SLACK, 0)
        return np.where(self.pivot >= 0, np.cos(gap), 0.0)

    def reached(self, unit: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Which cells can hold something as near to each unit row as its ``kth`` similarity.

        The bound of ``reach`` in angles; besides, all rows of a pivot are at least half as far from a query as
        that pivot is farther from it than its nearest one. Cells are looked at only where their pivot is in reach.
        """
        wanted = kth - SIMILARITY_SLACK
        need = np.zeros((len(unit), len(self.pivot)), bool)
        need[:, self.pivot < 0] = (wanted <= 0)[:, None]
        own = np.flatnonzero(self.pivot >= 0)
        if not len(own):
            return need
        turn = np.where(wanted > -1, np.arccos(np.clip(wanted, -1, 1)), np.inf)[:, None] + ANGLE_SLACK
        angles = np.arccos(np.clip(unit @ self.pivots.T, -1, 1))
        low, high = np.full(len(self.pivots), np.inf), np.full(len(self.pivots), -np.inf)
        np.minimum.at(low, self.pivot[own], self.low[own])
        np.maximum.at(high, self.pivot[own], self.high[own])
        beyond = (angles - angles.min(axis=1, keepdims=True)) / 2
        near = np.maximum(np.maximum(angles - high, low - angles), beyond) <= turn
        cells = own[near.any(axis=0)[self.pivot[own]]]
        at = angles[:, self.pivot[cells]]
        gap = np.maximum(at - self.high[cells], self.low[cells] - at)
        need[:, cells] = (gap <= turn) & near[:, self.pivot[cells]]
        return need


def dealt(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of about ``most`` rows: for each cell its first block and how many it has. Small neighbouring cells share one."""
    first, blocks = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at = held = 0
    for c, n in enumerate(counts.tolist()):
        if held and held + n > most:
            at, held = at + 1, 0
        first[c], held = at, held + n
        if n > most:
            blocks[c] = -(-n // most)
            at, held = at + int(blocks[c]), 0
    return first, blocks


@dataclass(frozen=True)
class Search:
    """Hits, and the pairs of rows that the bounds leave to be compared of all that there are."""

    hits: DataFrame
    compared: int
    possible: int


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` unit vectors: rows far from each other, moved to the middle of what is nearest to them."""
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return unit
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-12:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, unit @ unit[far])
    pivots = unit[chosen]
    for _ in range(PIVOT_ROUNDS):
        own = (unit @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, own, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), pivots)
    return pivots


def _rows(df: DataFrame, id_col: str, vec_col: str, label_col: str | None, dim: int) -> DataFrame:
    labels = F.col(label_col) if label_col else F.lit(None).cast("array<string>")
    return df.select(
        F.col(id_col).alias("id"),
        with_length(F.col(vec_col).cast("array<float>"), dim, vec_col).alias("vec"),
        labels.cast("array<string>").alias("labels"),
        F.xxhash64(id_col).alias("mix"),
    )


def _placed(rows: DataFrame, pivots: np.ndarray, numbers: np.ndarray) -> DataFrame:
    """``rows`` with the number of the nearest pivot and the angle to it; -1 and 0 for a vector of zeros."""
    schema = T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = Q._unit(batch.column(1).flatten(), batch.num_rows) if batch.num_rows else np.zeros((0, pivots.shape[1]))
            cosines = unit @ pivots.T
            own = cosines.argmax(axis=1)
            angle = np.arccos(np.clip(cosines[np.arange(len(own)), own], -1, 1))
            zero = ~unit.any(axis=1)
            columns = [pa.array(np.where(zero, -1, numbers[own]).astype(np.int32)), pa.array(np.where(zero, 0.0, angle))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)

    return rows.mapInArrow(place, schema)


def _shells(corpus: DataFrame, block_rows: int) -> dict[int, list[float]]:
    """Per pivot the angles that cut its rows into shells of about equal counts, one shell for each block."""
    share = [i / SHELLS for i in range(1, SHELLS)]
    rows = corpus.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("angle", share, 2000).alias("at")
    )
    cuts = {}
    for row in rows.collect():
        n = min(SHELLS, ceil(row["n"] / block_rows))
        cuts[row["pivot"]] = sorted({row["at"][i * SHELLS // n - 1] for i in range(1, n)})
    return cuts


def _with_shell(rows: DataFrame, cuts: dict[int, list[float]]) -> DataFrame:
    """``shell``: how many cuts of its pivot lie below a row's angle. The cuts are at most ``PIVOTS * SHELLS`` numbers."""
    known = rows.sparkSession.createDataFrame([(p, c) for p, c in cuts.items()], "pivot int, cuts array<double>")
    shell = F.size(F.filter("cuts", lambda c: c < F.col("angle")))
    return rows.join(F.broadcast(known), "pivot").withColumn("shell", shell).drop("cuts")


def _with_cell(rows: DataFrame, cuts: dict[int, list[float]], cells: Cells) -> DataFrame:
    """``cell`` of each row in the place of its pivot, angle and shell."""
    table = []
    for pivot, some in cuts.items():
        own = np.flatnonzero(cells.pivot == pivot)
        edges = [-np.inf, *some, np.inf]
        for shell in range(len(some) + 1):
            # A shell without corpus rows counts as the nearest that has some.
            low, high = edges[shell], edges[shell + 1]
            gap = np.maximum(np.maximum(cells.low[own] - high, low - cells.high[own]), 0)
            inside = (cells.low[own] >= low) & (cells.high[own] <= high)
            c = int(own[np.lexsort((~inside, gap))[0]])
            table.append((pivot, shell, c))
    known = rows.sparkSession.createDataFrame(table, "pivot int, shell int, cell int")
    found = _with_shell(rows, cuts).join(F.broadcast(known), ["pivot", "shell"])
    return found.drop("pivot", "angle", "shell")


def _with_block(rows: DataFrame, first: np.ndarray, blocks: np.ndarray, name: str) -> DataFrame:
    """The block ``name`` of each row by its cell; rows of a cell that has several are dealt out by a hash."""
    table = [(c, int(first[c]), int(blocks[c])) for c in range(len(first))]
    known = rows.sparkSession.createDataFrame(table, "cell int, first long, n long")
    found = rows.join(F.broadcast(known), "cell")
    return found.withColumn(name, F.col("first") + F.pmod("mix", "n")).drop("first", "n", "mix")


def _blocks(rows: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """One row per block: the ids in order, all vectors in one flat array, and the other ``fields`` as lists."""
    members = F.sort_array(F.collect_list(F.struct("id", *fields))).alias("rows")
    others = [F.col(f"rows.{f}").alias(f"{name}_{f}") for f in fields if f != "vec"]
    return rows.groupBy(name).agg(members).select(
        name,
        F.col("rows.id").alias(f"{name}_ids"),
        F.flatten("rows.vec").alias(f"{name}_vecs"),
        *others,
    )


def _cells(corpus: DataFrame, cuts: dict[int, list[float]], pivots: np.ndarray, block_rows: int) -> Cells:
    rows = (
        _with_shell(corpus, cuts).groupBy("pivot", "shell")
        .agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count(F.lit(1)).alias("n"))
        .orderBy("pivot", "shell").collect()
    )  # at most a row for each cell
    column = lambda name, kind: np.array([r[name] for r in rows], kind)
    return Cells(pivots, column("pivot", int), column("low", float), column("high", float), column("n", np.int64), block_rows)


def _needed(batch: pa.RecordBatch, i: int, cells: Cells, homes: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For slices of the rows of a query block: the first row, and which cells each row meets.

    In the first round its home, in the second, which knows the k-th similarities, those beyond that can reach them.
    """
    own = batch.column("q_cell")[i].values.to_numpy(zero_copy_only=False)
    later = "q_kth" in batch.schema.names
    if later:
        kth = batch.column("q_kth")[i].values.to_numpy(zero_copy_only=False)
        unit = Q._unit(batch.column("q_vecs")[i].values, len(own))
    for start in range(0, len(own), _ROWS):
        part = slice(start, start + _ROWS)
        cell = own[part]
        need = cells.reached(unit[part], kth[part]) if later else np.zeros((len(cell), len(cells.pivot)), bool)
        for c in np.unique(cell).tolist():
            need[np.ix_(cell == c, homes[c])] = not later
        yield start, need


def _visits(blocks: DataFrame, cells: Cells, homes: list[np.ndarray], first: np.ndarray, tiles: np.ndarray) -> DataFrame:
    """For each query block and tile of the corpus that holds a cell which one of its rows meets: these rows, and which cells each meets."""
    fields = [blocks.schema[f] for f in ("q_ids", "q_vecs", "q_labels", "q_cell")]
    ints, doubles = T.ArrayType(T.IntegerType()), T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [T.StructField("q", T.LongType()), *fields, T.StructField("q_kth", doubles), T.StructField("q_at", ints),
         T.StructField("q_met", T.BinaryType()), T.StructField("tile_cells", ints), T.StructField("c", T.LongType())]
    )
    last = first + tiles
    n_tiles = int(last.max(initial=0))
    # The cells of each tile: those that share it, or the one that fills several.
    inside = [[] for _ in range(n_tiles)]
    for c in range(len(first)):
        for t in range(int(first[c]), int(last[c])):
            inside[t].append(c)
    inside = [np.array(x, np.int32) for x in inside]

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q_vecs, q_labels, q_cell = (batch.column(f.name)[i].values for f in fields)
                kth = np.full(len(q_ids), -np.inf)
                if "q_kth" in batch.schema.names:
                    kth = batch.column("q_kth")[i].values.to_numpy(zero_copy_only=False)
                flat = q_vecs.to_numpy(zero_copy_only=False).reshape(len(q_ids), -1)
                need = np.concatenate([n for _, n in _needed(batch, i, cells, homes)])
                met = np.flatnonzero(need.any(axis=0))
                own_cell = q_cell.to_numpy(zero_copy_only=False)
                out, size = [], 0
                for t in np.unique(np.concatenate([np.arange(first[c], last[c]) for c in met])).tolist() if len(met) else []:
                    held = inside[t][need[:, inside[t]].any(axis=0)]
                    rows = np.flatnonzero(need[:, held].any(axis=1))
                    # Rows of one cell lie together, so that they are multiplied with the same cells.
                    rows = rows[np.argsort(own_cell[rows], kind="stable")]
                    at = pa.array(rows)
                    bits = np.packbits(need[np.ix_(rows, held)], axis=1).tobytes()
                    out.append((batch.column("q")[i].as_py(), q_ids.take(at), flat[rows].reshape(-1), q_labels.take(at),
                                q_cell.take(at), kth[rows], rows, bits, held, t))
                    size += rows.size * flat.shape[1] * flat.itemsize
                    if len(out) == 64 or size > Q.BLOCK_BYTES:
                        yield _batch(out, schema)
                        out, size = [], 0
                if out:
                    yield _batch(out, schema)

    return blocks.mapInArrow(visits, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    """Rows whose lists are arrays as an Arrow batch."""
    from pyspark.sql.pandas.types import to_arrow_type

    columns = []
    for values, field in zip(zip(*rows), schema.fields):
        if not isinstance(field.dataType, T.ArrayType):
            columns.append(pa.array(values, to_arrow_type(field.dataType)))
            continue
        kind = to_arrow_type(field.dataType.elementType)
        lists = [v if isinstance(v, pa.Array) else pa.array(v, kind) for v in values]
        ends = np.concatenate([[0], np.cumsum([len(v) for v in lists])])
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(lists)))
    return pa.RecordBatch.from_arrays(columns, schema.names)


def _tile_products(pairs: DataFrame, k: int, id_type: T.DataType) -> DataFrame:
    """The nearest rows that each visiting query finds in the cells that it meets; not ranked, as of ``block_products``."""
    schema = Q.hits_schema(id_type)

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Q.BestHits(k, schema)
        kept: dict[int, tuple] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                column = lambda name: batch.column(name)[i].values
                tile, block = batch.column("c")[i].as_py(), batch.column("q")[i].as_py()
                if tile not in kept:
                    c_ids = column("c_ids")
                    units = Q.Units(column("c_vecs"), len(c_ids))
                    if sum(u.double.nbytes for _, u, *_ in kept.values()) > KEPT_BYTES:
                        kept = {}
                    kept[tile] = (
                        c_ids, units, column("c_labels"), c_ids.to_numpy(zero_copy_only=False),
                        column("c_cell").to_numpy(zero_copy_only=False),
                    )
                c_ids, units, c_labels, c_keys, c_cell = kept[tile]
                q_ids, q_labels, held, at, kth = (column(n) for n in ("q_ids", "q_labels", "tile_cells", "q_at", "q_kth"))
                queries, q_keys = Q.Units(column("q_vecs"), len(q_ids)), q_ids.to_numpy(zero_copy_only=False)
                held, at, kth = (x.to_numpy(zero_copy_only=False) for x in (held, at, kth))
                met = np.frombuffer(batch.column("q_met")[i].as_py(), np.uint8).reshape(len(q_ids), -1)
                met = np.unpackbits(met, axis=1, count=len(held)).astype(bool)
                place = np.searchsorted(held, c_cell)
                known = held[np.minimum(place, len(held) - 1)] == c_cell
                floor = np.maximum(kth, best.floor(block, int(at.max()) + 1)[at])
                found = []
                for start in range(0, len(q_ids), PRODUCT_ROWS):
                    part = slice(start, start + PRODUCT_ROWS)
                    some = np.append(met[part].any(axis=0), False)
                    cols = np.flatnonzero(some[np.where(known, place, len(held))])
                    if not len(cols):
                        continue
                    hidden = ~met[part][:, place[cols]]
                    hidden[Q.hide_same(q_keys[part], c_keys[cols])] = True
                    rows, near, sims = Q.near_columns(queries, part, units, cols, k, hidden, floor[part])
                    found.append((rows + start, cols[near], sims))
                if not found:
                    continue
                rows, cols, sims = (np.concatenate(x) for x in zip(*found))
                own, near = pa.array(rows), pa.array(cols)
                best.add(block, at[rows], sims, [q_ids.take(own), c_ids.take(near), q_labels.take(own), c_labels.take(near)])
                if best.held > Q.HELD_HITS:
                    yield from best.flush()
        yield from best.flush()

    return pairs.mapInArrow(product, schema)


def _compared(blocks: DataFrame, cells: Cells, homes: list[np.ndarray]) -> int:
    """Pairs of rows of both rounds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for i in range(batch.num_rows):
                total += sum(int(cells.rows[homes[c]].sum()) for c in batch.column("q_cell")[i].values.to_pylist())
                total += sum(int((need @ cells.rows).sum()) for _, need in _needed(batch, i, cells, homes))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    return blocks.mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def pruned_neighbours(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "function_id",
    vec_col: str = "embedding",
    label_col: str | None = None,
    block_rows: int = Q.BLOCK_ROWS,
    broadcast_bytes: int = 64 << 20,
    worth: float = WORTH,
) -> Search | None:
    """The rows of ``retrieval.top_k_neighbours`` by cells and bounds; None if that compares more than ``worth`` of all pairs.

    Equal vectors are one place: the ``k + 1`` smallest ids of each stand for all, because no query has more of
    them among its ``k``. Vectors of zeros are as near to everything; as queries they get the smallest ids.
    An empty side gives no hits.
    """
    spark = corpus.sparkSession
    id_type = corpus.schema[id_col].dataType
    dim = corpus.agg(F.coalesce(F.max(F.size(vec_col)), F.lit(0))).first()[0]
    if not dim:
        return None
    rows = _rows(corpus, id_col, vec_col, label_col, dim)
    sample = rows.orderBy("mix", "id").limit(min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (4 * dim)))).select("vec").toArrow()
    flat = sample.column(0).combine_chunks()
    n_blocks = ceil(corpus.count() / block_rows)
    pivots = choose_pivots(flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim).astype(np.float64), min(PIVOTS, n_blocks))
    if not len(pivots):
        return None
    placed = stored(_placed(rows, pivots, np.arange(len(pivots))), "placed-corpus")
    copies = Window.partitionBy(F.xxhash64("vec"), "vec").orderBy("id")
    kept = stored(placed.withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).drop("nth"), "distinct-corpus")
    cuts = _shells(kept, block_rows)
    cells = _cells(kept, cuts, pivots, block_rows)
    homes = cells.homes(k)

    used = np.unique(cells.pivot[cells.pivot >= 0])
    asked = placed if queries is corpus else stored(
        _placed(_rows(queries, id_col, vec_col, label_col, dim), pivots[used], used), "placed-queries"
    )
    zero = asked.where("pivot = -1")
    asked = asked.where("pivot >= 0")
    asked = _with_cell(asked, {p: c for p, c in cuts.items() if p >= 0}, cells)
    counts = np.zeros(len(cells.pivot), np.int64)
    for row in asked.groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    # Enough blocks for all tasks, and not smaller than those of the corpus.
    share = ceil(int(counts.sum()) / (2 * spark.sparkContext.defaultParallelism))
    asked = _with_block(asked, *dealt(counts, min(CHUNK_ROWS, max(block_rows, share))), "q")

    tiles = dealt(cells.rows, min(Q.BLOCK_ROWS, max(1, Q.BLOCK_BYTES // (4 * dim))))
    right = _blocks(_with_block(_with_cell(kept, cuts, cells), *tiles, "c"), "c", ["vec", "labels", "cell"])
    n = int(cells.rows.sum())
    small = n * (4 * dim + 64) <= broadcast_bytes
    right = F.broadcast(right) if small else right

    def round_of(blocks: DataFrame) -> DataFrame:
        return _tile_products(_visits(blocks, cells, homes, *tiles).join(right, "c"), k, id_type)

    start = stored(_blocks(asked, "q", ["vec", "labels", "cell"]), "first-blocks")
    first = stored(Q.best_hits(round_of(start), k).drop("rank"), "first-hits")

    kth = first.groupBy("query_id").agg(F.min("similarity").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    asked = asked.join(kth.select(F.col("query_id").alias("id"), "kth"), "id", "left").fillna(-2.0, "kth")
    blocks = stored(_blocks(asked, "q", ["vec", "labels", "cell", "kth"]), "query-blocks")
    compared, possible = _compared(blocks, cells, homes), placed.count() * int(counts.sum())
    if compared > worth * possible:
        return None
    second = round_of(blocks)

    smallest = rows.orderBy("id").limit(k + 1).select(F.col("id").alias("neighbour_id"), F.col("labels").alias("neighbour_labels"))
    flat_hits = zero.select(F.col("id").alias("query_id"), F.col("labels").alias("query_labels"), F.lit(1).alias("one")).join(
        F.broadcast(smallest.withColumn("one", F.lit(1))), "one"
    )
    flat_hits = flat_hits.where("query_id <> neighbour_id").select(
        "query_id", "neighbour_id", F.lit(0.0).alias("similarity"), "query_labels", "neighbour_labels"
    )
    hits = Q.best_hits(first.unionByName(second).unionByName(flat_hits), k)
    columns = ["query_id", "rank", "neighbour_id", "similarity", *(["query_labels", "neighbour_labels"] if label_col else [])]
    return Search(hits.select(*columns), compared, possible)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "function_id",
    vec_col: str = "embedding",
    label_col: str | None = None,
    block_rows: int = Q.BLOCK_ROWS,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """The ``k`` nearest rows, exactly: by cells and bounds in a large corpus, by all block pairs where those do not pay."""
    if corpus.count() > FEWEST_BLOCKS * block_rows:
        found = pruned_neighbours(queries, corpus, k, id_col, vec_col, label_col, block_rows, broadcast_bytes)
        if found:
            return found.hits
    return Q.top_k_neighbours(queries, corpus, k, id_col, vec_col, label_col, block_rows, broadcast_bytes)
