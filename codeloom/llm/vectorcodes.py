"""Vector codes of four parts, with nearest codebook entries by equal-average search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import slices, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Rows of neighbouring sums that search together, and codebook entries that they meet at a time.
TILE = 512
STEP = 32
# Vectors at a time; bounds the arrays of a task.
_AT_ONCE = 20_000
# Label sums that are broadcast; beyond this they are joined by merging.
LABELS = 200_000

ENCODED = "vec_id long, label string, code string, error long"
SUMS = "part int, entry int, members long, total array<long>"


def limit(dimension: int) -> int:
    """Largest component, scaled, for which squared distances of whole vectors surely fit into 64 bits."""
    return isqrt((1 << 60) // max(1, dimension))


def components(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(vec_id, label, x array<long>)``, each component floor(1024 * x).

    Rows whose vector is null or holds a null or non-finite component are left out; so large a component that its
    scaled floor has no 64-bit integer becomes the nearest one.
    """
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    edge = F.lit(2.0**62)
    scaled = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * SCALE, edge), -edge)).cast("long"))
    return vectors.where(F.col(vector).isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), scaled.alias("x")
    )


def cuts(dimension: int) -> list[int]:
    """Where vectors are cut into parts; of a dimension that four does not divide the parts differ by one."""
    return [dimension * i // PARTS for i in range(PARTS + 1)]


class Codebook:
    """The entries of one part in order of their component sums, and the search among them.

    With S and s the sums of a part and an entry, (S - s)^2 is at most the dimension times their squared distance.
    Entries are therefore met from the part's sum outwards, on either side until the squared gap over the
    dimension strictly exceeds the best distance so far. Parts of neighbouring sums go together: what
    one of them does not need any more cannot be nearer.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]
        self.sorted = entries[self.order]
        self.norms = (self.sorted * self.sorted).sum(axis=1)

    def _distances(self, x: np.ndarray, norms: np.ndarray, low: int, high: int, exact: bool) -> np.ndarray:
        some = self.sorted[low:high]
        if exact:
            product = (x.astype(np.float64) @ some.T.astype(np.float64)).astype(np.int64)
        else:
            product = x @ some.T
        return norms[:, None] - 2 * product + self.norms[None, low:high]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row of ``x`` the index of its nearest entry, ties to the lower, the squared distance, and the entries met in all."""
        n, width = x.shape
        if width == 0:
            return np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        most = max(int(np.abs(x).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        # Doubles hold all products as integers; 64 bits hold the squared gaps of sums.
        exact, narrow = 4 * width * most * most < 1 << 53, 4 * width * width * most * most < 1 << 62
        sums = x.sum(axis=1)
        by_sum = np.argsort(sums, kind="stable")
        index = np.empty(n, np.int64)
        distance = np.empty(n, np.int64)
        met = 0
        for a in range(0, n, TILE):
            rows = by_sum[a : a + TILE]
            index[rows], distance[rows], some = self._tile(x[rows], sums[rows], exact, narrow)
            met += some
        return index, distance, met

    def _tile(self, x: np.ndarray, sums: np.ndarray, exact: bool, narrow: bool) -> tuple[np.ndarray, np.ndarray, int]:
        n, width = x.shape
        norms = (x * x).sum(axis=1)
        best = np.full(n, -1)
        index = np.full(n, len(self.entries), np.int64)
        met = 0

        def meet(rows: np.ndarray, low: int, high: int) -> None:
            nonlocal met
            found = self._distances(x[rows], norms[rows], low, high, exact)
            # Columns in order of the entries' indexes, so that the first minimum is the lowest index.
            places = np.argsort(self.order[low:high], kind="stable")
            column = places[found[:, places].argmin(axis=1)]
            least = found[np.arange(len(rows)), column]
            own = self.order[low + column]
            better = (best[rows] < 0) | (least < best[rows]) | (least == best[rows]) & (own < index[rows])
            best[rows[better]] = least[better]
            index[rows[better]] = own[better]
            met += found.size

        everyone = np.arange(n)
        down = int(np.searchsorted(self.sums, sums[n // 2]))
        up = down
        while True:
            # The gap to the next entry on a side bounds all beyond it; the sums of a tile are close, but need not be equal.
            gaps = []
            for place, side in ((down - 1, -1), (up, 1)):
                if 0 <= place < len(self.sums):
                    # No bound while the part's sum lies beyond the next entry.
                    gap = np.maximum(side * (self.sums[place] - sums), 0)
                    open_rows = everyone[_not_beyond(gap, best, width, narrow)]
                else:
                    open_rows = everyone[:0]
                gaps.append(open_rows)
            if not len(gaps[0]) and not len(gaps[1]):
                return index, best, met
            if len(gaps[1]):
                high = min(up + STEP, len(self.sums))
                meet(gaps[1], up, high)
                up = high
            if len(gaps[0]):
                low = max(down - STEP, 0)
                meet(gaps[0], low, down)
                down = low


def _not_beyond(gap: np.ndarray, best: np.ndarray, width: int, narrow: bool) -> np.ndarray:
    """Whether gap^2 / width <= best; without a best distance nothing is beyond."""
    if narrow:
        return (best < 0) | (gap * gap <= best * width)
    # Where 64 bits may not hold the squares: a rounded root, one more than it at most.
    return (best < 0) | (gap <= np.ceil(np.sqrt(np.maximum(best, 0).astype(np.float64) * width) * (1 + 1e-12)) + 1)


@dataclass(frozen=True)
class Codebooks:
    """The entries of all parts: ``parts[p][e]`` is entry e of part position p."""

    dimension: int
    parts: tuple[np.ndarray, ...]

    def sha256(self) -> str:
        numbers = (str(v) for part in self.parts for entry in part.tolist() for v in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The scaled vector that a code stands for."""
        return [v for p, part in enumerate(self.parts) for v in part[int(code[2 * p : 2 * p + 2], 16)].tolist()]


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with a mask of the rows that can be coded and the matrix of those."""
    most = limit(dimension)
    for batch in slices(batches, _AT_ONCE):
        lists = batch.column(batch.schema.get_field_index("x"))
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        fits = lengths == dimension
        flat = lists.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        matrix = flat.reshape(int(fits.sum()), dimension)
        small = np.abs(matrix).max(axis=1, initial=0) <= most
        fits[np.flatnonzero(fits)[~small]] = False
        yield batch, fits, matrix[small]


def _assigned(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list]]:
    search = [Codebook(part) for part in books.parts]
    edges = cuts(books.dimension)
    for batch, fits, matrix in _blocks(batches, books.dimension):
        parts = [np.ascontiguousarray(matrix[:, a:z]) for a, z in zip(edges, edges[1:])]
        yield batch, fits, matrix, [(x, *book.nearest(x)[:2]) for x, book in zip(parts, search)]


def _renewed(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: tasks assign their vectors and send a row of sums for each entry that they use."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = [np.zeros(len(part), np.int64) for part in books.parts]
        totals = [np.zeros(part.shape, np.int64) for part in books.parts]
        for _, _, _, found in _assigned(batches, books):
            for p, (x, index, _) in enumerate(found):
                # Rows in order of their entries, so that one reduction adds them up.
                order = np.argsort(index, kind="stable")
                entries, starts = np.unique(index[order], return_index=True)
                if len(entries):
                    members[p][entries] += np.diff([*starts, len(order)])
                    totals[p][entries] += np.add.reduceat(x[order], starts, axis=0)
        rows = [(p, e, int(members[p][e]), totals[p][e].tolist()) for p in range(PARTS) for e in np.flatnonzero(members[p]).tolist()]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "entry", "members", "total"])

    width = max(part.shape[1] for part in books.parts)
    added = rows.mapInArrow(sums, SUMS).groupBy("part", "entry").agg(
        F.sum("members").alias("members"), F.array(*(F.sum(F.get("total", F.lit(i))) for i in range(width))).alias("total")
    )
    parts = [part.copy() for part in books.parts]
    # At most an entry of each part, whatever the input: the model itself.
    for row in added.collect():
        own = parts[row.part]
        own[row.entry] = np.array(row.total[: own.shape[1]], np.int64) // row.members
    return Codebooks(books.dimension, tuple(parts))


def fit(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``rows(vec_id, x)``; None of an empty table.

    The dimension is the most frequent one. Codebooks start as the parts of the ``entries`` smallest vec_ids,
    equal ids by their components, rows without an id last. Only the codebooks reach the driver.
    """
    sizes = rows.groupBy(F.size("x").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return None
    dimension = common["size"]
    most = limit(dimension)
    usable = rows.where((F.size("x") == dimension) & F.forall("x", lambda v: F.abs(v) <= most))
    first = usable.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    matrix = np.array([r.x for r in first], np.int64).reshape(len(first), dimension)
    if not len(first):
        return None
    edges = cuts(dimension)
    books = Codebooks(dimension, tuple(np.ascontiguousarray(matrix[:, a:z]) for a, z in zip(edges, edges[1:])))
    for _ in range(rounds if dimension else 0):
        books = _renewed(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``(vec_id, label, code, error)``: two hex digits a part, and the squared distance to what they stand for.

    Rows of another dimension, or with a component beyond ``limit``, have a null code and error.
    """

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, fits, matrix, found in _assigned(batches, books):
            n = batch.num_rows
            error = np.zeros(n, np.int64)
            error[fits] = sum(d for _, _, d in found)
            digits = np.stack([i for _, i, _ in found], axis=1).astype(np.uint8) if len(matrix) else np.zeros((0, PARTS), np.uint8)
            text = iter(digits.tobytes().hex()[i : i + 2 * PARTS] for i in range(0, 2 * PARTS * len(digits), 2 * PARTS))
            code = [next(text) if f else None for f in fits.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64(), mask=~fits)],
                ["vec_id", "label", "code", "error"],
            )

    return rows.select("vec_id", "label", "x").mapInArrow(codes, ENCODED)


def compressed(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Codes of ``vectors(vec_id, embedding, label)`` with ``label_error``, and the codebooks.

    Rows whose vector is null or holds a null or non-finite component are dropped. Rows that repeat a vec_id all
    stay; a null vec_id is no start of a codebook unless others run out; null labels are one label; an empty vector has a
    code if most are empty. Other columns are not read. Fewer rows than ``entries`` make smaller codebooks; an
    empty table gives an empty one and no codebooks. ``entries`` is at most 256, as a part has two digits.
    """
    rows = written(components(vectors), "vector-components")
    books = fit(rows, entries, rounds)
    if books is None:
        none = rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return none.withColumn("label_error", F.lit(None).cast("long")), None
    coded = written(encode(rows, books), "vector-codes")
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "label-errors")
    # A label may have a third of all rows; small sums go to the rows, many labels leave none so large that AQE cannot split it.
    sums = F.broadcast(sums) if sums.count() <= LABELS else sums.hint("merge")
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"]), "left").drop("_label"), books


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = F.lit(books.sha256() if books else None).cast("string")
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql() -> str:
    """All rounds spelled out: every part against every entry."""
    assign = """
, near{n} AS MATERIALIZED (
  SELECT vec_id, p, min(e) FILTER (d = least) AS e, any_value(least) AS d FROM (
    SELECT *, min(d) OVER (PARTITION BY vec_id, p) AS least FROM (
      SELECT x.vec_id, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
      FROM parts x JOIN book{n} b ON x.p = b.p
    )
  ) GROUP BY vec_id, p
)"""
    renew = """
, book{m} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(f.v, b.v) AS v FROM book{n} b LEFT JOIN (
    SELECT p, e, list(floor(s / n)::BIGINT ORDER BY j) AS v FROM (
      SELECT p, e, j, sum(c)::DOUBLE AS s, count(*) AS n FROM (
        SELECT x.p, near{n}.e, unnest(x.v) AS c, unnest(range(len(x.v))) AS j
        FROM parts x JOIN near{n} ON x.vec_id = near{n}.vec_id AND x.p = near{n}.p
      ) GROUP BY p, e, j
    ) GROUP BY p, e
  ) f ON f.p = b.p AND f.e = b.e
)"""
    head = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, x[p * len(x) // 4 + 1 : (p + 1) * len(x) // 4] AS v FROM kept, (VALUES (0), (1), (2), (3)) q(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
)"""
    tail = """
, coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near4 GROUP BY vec_id
), final AS (
  SELECT sha256(string_agg(list_aggregate(v, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book4
)
SELECT k.vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept k JOIN coded USING (vec_id) CROSS JOIN final
"""
    steps = "".join(assign.format(n=n) + renew.format(n=n, m=n + 1) for n in range(ROUNDS))
    return head + steps + assign.format(n=ROUNDS) + tail


OP11_SQL = _sql()
