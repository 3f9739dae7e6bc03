"""Exact nearest neighbours by cosine and the retrieval metrics over them."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.effects import relevant
from codeloom.functions.vectors import with_length

# Rows and bytes of vectors per block at most.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
# Query blocks that share a key with one corpus block when both sides are shuffled.
GROUP_BLOCKS = 8
# Rows of a block that are multiplied at once; bounds the similarity matrix.
SLICE_ROWS = 512
# Similarities are compared after rounding, so equal vectors tie exactly.
SIMILARITY_DECIMALS = 9
# Components up to which double precision costs no more.
SHORT = 16
# Groups of columns, for each neighbour wanted, whose maxima bound the k-th similarity from below.
GROUPS = 16
# Share of a matrix of similarities from which on all are taken in double precision.
MANY = 0.05
# Hits that a task holds before it passes them on.
HELD_HITS = 200_000


def _unit(flat: pa.Array, n: int) -> np.ndarray:
    """Unit rows of a block whose vectors lie one after the other in ``flat``."""
    matrix = flat.to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


def best_of_block(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` best entries per row, best first.

    Entries of -inf never count; on a tie the smaller column comes first.
    """
    n_rows, n_cols = sims.shape
    kth = min(k, n_cols)
    floor = np.partition(sims, n_cols - kth, axis=1)[:, n_cols - kth]
    rows, cols = np.nonzero((sims >= floor[:, None]) & np.isfinite(sims))
    order = np.lexsort((cols, -sims[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(n_rows))
    rank = np.arange(len(rows)) - starts[rows]
    keep = rank < k
    return rows[keep], cols[keep]


class Units:
    """Unit vectors of a block in double precision, and in single where that saves time."""

    def __init__(self, flat: pa.Array, n: int):
        self.double = _unit(flat, n)
        self.rough = self.double.astype(np.float32) if self.double.shape[1] > SHORT else self.double
        self.finite = bool(np.isfinite(self.rough).all())


def near_columns(
    queries: Units, part: slice | np.ndarray, corpus: Units, of: slice | np.ndarray, k: int, hidden, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and rounded similarities of the ``k`` best entries per row that reach the row's ``floor``.

    ``hidden`` indexes the entries that do not count; on a tie the smaller column comes first. Single precision tells
    which entries may be among the best, double precision ranks these.
    """
    q_unit, c_unit = queries.double[part], corpus.double[of]
    if queries.finite and corpus.finite:
        sims = queries.rough[part] @ corpus.rough[of].T
        sims[hidden] = -np.inf
        low = np.maximum(floor, -2.0)
        groups = GROUPS * k
        width = len(c_unit) // groups
        if width > 1:
            best = sims[:, : groups * width].reshape(len(sims), width, groups).max(axis=1)
            low = np.maximum(low, np.partition(best, groups - k, axis=1)[:, groups - k])
        # Twice what rounding of the components, of the sum and of the result may move a similarity.
        slack = 2 * (c_unit.shape[1] + 16) * np.finfo(sims.dtype).eps + 2 * 10.0**-SIMILARITY_DECIMALS
        rows, cols = np.nonzero(sims >= (low - slack).astype(sims.dtype)[:, None])
        if len(rows) <= max(MANY * sims.size, 4 * k * len(sims)):
            exact = sims[rows, cols] if sims.dtype == np.float64 else np.einsum("ij,ij->i", q_unit[rows], c_unit[cols])
            exact = np.round(exact, SIMILARITY_DECIMALS)
            order = np.lexsort((cols, -exact, rows))
            rows, cols, exact = rows[order], cols[order], exact[order]
            rank = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(sims)))[rows]
            keep = (rank < k) & (exact >= floor[rows])
            return rows[keep], cols[keep], exact[keep]
    sims = np.round(q_unit @ c_unit.T, SIMILARITY_DECIMALS)
    sims[hidden] = -np.inf
    rows, cols = best_of_block(sims, k)
    found = sims[rows, cols]
    keep = found >= floor[rows]
    return rows[keep], cols[keep], found[keep]


class BestHits:
    """Hits of the query blocks that a task meets; of each row those that reach its ``k``-th similarity so far.

    Ties stay, so that whoever ranks the hits can decide them by id.
    """

    def __init__(self, k: int, schema: T.StructType):
        self.k, self.schema = k, schema
        self.floors: dict[int, np.ndarray] = {}
        self.hits: dict[int, tuple] = {}
        self.held = 0

    def floor(self, block: int, rows: int) -> np.ndarray:
        """What a hit of each of the first ``rows`` rows of a block has to reach."""
        known = self.floors.get(block, np.empty(0))
        if len(known) < rows:
            known = self.floors[block] = np.concatenate([known, np.full(rows - len(known), -np.inf)])
        return known

    def add(self, block: int, at: np.ndarray, sims: np.ndarray, columns: list[pa.Array]) -> None:
        """Hits of rows ``at``; ``columns``: ids of query and neighbour, labels of both."""
        if block in self.hits:
            old_at, old_sims, old = self.hits[block]
            self.held -= len(old_at)
            at, sims = np.concatenate([old_at, at]), np.concatenate([old_sims, sims])
            columns = [pa.concat_arrays([a, b]) for a, b in zip(old, columns)]
        order = np.lexsort((-sims, at))
        at, sims = at[order], sims[order]
        floor = self.floor(block, int(at[-1]) + 1 if len(at) else 0)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        full = first[np.diff(first, append=len(at)) >= self.k]
        floor[at[full]] = np.maximum(floor[at[full]], sims[full + self.k - 1])
        keep = sims >= floor[at]
        kept = pa.array(order[keep])
        self.hits[block] = at[keep], sims[keep], [c.take(kept) for c in columns]
        self.held += int(keep.sum())

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            query, near, query_labels, near_labels = (
                pa.concat_arrays([h[2][i] for h in self.hits.values()]) for i in range(4)
            )
            sims = pa.array(np.concatenate([h[1] for h in self.hits.values()]))
            yield pa.RecordBatch.from_arrays([query, near, sims, query_labels, near_labels], self.schema.names)
        self.hits, self.held = {}, 0


def hits_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("neighbour_id", id_type),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("query_labels", T.ArrayType(T.StringType())),
            T.StructField("neighbour_labels", T.ArrayType(T.StringType())),
        ]
    )


def hide_same(q_keys: np.ndarray, c_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns where a query meets itself."""
    _, rows, cols = np.intersect1d(q_keys, c_keys, return_indices=True)
    return rows, cols


def _blocks(df: DataFrame, id_col: str, vec_col: str, label_col: str | None, n: int, name: str, dim: int):
    """One row per block of about ``BLOCK_ROWS`` rows: ids in order, all vectors in
    one flat array, label lists.

    Blocks come from a hash of the unique id, so no value of the data can make
    one of them large.
    """
    labels = F.col(label_col) if label_col else F.lit(None).cast("array<string>")
    row = F.struct(
        F.col(id_col).alias("id"),
        with_length(F.col(vec_col).cast("array<float>"), dim, vec_col).alias("vec"),
        labels.alias("labels"),
    )
    block = F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias(name)
    return (
        df.groupBy(block)
        .agg(F.sort_array(F.collect_list(row)).alias("_rows"))
        .select(
            name,
            F.transform("_rows", lambda r: r["id"]).alias(f"{name}_ids"),
            F.flatten(F.transform("_rows", lambda r: r["vec"])).alias(f"{name}_vecs"),
            F.transform("_rows", lambda r: r["labels"]).alias(f"{name}_labels"),
        )
    )


def block_products(pairs: DataFrame, k: int, id_type: T.DataType) -> DataFrame:
    """The nearest rows of the corpus blocks for every row of the query block ``q`` beside them, not ranked.

    At least the ``k`` best of what a task meets, and more only where similarities tie or a task meets a block again
    after it passed hits on.
    """
    schema = hits_schema(id_type)

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestHits(k, schema)
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q_vecs, q_labels, c_ids, c_vecs, c_labels = (
                    batch.column(f"{side}_{part}")[i].values
                    for side in "qc"
                    for part in ("ids", "vecs", "labels")
                )
                block = batch.column("q")[i].as_py()
                q_unit, c_unit = Units(q_vecs, len(q_ids)), Units(c_vecs, len(c_ids))
                q_keys, c_keys = (x.to_numpy(zero_copy_only=False) for x in (q_ids, c_ids))
                floor = best.floor(block, len(q_ids))
                found = []
                for start in range(0, len(q_ids), SLICE_ROWS):
                    part = slice(start, start + SLICE_ROWS)
                    same = hide_same(q_keys[part], c_keys)
                    rows, cols, sims = near_columns(q_unit, part, c_unit, slice(None), k, same, floor[part])
                    found.append((rows + start, cols, sims))
                rows, cols, sims = (np.concatenate(x) for x in zip(*found))
                at, near = pa.array(rows), pa.array(cols)
                best.add(block, rows, sims, [q_ids.take(at), c_ids.take(near), q_labels.take(at), c_labels.take(near)])
                if best.held > HELD_HITS:
                    yield from best.flush()
        yield from best.flush()

    return pairs.mapInArrow(product, schema)


def best_hits(found: DataFrame, k: int) -> DataFrame:
    """``found`` with ``rank``, the best ``k`` of each query: descending similarity, then the smaller id."""
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k_neighbours(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    id_col: str = "function_id",
    vec_col: str = "embedding",
    label_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``(query_id, rank, neighbour_id, similarity)`` for the ``k`` nearest rows.

    Descending cosine, the query itself left out by key, ties to the smaller id.
    With ``label_col`` the label lists of both sides travel along, which spares
    two joins later. Both sides are cut into blocks, every query block meets every
    corpus block in an equi-join on the block number, a matrix product gives the
    local best ``k``, and a window keeps the best of those. Corpus blocks are
    broadcast only when their measured size is below ``broadcast_bytes``.
    """
    id_type = corpus.schema[id_col].dataType
    labels = F.col(label_col) if label_col else F.lit(None).cast("array<string>")
    size = corpus.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.size(vec_col)), F.lit(0)).alias("d"),
        F.coalesce(F.sum(F.length(F.col(id_col).cast("string")) + F.coalesce(F.length(F.array_join(labels, "")), F.lit(0))), F.lit(0)).alias("extra"),
    ).first()
    dim = size["d"]
    n_corpus = max(1, ceil(size["n"] / min(block_rows, max(1, BLOCK_BYTES // (4 * max(dim, 1))))))
    n_query = max(
        n_corpus,
        queries.sparkSession.sparkContext.defaultParallelism,
    )
    right = _blocks(corpus, id_col, vec_col, label_col, n_corpus, "c", dim)
    left = _blocks(queries, id_col, vec_col, label_col, n_query, "q", dim).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(n_corpus - 1)))
    )
    if size["n"] * (dim * 4 + 64) + 2 * size["extra"] <= broadcast_bytes:
        pairs = left.join(F.broadcast(right), "c").drop("c")
    else:
        groups = ceil(n_query / GROUP_BLOCKS)
        left = left.withColumn("g", F.floor(F.col("q") / GROUP_BLOCKS).cast("int"))
        right = right.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        pairs = left.join(right, ["c", "g"]).drop("c", "g")

    ranked = best_hits(block_products(pairs, k, id_type), k)
    columns = ["query_id", "rank", "neighbour_id", "similarity"]
    return ranked.select(
        *columns, *(["query_labels", "neighbour_labels"] if label_col else [])
    )


def with_relevance(hits: DataFrame) -> DataFrame:
    """Add ``rel``: query and neighbour share a label."""
    return hits.withColumn("rel", relevant(F.col("query_labels"), F.col("neighbour_labels")))


def mrr_at_k(hits: DataFrame, queries: DataFrame, id_col: str, k: int = 5) -> DataFrame:
    """Per query: 1 / rank of the first relevant neighbour up to ``k``, else 0."""
    found = (
        with_relevance(hits)
        .where((F.col("rank") <= k) & F.col("rel"))
        .groupBy("query_id")
        .agg(F.max(1.0 / F.col("rank")).alias("_mrr"))
    )
    return (
        queries.select(F.col(id_col).alias("query_id"))
        .join(found, "query_id", "left")
        .select("query_id", F.coalesce("_mrr", F.lit(0.0)).alias("mrr"))
    )


def _label_sets(df: DataFrame, label_col: str) -> DataFrame:
    """Distinct label sets with their row counts; rows collapse before the shuffle."""
    return df.groupBy(F.array_sort(F.array_distinct(F.col(label_col))).alias("_set")).agg(
        F.count(F.lit(1)).alias("_rows")
    )


def relevant_counts_by_set(df: DataFrame, label_col: str) -> DataFrame:
    """``(_set, _others)``: rows that share a label with each distinct label set.

    Rows collapse to distinct sets first, so only different sets meet over their labels; a
    pair of sets that shares several labels counts once. The work depends on how many
    different sets there are, not on rows or on the size of a set.
    """
    sets = _label_sets(df, label_col).where(F.size("_set") > 0)
    tagged = sets.select("_set", "_rows", F.explode("_set").alias("_label"))
    other = tagged.select("_label", F.col("_set").alias("_other"), F.col("_rows").alias("_n"))
    pairs = tagged.select("_set", "_label").join(other, "_label").select("_set", "_other", "_n").distinct()
    return pairs.groupBy("_set").agg(F.sum("_n").alias("_others"))


def relevant_count(df: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Per row: number of *other* rows that share a label."""
    by_set = relevant_counts_by_set(df, label_col)
    return (
        df.select(
            F.col(id_col).alias("query_id"),
            F.array_sort(F.array_distinct(F.col(label_col))).alias("_set"),
        )
        .join(by_set, "_set", "left")
        .select(
            "query_id", F.greatest(F.coalesce("_others", F.lit(1)) - 1, F.lit(0)).alias("n_relevant")
        )
    )


def recall_at_k(hits: DataFrame, n_relevant: DataFrame, k: int) -> DataFrame:
    """Per query: relevant hits up to ``k`` over min(relevant, k); 0 if none exist."""
    got = (
        with_relevance(hits)
        .groupBy("query_id")
        .agg(F.count_if(F.col("rel") & (F.col("rank") <= k)).alias("_got"))
    )
    return n_relevant.join(got, "query_id", "left").select(
        "query_id",
        F.when(
            F.col("n_relevant") > 0,
            F.coalesce("_got", F.lit(0)) / F.least("n_relevant", F.lit(k)),
        )
        .otherwise(0.0)
        .alias("recall"),
    )


def per_query_metrics(
    df: DataFrame,
    hits: DataFrame,
    id_col: str,
    label_col: str,
    ks: tuple[int, ...] = (3, 5),
    mrr_k: int = 5,
) -> DataFrame:
    """MRR and all recalls per query from one pass over the hits."""
    folded = (
        with_relevance(hits)
        .groupBy("query_id")
        .agg(
            F.max(
                F.when(F.col("rel") & (F.col("rank") <= mrr_k), 1.0 / F.col("rank"))
            ).alias("_mrr"),
            *[
                F.count_if(F.col("rel") & (F.col("rank") <= k)).alias(f"_got{k}")
                for k in ks
            ],
        )
    )
    relevant_rows = relevant_count(df, id_col, label_col)
    recalls = [
        F.when(
            F.col("n_relevant") > 0,
            F.coalesce(f"_got{k}", F.lit(0)) / F.least("n_relevant", F.lit(k)),
        )
        .otherwise(0.0)
        .alias(f"recall_{k}")
        for k in ks
    ]
    return relevant_rows.join(folded, "query_id", "left").select(
        "query_id", "n_relevant", F.coalesce("_mrr", F.lit(0.0)).alias("mrr"), *recalls
    )


def retrieval_report(
    df: DataFrame,
    hits: DataFrame,
    id_col: str,
    label_col: str,
    ks: tuple[int, ...] = (3, 5),
    mrr_k: int = 5,
) -> DataFrame:
    """Table ``(metric, value)``: means over all queries, 4 decimals."""
    per_query = per_query_metrics(df, hits, id_col, label_col, ks, mrr_k)
    means = [(f"MRR@{mrr_k}", F.avg("mrr"))] + [
        (f"Recall@{k}", F.avg(f"recall_{k}")) for k in ks
    ]
    return per_query.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("metric"), F.round(value, 4).alias("value"))
                for name, value in means
            ]
        ).alias("_m")
    ).select(F.inline("_m"))


def chance_level(df: DataFrame, label_col: str) -> DataFrame:
    """Mean share of other rows that are relevant: the level of a random ranking."""
    by_set = relevant_counts_by_set(df, label_col)
    sized = _label_sets(df, label_col).join(by_set, "_set", "left")
    others = F.greatest(F.coalesce("_others", F.lit(1)) - 1, F.lit(0))
    return sized.agg(F.sum(F.col("_rows") * others).alias("_hits"), F.sum("_rows").alias("n")).select(
        F.when(F.col("n") > 1, F.col("_hits") / (F.col("n") * (F.col("n") - 1)))
        .otherwise(0.0)
        .alias("chance")
    )


def worst_query(per_query: DataFrame) -> DataFrame:
    """The query of lowest MRR, the smallest id on a tie."""
    return per_query.agg(
        F.min(F.struct("mrr", "query_id")).alias("_w")
    ).select("_w.query_id", "_w.mrr")


def worst_query_hits(per_query: DataFrame, hits: DataFrame) -> DataFrame:
    """The neighbours of the worst query with their labels."""
    return with_relevance(hits).join(F.broadcast(worst_query(per_query)), "query_id")


def inspect_query(df: DataFrame, hits: DataFrame, id_col: str, label_col: str, labels: list[str]):
    """Neighbours of the first row whose labels equal ``labels``, with match flag
    and the number of such rows."""
    wanted = F.array(*[F.lit(x) for x in labels])
    first = df.where(F.col(label_col) == wanted).agg(
        F.min(id_col).alias("query_id"), F.count(F.lit(1)).alias("n_such_rows")
    )
    return with_relevance(hits).join(F.broadcast(first), "query_id")
