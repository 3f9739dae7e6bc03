"""Packing of tokenised documents into windows: least squares over length combinations, then a greedy stream."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeloom.llm import tokens
from codeloom.llm.common import documents, map_columns, slices, written

WINDOW = 2048
VOCABULARY = "byte_bpe_50k.json"
# Lengths are counted in steps of so many tokens, rounded up; a window loses less than one step per piece.
STEP = 8
DEPTH = 3
# Pieces of at most so many steps go to the stream, where rounding costs nothing.
SMALL = 8

PIECES = (
    "part int, bin int, place long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
)


def wide_crc32(ids: bytes) -> int:
    """crc32 of 16-bit ids written as little-endian 32-bit ones."""
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """Documents as token pieces of at most ``window`` ids, the end id included.

    ``bin`` is the length in steps, ``place`` the number of earlier pieces of that bin in the same
    partition ``part``. Both depend on the order of the input alone, so a repeated task gives the same.
    """

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        coder = tokens.encoder(vocabulary)
        end = np.array([tokens.END], "<u2").tobytes()
        for batch in slices(batches):
            rows: list[tuple] = []
            held = 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                raw += end
                total = len(raw) // 2
                for start in range(0, total, window):
                    some = raw[2 * start : 2 * (start + window)]
                    length = len(some) // 2
                    size = -(-length // step)
                    rows.append((part, size, seen[size], doc_id, start, length, total, wide_crc32(some), some))
                    seen[size] += 1
                    held += len(some)
                if held > 8 << 20:
                    yield _batch(rows, arrow)
                    rows, held = [], 0
            yield _batch(rows, arrow)

    schema = docs.sparkSession.createDataFrame([], PIECES).schema
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow
    )


def combinations(size: int, depth: int, least: int) -> list[tuple[int, ...]]:
    """All multisets of at most ``depth`` numbers of ``least`` or more that add up to ``size``."""
    if depth == 1:
        return [(size,)] if size >= least else []
    found = combinations(size, depth - 1, least)
    exact: list[tuple[int, ...]] = [()]
    for _ in range(depth):
        exact = [(*c, n) for c in exact for n in range(c[-1] if c else least, size - sum(c) + 1)]
    return found + [c for c in exact if sum(c) == size]


def least_squares(columns: np.ndarray, target: np.ndarray, rounds: int = 4000) -> np.ndarray:
    """Non-negative x that minimises the distance of ``columns @ x`` to ``target`` (Lawson and Hanson)."""
    gram, aim = columns.T @ columns, columns.T @ target
    x = np.zeros(columns.shape[1])
    active = np.zeros(len(x), bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(aim).max(initial=0)))
    for _ in range(rounds):
        slope = np.where(active, -np.inf, aim - gram @ x)
        best = int(np.argmax(slope)) if len(slope) else 0
        if not len(slope) or slope[best] <= tolerance:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            trial = np.linalg.lstsq(gram[np.ix_(at, at)], aim[at], rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[at] = trial
                break
            low = trial <= 0
            ratio = x[at][low] / np.maximum(x[at][low] - trial[low], 1e-300)
            x[at] += ratio.min() * (trial - x[at])
            stay = x[at] > tolerance
            x[at[~stay]] = 0
            active[at[~stay]] = False
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], size: int, depth: int = DEPTH, small: int = SMALL) -> list[tuple[int, int, int, int, int]]:
    """Which pieces share a window: rows ``(bin, low, high, first window, slot)``.

    Pieces ``low`` to ``high`` of a bin take the slot in the windows from ``first``
    on. Repeat counts come from least squares against the histogram, are rounded, and are held to the
    pieces that there are, the most used combination first.
    """
    left = {b: n for b, n in histogram.items() if small < b <= size and n > 0}
    usable = [c for c in combinations(size, depth, small + 1) if all(b in left for b in c)]
    if not usable:
        return []
    bins = sorted(left)
    row = {b: i for i, b in enumerate(bins)}
    columns = np.zeros((len(bins), len(usable)))
    for k, c in enumerate(usable):
        for b in c:
            columns[row[b], k] += 1
    counts = least_squares(columns, np.array([left[b] for b in bins], float))
    used: dict[int, int] = defaultdict(int)
    out, window = [], 0
    for k in np.argsort(-counts, kind="stable"):
        wanted = usable[k]
        times = min(int(round(counts[k])), *((left[b] - used[b]) // wanted.count(b) for b in wanted))
        if times <= 0:
            continue
        for slot, b in enumerate(wanted):
            out.append((b, used[b], used[b] + times, window, slot))
            used[b] += times
        window += times
    return out


def _cut_batch(b: pa.RecordBatch) -> dict[str, object]:
    column = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
    parts = [raw[2 * a : 2 * (a + n)] for raw, a, n in zip(column["ids"], column["skip"], column["taken"])]
    return {
        **{n: b.column(n) for n in ("doc_id", "doc_tokens", "sequence_id", "offset", "part", "bin", "place", "skip")},
        "start": [s + a for s, a in zip(column["start"], column["skip"])],
        "length": b.column("taken"),
        "ids_crc32": [wide_crc32(x) for x in parts],
    }


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    step: int = STEP,
    depth: int = DEPTH,
    small: int = SMALL,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece, and its place
    in the written pieces: ``part, bin, place`` and ``skip`` ids into it.

    Documents longer than a window are cut into windows and a rest. Rests are counted by length, and
    combinations of up to ``depth`` lengths that fill a window are repeated as non-negative
    least squares finds best. What the rounded plan leaves over, and small pieces, follow
    each other in one stream that is cut at every window's end, so only its last window has more padding
    than the rounding to steps. Every id lies in exactly one piece. ``window`` must be a multiple of ``step``.

    Null and empty texts are the end id alone; null doc_ids stay null; repeated rows are packed each;
    an empty table gives an empty one. Only the histogram, at most ``window / step`` rows, comes to the
    driver; ranks within a length are sums of counts per partition, so a length that a third of all
    documents share is never sorted in one task.
    """
    spark = docs.sparkSession
    held = written(pieces(docs, vocabulary or tokens.path(VOCABULARY), window, step), "packing")
    narrow = held.drop("ids")
    counts = written(narrow.groupBy("part", "bin").agg(F.count("*").alias("n"), F.sum("length").alias("ids")), "packing-counts")
    histogram = {r["bin"]: r["n"] for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    slots = plan(histogram, window // step, depth, small)
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    table = spark.createDataFrame(slots, "bin int, low long, high long, first long, slot int")
    ranked = narrow.join(earlier, ["part", "bin"]).withColumn("rank", F.col("earlier") + F.col("place"))
    # The plan has at most ``depth`` rows for each combination in use, and no more of these than bins.
    placed = ranked.join(F.broadcast(table), "bin").where("rank >= low and rank < high")
    in_window = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(in_window), F.lit(0)).alias("offset"),
        "part", "bin", "place", F.lit(0).cast("long").alias("skip"),
    )

    planned: dict[int, int] = defaultdict(int)
    for b, _, high, _, _ in slots:
        planned[b] = max(planned[b], high)
    cuts = spark.createDataFrame(list(planned.items()), "bin int, planned long")
    rest = (
        ranked.join(F.broadcast(cuts), "bin", "left")
        .where(F.col("rank") >= F.coalesce("planned", F.lit(0)))
        .drop("planned", "rank", "earlier")
    )
    rest = written(rest, "packing-rest")
    sizes = rest.groupBy("part").agg(F.sum("length").alias("size"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("part").orderBy("bin", "place").rowsBetween(Window.unboundedPreceding, -1)
    first = max((s[3] + s[2] - s[1] for s in slots), default=0)
    at = F.col("ahead") + F.coalesce(F.sum("length").over(within), F.lit(0))
    stream = rest.join(sizes, "part").withColumn("at", at)
    stream = stream.withColumn(
        "turn", F.explode(F.sequence(F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("length") - 1) / window)))
    )
    low = F.greatest("at", F.col("turn") * window)
    high = F.least(F.col("at") + F.col("length"), (F.col("turn") + 1) * window)
    stream = stream.select(
        "doc_id", "start", (high - low).alias("taken"), "length", "ids_crc32", "doc_tokens",
        (F.lit(first) + F.col("turn")).alias("sequence_id"), (low - F.col("turn") * window).alias("offset"),
        "part", "bin", "place", (low - F.col("at")).alias("skip"),
    )
    uncut = stream.where("taken = length").drop("taken")
    cut = stream.where("taken < length").drop("length", "ids_crc32")
    # A cut piece's ids are fetched by a merge join: how many are cut grows with the input.
    cut = cut.hint("merge").join(held.select("part", "bin", "place", "ids"), ["part", "bin", "place"])
    cut = map_columns(
        cut.select("doc_id", "start", "taken", "doc_tokens", "sequence_id", "offset", "part", "bin", "place", "skip", "ids"),
        _cut_batch,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "part int, bin int, place long, skip long",
    )
    return whole.unionByName(uncut).unionByName(cut)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
