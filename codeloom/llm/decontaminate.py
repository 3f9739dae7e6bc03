"""Benchmark passages in documents, found by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import documents, map_columns, slices

SEED_WORDS = 5
LEAST_COVERAGE = 0.8
# UTF-8 bytes of benchmark text that one broadcast index may hold; more text makes more indexes.
INDEX_BYTES = 8 << 20
# Multiplier of the Karp-Rabin hash, modulo 2 to the 64th.
BASE = 0x9E3779B97F4A7C15
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# First window length of the tiling, before it is halved down to the seed length.
FIRST_LENGTH = 20


def normal_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation; null and empty texts have none."""
    lower = (text or b"").decode("utf-8", "replace").lower().encode()
    return lower.translate(None, MARKS).split()


# Pairs of equal windows for each id from which on the whole table of equal ids is read instead.
DENSE = 20


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` ids."""
    windows = max(0, len(ids) - length + 1)
    total = np.zeros(windows, np.uint64)
    for k in range(length):
        total = total * np.uint64(BASE) + ids[k : k + windows].astype(np.uint64)
    return total


def tiles(item: np.ndarray, text: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling: disjoint equal runs ``(item start, text start, length)`` of ``least`` ids or more.

    Running Karp-Rabin: windows of one length are looked up by hash and stretched over unmarked
    ids; the longest runs are marked first, of equal ones the earliest; then the length shrinks.
    A run above twice the length restarts the search at its own length, so long runs are never
    cut by shorter ones.
    """
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    found: list[tuple[int, int, int]] = []
    length = max(least, min(FIRST_LENGTH, len(item)))
    while True:
        runs = _runs(item, text, free_item, free_text, length)
        longest = max((r[0] for r in runs), default=0)
        if longest > 2 * length:
            length = longest
            continue
        left = []
        for size, i, j in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
            if free_item[i : i + size].all() and free_text[j : j + size].all():
                free_item[i : i + size] = free_text[j : j + size] = False
                found.append((i, j, size))
            else:
                left.append((i, j))
        if left and any(free_item[i] or free_text[j] for i, j in left):
            # What a longer run has cut may still hold a window of this length.
            if _runs(item, text, free_item, free_text, length):
                continue
        if length == least:
            return found
        length = max(least, length // 2)


def _runs(item, text, free_item, free_text, length) -> list[tuple[int, int, int]]:
    """Maximal equal runs ``(length, item start, text start)`` of unmarked ids, ``length`` or longer."""

    def windows(ids, free):
        hashes = rolling(ids, length)
        if not len(hashes):
            return hashes, np.empty(0, np.int64)
        busy = np.concatenate(([0], np.cumsum(~free)))
        at = np.flatnonzero(busy[length:] == busy[:-length])
        return hashes[at], at

    item_hashes, item_at = windows(item, free_item)
    text_hashes, text_at = windows(text, free_text)
    shared, item_counts = np.unique(item_hashes, return_counts=True)
    kept = np.isin(text_hashes, shared)
    text_hashes, text_at = text_hashes[kept], text_at[kept]
    if not len(text_at):
        return []
    pairs = int(item_counts[np.searchsorted(shared, text_hashes)].sum())
    if pairs > DENSE * (len(item) + len(text)):
        return _dense_runs(item, text, item_at, text_at, length)
    places: dict[int, list[int]] = {}
    for h, j in zip(text_hashes.tolist(), text_at.tolist()):
        places.setdefault(h, []).append(j)
    runs, inside = [], set()
    for h, i in zip(item_hashes.tolist(), item_at.tolist()):
        for j in places.get(h, ()):
            if (i - 1, j - 1) in inside:
                inside.add((i, j))
                continue
            if not np.array_equal(item[i : i + length], text[j : j + length]):
                continue
            inside.add((i, j))
            size = length
            while (
                i + size < len(item)
                and j + size < len(text)
                and free_item[i + size]
                and free_text[j + size]
                and item[i + size] == text[j + size]
            ):
                size += 1
            runs.append((size, i, j))
    return runs


def _dense_runs(item, text, item_at, text_at, length) -> list[tuple[int, int, int]]:
    """The runs of ``_runs`` where windows repeat so often that their pairs outnumber all ids.

    Rows of the item are read one after the other, each against the whole text at once: a cell counts the equal ids before
    it on its diagonal. Memory is that of the text, work the product of both without a list of pairs.
    """
    free = [np.zeros(len(x), bool) for x in (item, text)]
    for mask, at in zip(free, (item_at, text_at)):
        edge = np.zeros(len(mask) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
        mask[:] = np.cumsum(edge[:-1]) > 0
    runs = []
    before = np.zeros(len(text), np.int64)
    for i in range(len(item) + 1):
        now = np.zeros(len(text), np.int64)
        if i < len(item) and free[0][i]:
            equal = free[1] & (text == item[i])
            now[equal] = 1
            now[1:][equal[1:]] += before[:-1][equal[1:]]
        # A run ends where the next cell of its diagonal is not equal.
        over = np.append(now[1:] == 0, True) & (before >= length)
        for j in np.flatnonzero(over).tolist():
            size = int(before[j])
            runs.append((size, i - size, j - size + 1))
        before = now
    return runs


@dataclass
class Index:
    """Items as word numbers, and the seeds that lead to them."""

    numbers: dict[bytes, int]
    item_ids: list[int | None]
    items: list[np.ndarray]
    seeds: np.ndarray
    # Items of seed k: owners[first[k]:first[k + 1]].
    first: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, bytes | None]]) -> Index:
        numbers: dict[bytes, int] = {}
        items = [
            np.array([numbers.setdefault(w, len(numbers) + 1) for w in normal_words(text)], np.int64)
            for _, text in rows
        ]
        hashes = [np.unique(rolling(x, SEED_WORDS)) for x in items]
        owners = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        flat = np.concatenate([np.empty(0, np.uint64), *hashes])
        order = np.argsort(flat, kind="stable")
        seeds, first = np.unique(flat[order], return_index=True)
        return cls(numbers, [i for i, _ in rows], items, seeds, np.append(first, len(flat)), owners[order])

    def leaks(self, text: bytes | None, least_coverage: float) -> list[tuple[int | None, int, int, int]]:
        """``(item_id, item words, matched words, tiles)`` of every item that ``text`` covers enough."""
        get = self.numbers.get
        words = normal_words(text)
        ids = np.array([get(w, 0) for w in words], np.int64)
        if len(ids) < SEED_WORDS or not len(self.seeds):
            return []
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        at = np.flatnonzero(unknown[SEED_WORDS:] == unknown[:-SEED_WORDS])
        if not len(at):
            return []
        hashes = rolling(ids, SEED_WORDS)[at]
        place = np.minimum(np.searchsorted(self.seeds, hashes), len(self.seeds) - 1)
        hit = self.seeds[place] == hashes
        at, hashes, place = at[hit], hashes[hit], place[hit]
        if not len(at):
            return []
        # Only ids below a seed can lie in a tile; one strange id keeps the stretches apart.
        covered = np.zeros(len(ids) + 1, np.int64)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + SEED_WORDS, -1)
        inside = np.cumsum(covered[:-1]) > 0
        starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        ends = np.flatnonzero(inside & ~np.concatenate((inside[1:], [False]))) + 1
        near = np.concatenate([x for a, b in zip(starts, ends) for x in (ids[a:b], [-1])])
        found = []
        owners = [self.owners[self.first[k] : self.first[k + 1]] for k in np.unique(place)]
        for n in np.unique(np.concatenate(owners)):
            item = self.items[n]
            own = np.flatnonzero(np.isin(rolling(item, SEED_WORDS), hashes))
            reach = np.unique(np.concatenate([own + k for k in range(SEED_WORDS)]))
            if len(reach) < least_coverage * len(item):
                continue
            runs = tiles(item, near)
            matched = sum(size for _, _, size in runs)
            if matched >= least_coverage * len(item):
                found.append((self.item_ids[n], len(item), matched, len(runs)))
        return found


def indexes(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> Iterator[Index]:
    """The benchmark as indexes of at most ``index_bytes`` of text each (or of one item that is larger).

    The driver holds one index at a time. A benchmark of any size is covered, by one pass over the
    documents per index.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))
    items = items.where(F.length("text") > 0)
    parts = 1
    while True:
        part = F.pmod(F.xxhash64("text", "item_id"), F.lit(parts)).alias("part")
        sizes = items.groupBy(part).agg(F.sum(F.length("text")).alias("size"), F.count("*").alias("n")).collect()
        if all(r["size"] <= index_bytes or r["n"] == 1 for r in sizes) or parts > 1 << 16:
            break
        parts *= 2
    for r in sizes:
        rows = items.where(part == r["part"]).orderBy("item_id", "text").collect()
        yield Index.of([(x["item_id"], bytes(x["text"])) for x in rows])


def leaks(
    docs: DataFrame, benchmark: DataFrame, least_coverage: float = LEAST_COVERAGE, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """``(doc_id, item_id, item_words, matched_words, n_tiles, coverage)`` for every leaked item of a document.

    A document leaks an item if tiles of five words or more cover ``least_coverage`` of the item's words,
    in any order. Case and ASCII punctuation don't count. Items of fewer than five words, null and empty
    texts leak nothing; repeated documents and repeated items are all reported; null ids stay null;
    an empty table on either side gives an empty one. Each document is tested where it is read: nothing
    is shuffled, and an item that is in every document costs no more than one that is in few.
    """
    spark = docs.sparkSession
    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    schema = "doc_id long, item_id long, item_words long, matched_words long, n_tiles long, coverage double"
    result = spark.createDataFrame([], schema)
    for index in indexes(benchmark, index_bytes):
        shared = spark.sparkContext.broadcast(index)

        def batch(b: pa.RecordBatch, shared=shared) -> dict[str, list]:
            rows = [
                (doc_id, *leak, round(leak[2] / leak[1], 6))
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                for leak in shared.value.leaks(text, least_coverage)
            ]
            names = ("doc_id", "item_id", "item_words", "matched_words", "n_tiles", "coverage")
            return {n: [r[i] for r in rows] for i, n in enumerate(names)}

        result = result.unionByName(map_columns(wanted, batch, schema))
    return result


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, least_coverage: float = LEAST_COVERAGE, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns, each row judged by its own text."""
    for index in indexes(benchmark, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                keep = pa.array([not shared.value.leaks(t, least_coverage) for t in texts], pa.bool_())
                yield b.filter(keep)

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
