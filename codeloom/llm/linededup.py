"""Lines that many documents share, found in one sorted stream and reported as keep bitmaps."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.llm.common import documents, map_columns, slices, text_digest, written

# A key counts from so many code points on, and goes if so many documents hold it.
LEAST_CHARS = 20
LEAST_DOCS = 3
BLANKS = b" \t\n\x0b\x0c\r"
# Rows of one undecided key that the stream holds; more are left open and settled with the partition edges.
HELD = 50_000
# Edge keys that are broadcast. There are two for a partition and one for HELD rows; beyond this they are joined.
EDGES = 500_000

LINE_ROWS = "high long, low long, doc_id long, digest long, positions binary, n_lines int"
DROPS = "high long, low long, doc_id long, digest long, positions binary, kind string"
BITMAPS = "doc_id long, digest long, n_lines long, n_dropped long, keep binary"


def line_key(line: bytes) -> bytes:
    """A UTF-8 line without ASCII blanks at its ends, A-Z in lower case."""
    return line.strip(BLANKS).lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return key.isascii() or len(key) >= 4 * least or len(key.decode(errors="replace")) >= least


def identified(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest, text binary)``: rows that repeat an id are told apart by a hash of their texts."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_digest(F.col("text")).alias("digest"),
        F.col("text").cast("binary").alias("text"),
    )


def line_rows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """A row for each document, without a hash, and one for each of its different keys of ``least_chars`` or more.

    ``positions`` are 32-bit line numbers from 0. A document is known by its id and the digest of its text,
    so rows that repeat an id stay apart.
    """

    def rows(batch: pa.RecordBatch) -> dict[str, object]:
        is_key, owners, positions, counts = [], [], [], []
        hashes: list[bytes] = []
        for row, text in enumerate(batch.column(2).to_pylist()):
            lines = (text or b"").split(b"\n")
            places: dict[bytes, list[int]] = {}
            for place, line in enumerate(lines):
                if len(line) >= least_chars and _long_enough(key := line_key(line), least_chars):
                    places.setdefault(key, []).append(place)
            is_key += [False, *[True] * len(places)]
            hashes.append(bytes(16))
            hashes += [xxhash.xxh3_128_digest(k) for k in places]
            positions += [b"", *(np.array(p, "<i4").tobytes() for p in places.values())]
            owners += [row] * (1 + len(places))
            counts += [len(lines)] * (1 + len(places))
        pairs = np.frombuffer(b"".join(hashes), ">i8").reshape(-1, 2).astype(np.int64)
        header = ~np.array(is_key, bool)
        owner = pa.array(owners, pa.int64())
        return {
            "high": pa.array(pairs[:, 0], mask=header),
            "low": pa.array(pairs[:, 1], mask=header),
            "doc_id": batch.column(0).take(owner),
            "digest": batch.column(1).take(owner),
            "positions": positions,
            "n_lines": counts,
        }

    return map_columns(identified(docs), rows, LINE_ROWS)


@dataclass
class _Run:
    """The rows of one key as a sorted stream brings them, largest document first."""

    key: tuple
    # The partition or an overflow cut the run, so what follows or came before is not seen here.
    open: bool = False
    docs: list = field(default_factory=list)
    held: list = field(default_factory=list)


class _Stream:
    """First occurrences of keys in rows sorted by key and document.

    The first document of a run keeps its lines. The rows of the second wait for a third document; from then on
    rows are dropped as they come. A run that touches an end of the partition is open: its rows are handed on with
    its first ``least`` documents, and are settled where all partitions' runs of the key are known.
    """

    def __init__(self, least: int):
        self.least = least
        self.run: _Run | None = None
        self.last: tuple | None = None
        self.out: list[tuple] = []

    def add(self, row: tuple) -> None:
        key, doc = row[:2], row[2]
        if self.run is None or self.run.key != key:
            first = self.run is None
            if not first:
                self._close()
            self.run = _Run(key, open=first)
        elif row[:4] == self.last:
            return  # the same document again
        self.last = row[:4]
        run = self.run
        if doc not in run.docs[-1:] and len(run.docs) < self.least:
            run.docs.append(doc)
            if len(run.docs) == self.least and not run.open:
                self._give(run.held, "drop")
        if run.open:
            self._give([row], "open")
        elif len(run.docs) == self.least and doc != run.docs[0]:
            self._give([row], "drop")
        elif doc != run.docs[0]:
            run.held.append(row)
            if len(run.held) > HELD:
                run.open = True
                self._give(run.held, "open")

    def _give(self, rows: list[tuple], kind: str) -> None:
        self.out += [(*row, kind) for row in rows]
        if rows is self.run.held:
            self.run.held = []

    def _close(self) -> None:
        """The run is over: its held rows stay, and an open one names its documents."""
        if self.run.open:
            self.out += [(*self.run.key, doc, 0, b"", "edge") for doc in self.run.docs]

    def end(self) -> None:
        """The partition is over; its last run may go on in the next."""
        if self.run is None:
            return
        if not self.run.open:
            # What was dropped already stays so: the run has its documents. Else the next partition decides.
            if len(self.run.docs) < self.least:
                self._give(self.run.held, "open")
            self.run.open = True
        self._close()


def shared_lines(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The rows of ``line_rows`` whose lines go: ``(doc_id, digest, positions)``.

    Hashes are dealt by ranges that also cut within a hash, by document, so that a line of a third of all
    documents is spread over as many partitions as its rows fill; within a partition the rows are sorted by hash and
    descending document and read as a stream. Keys that touch a partition's ends are settled by their edges, of
    which there are two for a partition.
    """
    keyed = rows.where("high is not null").select("high", "low", "doc_id", "digest", "positions")
    order = [F.col("high"), F.col("low"), F.col("doc_id").desc_nulls_last(), F.col("digest")]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["high", "low", "doc_id", "digest", "positions", "kind"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        state = _Stream(least_docs)

        def given() -> pa.RecordBatch:
            columns = list(zip(*state.out)) or [[]] * len(names)
            state.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in slices(batches, 20_000):
            high, low = (batch.column(i).to_numpy() for i in (0, 1))
            # Keys alone in the middle of a batch need no look: most lines occur once.
            same = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
            seen = np.ones(len(high), bool)
            seen[1:-1] = same[1:] | same[:-1]
            for row in zip(*(c.to_pylist() for c in batch.filter(pa.array(seen)).columns)):
                state.add(row)
            yield given()
        state.end()
        yield given()

    found = written(dealt.mapInArrow(stream, DROPS), "shared-lines")
    edges = found.where("kind = 'edge'").groupBy("high", "low")
    edges = edges.agg(
        # A null id is a document too, the smallest.
        (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("docs"),
        F.max("doc_id").alias("keeper"),
    )
    edges = written(edges.where(F.col("docs") >= least_docs).select("high", "low", "keeper"), "shared-line-edges")
    small = edges.count() <= EDGES
    opened = found.where("kind = 'open'").join(F.broadcast(edges) if small else edges.hint("merge"), ["high", "low"])
    opened = opened.where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    columns = ["doc_id", "digest", "positions"]
    return found.where("kind = 'drop'").select(*columns).unionByName(opened.select(*columns))


def packed_bits(keep: np.ndarray) -> bytes:
    """A keep bitmap: bits from the low end of each byte, deflated."""
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def unpacked_bits(keep: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n, bitorder="little").astype(bool)


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``(doc_id, digest, n_lines, n_dropped, keep)`` for each different document of ``docs(doc_id, text)``.

    A line's key is the line without ASCII blanks at its ends, A-Z in lower case. Keys of ``least_chars`` code
    points or more that ``least_docs`` or more doc_ids hold lose their lines everywhere but in the largest
    doc_id that holds them. ``keep`` is a deflated bitmap of the lines that stay; no text is moved.

    Null and empty texts are one empty line. A null doc_id is a document like others, smaller than all. Rows that
    repeat a doc_id are one document to the count, and each has its own bitmap, known by the digest of its text;
    rows that repeat the text as well share one. Other columns are not read. An empty table gives an empty one.
    """
    rows = written(line_rows(docs, least_chars), "line-rows")
    drops = shared_lines(rows, least_docs).withColumn("n_lines", F.lit(None).cast("int"))
    heads = rows.where("high is null").select("doc_id", "digest", F.lit(None).cast("binary").alias("positions"), "n_lines")
    grouped = drops.unionByName(heads).groupBy("doc_id", "digest")
    grouped = grouped.agg(F.max("n_lines").alias("n_lines"), F.collect_set("positions").alias("positions"))

    def bitmaps(batch: pa.RecordBatch) -> dict[str, object]:
        dropped, keeps = [], []
        for n, positions in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            keep = np.ones(n, bool)
            for some in positions:
                keep[np.frombuffer(some, "<i4")] = False
            dropped.append(n - int(keep.sum()))
            keeps.append(packed_bits(keep))
        return {
            "doc_id": batch.column(0),
            "digest": batch.column(1),
            "n_lines": batch.column(2).cast(pa.int64()),
            "n_dropped": dropped,
            "keep": keeps,
        }

    return map_columns(grouped, bitmaps, BITMAPS)


def _kept(text: bytes | None, n: int, dropped: int, keep: bytes) -> bytes:
    if not dropped:
        return text or b""
    lines = (text or b"").split(b"\n")
    return b"\n".join(lines[i] for i in np.flatnonzero(unpacked_bits(keep, n)).tolist())


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, text binary, n_lines, n_dropped, keep)``; bitmaps grow with the input, so they meet in a merge join."""
    lossy = bitmaps.where("n_dropped > 0").withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    return identified(docs).join(lossy.hint("merge"), same, "left").select("doc_id", "text", "n_lines", "n_dropped", "keep")


def deduplicated(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, text)``, one row per row of ``docs(doc_id, text)``, without the lines that the bitmaps drop.

    Texts that lose nothing are returned as they are, null and empty ones as empty.
    """

    def apply(batch: pa.RecordBatch) -> dict[str, object]:
        rows = zip(*(c.to_pylist() for c in batch.columns[1:]))
        return {"doc_id": batch.column(0), "text": [_kept(*row).decode(errors="replace") for row in rows]}

    return map_columns(_with_bitmaps(docs, bitmaps), apply, "doc_id long, text string")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)

    def digest(batch: pa.RecordBatch) -> dict[str, object]:
        rows = list(zip(*(c.to_pylist() for c in batch.columns[1:])))
        return {
            "doc_id": batch.column(0),
            "n_lines": [n if d else (t or b"").count(b"\n") + 1 for t, n, d, _ in rows],
            "n_dropped": [d or 0 for _, _, d, _ in rows],
            "kept_sha256": [hashlib.sha256(_kept(*row)).hexdigest() for row in rows],
        }

    return map_columns(
        _with_bitmaps(docs, keep_bitmaps(docs)), digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


OP12_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keys AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keys WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.line, k.place, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keys k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
