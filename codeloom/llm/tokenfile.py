"""Token ids of all documents in order of id, as range-coded files, and back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeloom.llm import rangecoder, tokens
from codeloom.llm.common import documents, map_columns, slices
from codeloom.sources.tables import scratch

VOCABULARY = "word_bpe_49k.json"
# Ids of one stretch of whole documents, whose blocks are coded side by side.
STRETCH_IDS = 4_000_000

FILE = "part int, stretch int, n_ids long, doc_ids array<long>, lengths array<long>, coded binary"


def encoded(docs: DataFrame, vocabulary: str, stretch_ids: int = STRETCH_IDS) -> DataFrame:
    """Stretches of documents in ascending order: within a partition and over the partitions."""
    schema = docs.sparkSession.createDataFrame([], FILE).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        part, stretch = TaskContext.get().partitionId(), 0
        end = np.array([tokens.END], "<u2").tobytes()
        coder = tokens.encoder(vocabulary)
        doc_ids: list = []
        pieces: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u2")
            values = [part, stretch, len(ids), doc_ids, [len(p) // 2 for p in pieces], rangecoder.encode(ids)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

        for batch in slices(batches):
            for doc_id, raw in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                doc_ids.append(doc_id)
                pieces.append(raw + end)
                held += len(raw) // 2 + 1
                if held >= stretch_ids:
                    yield row()
                    doc_ids, pieces, held, stretch = [], [], 0, stretch + 1
        if pieces:
            yield row()

    # Equal ids are told apart by their texts, so a repeated id does not fill one partition.
    order = ("doc_id", F.xxhash64("text"), "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return rows.mapInArrow(run, schema)


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, stretch_ids: int = STRETCH_IDS) -> None:
    """Write the ids of ``docs(doc_id, text)`` below ``path``, each document closed by the end id.

    A file holds stretches of whole documents: their ids and lengths, and the range-coded token ids in blocks
    that are decoded independently and carry a checksum each. ``part`` and ``stretch`` order the stretches.
    Null and empty texts are the end id alone, null doc_ids come first, repeated rows are each
    written, an empty table gives files without rows. A document is held as a whole, and no more than a stretch.
    """
    encoded(docs, vocabulary or tokens.path(VOCABULARY), stretch_ids).write.parquet(path)


def _read_batch(b: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {n: [] for n in ("part", "stretch", "doc_id", "within", "n_tokens", "ids_crc32")}
    for part, stretch, doc_ids, lengths, coded in zip(*(b.column(i).to_pylist() for i in range(5))):
        ids = rangecoder.decode(coded).astype("<u4")
        ends = np.cumsum(lengths)
        for doc_id, low, high in zip(doc_ids, ends - lengths, ends):
            row = (part, stretch, doc_id, int(low), int(high - low), zlib.crc32(ids[low:high].tobytes()))
            for column, value in zip(out.values(), row):
                column.append(value)
    return out


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files: where each document's ids stand and their checksum.

    ``start`` counts the ids of all documents before. A damaged block fails the read.
    """
    files = spark.read.schema(FILE).parquet(path)
    docs = map_columns(
        files.select("part", "stretch", "doc_ids", "lengths", "coded"),
        _read_batch,
        "part int, stretch int, doc_id long, within long, n_tokens long, ids_crc32 long",
    )
    # One row per partition, then one per stretch.
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = files.select("part", "stretch", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("before_stretch"))
    bases = stretches.join(parts, "part").select("part", "stretch", (F.col("before_part") + F.col("before_stretch")).alias("base"))
    return docs.join(bases, ["part", "stretch"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-ids")
    write_ids(documents(spark, sf_dir), path)
    return read_ids(spark, path)
