"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.sources.tables import scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a reread, not the work before it.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def hits_remainder(doc_id: Column, parts: int, value: int) -> Column:
    """Whether the id falls into fold ``value``; a null id falls into none."""
    return F.coalesce(remainder(doc_id, parts) == value, F.lit(False))


def text_digest(text: Column) -> Column:
    """64 bits that tell apart the texts of rows with one doc_id; a null text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it, in capitals or not."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def split_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text. ``bytes.split`` cuts exactly at 0x20 and 0x09 to 0x0D."""
    return (text or b"").split()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in views of at most ``rows`` rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_columns(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, object]], schema: str
) -> DataFrame:
    """Apply ``function`` to Arrow batches; it returns one list or array per column."""
    target = df.sparkSession.createDataFrame([], schema).schema
    names = target.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in slices(batches):
            columns = function(batch)
            arrays = [
                x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=field.type)
                for x, field in zip((columns[n] for n in names), arrow, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, target)
