"""A store of one vector per key that takes new vectors without rewriting the rest."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.session import stored
from codeloom.sources import io

BUCKETS = 64
# Seconds after which a claimed version without a manifest counts as given up.
PATIENCE = 600
MANIFEST = "bucket int, folder string, n_rows long"


@dataclass(frozen=True)
class Merge:
    """What a merge did: the version it made, rows that came, and rows that were written for them, the old ones of touched buckets included."""

    version: int
    n_new: int
    n_written: int


class VectorStore:
    """Vectors below ``path``: data folders by bucket of the key, and a manifest per version that names one for each bucket.

    A version is a full snapshot to its readers. A merge writes the buckets that its keys fall into anew, beside the
    old ones, and a manifest; that is its commit. Manifests are at most ``buckets`` rows.
    """

    def __init__(self, spark: SparkSession, path: str, id_col: str, vec_col: str = "embedding", buckets: int = BUCKETS):
        self.spark, self.path, self.id_col, self.vec_col, self.buckets = spark, path, id_col, vec_col, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.id_col), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The last complete version, 0 before the first."""
        return max([0, *io._versions(self.spark, f"{self.path}/manifest")])

    def _manifest(self, version: int) -> dict[int, tuple[str, int]]:
        if not version:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={version}").collect()
        return {r["bucket"]: (r["folder"], r["n_rows"]) for r in rows}

    def _read(self, folders: list[str], like: DataFrame) -> DataFrame:
        if not folders:
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(*folders)

    def read(self, like: DataFrame) -> DataFrame:
        """All vectors of the last version, as rows of the schema of ``like``."""
        like = like.select(self.id_col, self.vec_col)
        return self._read([f for f, _ in self._manifest(self.version()).values()], like)

    def merge(self, new: DataFrame) -> Merge:
        """Add ``new(id, vector)``; a key that is there gets the new vector, of equal new keys the greatest vector stays.

        Only the buckets of the new keys are read and written. If another merge has committed meanwhile, this one is
        made again on top of it.
        """
        new = stored(
            new.select(self.id_col, self.vec_col).groupBy(self.id_col).agg(F.max(self.vec_col).alias(self.vec_col)), "new-vectors"
        )
        counts = {r["b"]: r["n"] for r in new.groupBy(self._bucket().alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        while True:
            version = self.version()
            if not counts:
                return Merge(version, 0, 0)
            manifest = self._manifest(version)
            old = self._read([manifest[b][0] for b in counts if b in manifest], new)
            rows = old.join(new.select(self.id_col), self.id_col, "left_anti").unionByName(new)
            folder = f"{self.path}/data/{uuid.uuid4().hex}"
            rows.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(folder)
            written = self.spark.read.parquet(folder).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
            manifest |= {r["bucket"]: (f"{folder}/bucket={r['bucket']}", r["n"]) for r in written}
            target = self._next(version)
            if io.claim(self.spark, f"{self.path}/manifest", target):
                rows = [(b, f, n) for b, (f, n) in sorted(manifest.items())]
                table = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
                table.write.mode("overwrite").parquet(f"{self.path}/manifest/v={target}")
                return Merge(target, sum(counts.values()), sum(r["n"] for r in written))
            while self.version() == version and not self._given_up(target):
                time.sleep(0.2)

    def _next(self, version: int) -> int:
        """The number after ``version``, or after what writers have claimed since and given up."""
        target = version + 1
        while self._given_up(target):
            target += 1
        return target

    def _given_up(self, version: int) -> bool:
        """Whether a number was claimed longer ago than a manifest takes to write; its writer has ended before that."""
        marker, fs = io._hadoop_path(self.spark, f"{self.path}/manifest/_claims/{version}")
        if not fs.exists(marker):
            return False
        now = self.spark.sparkContext._jvm.System.currentTimeMillis()
        return now - fs.getFileStatus(marker).getModificationTime() > 1000 * PATIENCE


def embed_missing(
    rows: DataFrame, store: VectorStore, encode: Callable[[DataFrame], DataFrame], vector_type: str = "array<float>"
) -> Merge:
    """Embed the rows that the store has no vector for and merge the vectors into it.

    ``encode`` adds the vector column. A run that is repeated, or goes on after a failure, embeds only what is missing.
    """
    like = rows.select(store.id_col, F.lit(None).cast(vector_type).alias(store.vec_col))
    known = store.read(like).select(store.id_col)
    missing = rows.join(known, store.id_col, "left_anti")
    return store.merge(encode(missing).where(F.col(store.vec_col).isNotNull()))
