"""The published score table: upserts and deletions that rewrite only the parts they touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.clean import dedup
from tessera.operators.joining import settle

BUCKET = "bucket"


class ScoreTable:
    """One row per key under a folder, in buckets of keys.

    A row's bucket is a hash of its key, so new rows and stale versions say which buckets they touch. Only those are read,
    merged, kept in the shared scratch folder and then swapped in; files of other buckets keep their name and time. A bucket
    that ends up without rows is removed. The number of buckets belongs to the table: about one per file of the wanted size.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        p, fs = self._fs("_buckets")
        if fs.exists(p):  # what the table was made with counts
            file = fs.open(p)
            try:
                self.buckets = int(bytes(file.readAllBytes()).decode())
            finally:
                file.close()
        else:
            file = fs.create(p, True)
            file.writeBytes(str(buckets))
            file.close()

    def _fs(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _stored(self) -> list[int]:
        p, fs = self._fs("")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    def _scan(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if self._stored() else None

    def read(self) -> DataFrame | None:
        """All rows; None while there are none."""
        df = self._scan()
        return None if df is None else df.drop(BUCKET)

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int"))

    def _swap(self, rows: DataFrame, touched: list[int]) -> None:
        rows = settle(rows)
        (
            rows.repartition(BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
        left = {r[0] for r in rows.select(BUCKET).distinct().collect()}  # at most the table's buckets
        for b in set(touched) - left:
            p, fs = self._fs(f"{BUCKET}={b}")
            fs.delete(p, True)

    def upsert(self, new: DataFrame, order: Sequence[str] = ()) -> list[int]:
        """New rows replace stored rows of the same key; of several new rows of a key the last by ``order`` stays. Returns the
        buckets that were rewritten."""
        new = settle(self._dealt(dedup(new, self.keys, list(order) or self.keys)))
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
        stored = self._scan()
        if not touched:
            return []
        if stored is None:
            self._swap(new, touched)
            return touched
        old = stored.where(F.col(BUCKET).isin(touched))  # only these folders are listed and read
        same = [old[k].eqNullSafe(new[k]) for k in self.keys]
        kept = old.join(new.select(BUCKET, *self.keys), [old[BUCKET] == new[BUCKET], *same], "left_anti")
        self._swap(kept.unionByName(new, allowMissingColumns=True), touched)
        return touched

    def drop_stale(self, version: str, column: str = "model_version") -> list[int]:
        """Delete rows of versions before the given one. Returns the buckets that were rewritten."""
        stored = self._scan()
        if stored is None:
            return []
        stale = F.col(column) < F.lit(version)
        touched = sorted(r[0] for r in stored.where(stale).select(BUCKET).distinct().collect())
        if touched:
            self._swap(stored.where(F.col(BUCKET).isin(touched) & ~F.coalesce(stale, F.lit(False))), touched)
        return touched
