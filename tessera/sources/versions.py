"""Digests of stored files and an append-only log of the versions of a table's partitions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.joining import settle
from tessera.sources.layers import DT, LayerStore

#: A larger file is listed without digest, as a file's content is one value of a row while its digest is computed.
LARGEST = 1 << 30
LOG = "dataset string, layer string, dt date, generation bigint, files bigint, size bigint, digest string, updated timestamp"


def file_digests(spark: SparkSession, folder: str, partition: Mapping[str, str] | None = None, glob: str = "*") -> DataFrame:
    """(partition columns, path, size, digest, updated) of the data files below a folder, the digest being MD5 in lowercase hex.

    Files are read where they lie, one a row; only sizes and times come from a listing. Files above LARGEST bytes have no
    digest, empty ones are left out. ``partition`` maps the names of partition folders to types. A folder that is not there has no files.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    columns = ", ".join([*[f"{k} {v}" for k, v in (partition or {}).items()], "path string, size bigint, digest string, updated timestamp"])
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], columns)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("basePath", folder).option("recursiveFileLookup", str(not partition).lower()).load(folder)

    def listed(where: Column, digest: Column) -> DataFrame:
        own = [F.col(k).cast(t).alias(k) for k, t in (partition or {}).items()]
        return files.where(where).select(*own, "path", F.col("length").alias("size"), digest.alias("digest"), F.col("modificationTime").alias("updated"))

    # the bound on the length is pushed to the source: contents of larger files are never read
    return listed(F.col("length") <= LARGEST, F.md5("content")).unionByName(listed(F.col("length") > LARGEST, F.lit(None).cast("string")))


def partition_digests(store: LayerStore, dataset: str, layer: str) -> DataFrame:
    """One row a date: number and size of its files, and a digest of theirs that does not depend on their names or order."""
    files = file_digests(store.spark, store.path(dataset, layer), {DT: "date"}, "*.parquet")
    known = F.coalesce("digest", F.concat_ws(":", "size", F.col("updated").cast("string")))
    return files.groupBy(DT).agg(
        F.count("*").alias("files"), F.sum("size").alias("size"), F.md5(F.concat_ws(",", F.sort_array(F.collect_list(known)))).alias("digest"), F.max("updated").alias("updated")
    )


class VersionLog:
    """The versions of partitions of a store's tables, each with a generation that counts up from 1.

    Recording compares the stored files with the newest generation and appends those that differ. A repeated record of
    unchanged files appends nothing, so a failed one can be repeated.
    """

    def __init__(self, store: LayerStore, path: str | None = None):
        self.store, self.path = store, path or f"{store.root}/_versions"

    def scan(self) -> DataFrame:
        spark = self.store.spark
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return spark.createDataFrame([], LOG)
        return spark.read.schema(LOG).parquet(self.path)

    def newest(self, dataset: str, layer: str) -> DataFrame:
        """The newest generation of each date."""
        mine = self.scan().where((F.col("dataset") == dataset) & (F.col("layer") == layer))
        return mine.groupBy("dt").agg(F.max_by(F.struct("generation", "digest"), "generation").alias("_v")).select("dt", "_v.*")

    def record(self, dataset: str, layer: str) -> int:
        """Append the dates whose files differ from their newest generation; returns how many."""
        now = partition_digests(self.store, dataset, layer)
        old = self.newest(dataset, layer).select("dt", F.col("generation").alias("_g"), F.col("digest").alias("_d"))
        changed = now.join(old, "dt", "left").where(F.col("_d").isNull() | (F.col("_d") != F.col("digest")))
        row = changed.select(
            F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), "dt", (F.coalesce("_g", F.lit(0)) + 1).cast("bigint").alias("generation"),
            "files", "size", "digest", "updated")
        row = settle(row)
        n = row.count()
        if n:
            row.coalesce(1).write.mode("append").parquet(self.path)
        return n

    def versions(self, dataset: str, layer: str, date: str | None = None, limit: int = 10) -> DataFrame:
        """The newest ``limit`` generations of a date, or of each date, with whether the stored files still are that version."""
        mine = self.scan().where((F.col("dataset") == dataset) & (F.col("layer") == layer))
        if date is not None:
            mine = mine.where(F.col("dt") == F.lit(date).cast("date"))
        w = Window.partitionBy("dt").orderBy(F.desc("generation"))
        newest = mine.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
        now = partition_digests(self.store, dataset, layer).select("dt", F.col("digest").alias("_now"))
        live = F.coalesce((F.col("_rn") == 1) & (F.col("_now") == F.col("digest")), F.lit(False))
        return newest.join(now, "dt", "left").withColumn("is_live", live).drop("_rn", "_now")
