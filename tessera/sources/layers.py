"""Dated layer tables (``layer/dataset/dt=…``), file sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators import clean

DT = "dt"


@dataclass(frozen=True)
class LayerStore:
    """Parquet tables under ``root/layer/dataset`` partitioned by date. ``merge_schema`` reads the
    footers of all files to unite differing columns; leave it off for large stable tables."""

    spark: SparkSession
    root: str
    merge_schema: bool = False

    def path(self, dataset: str, layer: str) -> str:
        return f"{self.root}/{layer}/{dataset}"

    def scan(self, dataset: str, layer: str) -> DataFrame:
        return (
            self.spark.read.option("mergeSchema", str(self.merge_schema).lower())
            .option("ignoreMissingFiles", "true")
            .parquet(self.path(dataset, layer))
        )

    def write(self, df: DataFrame, dataset: str, layer: str, date: str | None = None) -> None:
        """Overwrite only the dates present in the frame. The rebalance hint lets AQE split a date
        that holds far more rows than the others."""
        if date is not None:
            df = df.withColumn(DT, F.lit(date).cast("date"))
        (
            df.hint("rebalance", F.col(DT))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DT)
            .parquet(self.path(dataset, layer))
        )
        self._point(dataset, layer, date or max(self.stored_dates(dataset, layer), default=None))

    def write_counted(self, df: DataFrame, dataset: str, layer: str, date: str, **counts: Column) -> dict:
        """Write one date and return aggregates of its rows, taken by the tasks that write them: no second read.

        The rows are written as they come, without a shuffle, so that a task that is run again does not count twice.
        """
        seen = Observation()
        rows = df.observe(seen, F.count("*").alias("rows"), *[c.alias(n) for n, c in counts.items()])
        rows = rows.withColumn(DT, F.lit(date).cast("date"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DT).parquet(self.path(dataset, layer))
        self._point(dataset, layer, date)
        return seen.get

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _point(self, dataset: str, layer: str, date: str | None) -> None:
        """Move the table's pointer to a date. Readers of the table pass over files that begin with an underscore."""
        if date is not None:
            p, fs = self._fs(f"{self.path(dataset, layer)}/_latest")
            file = fs.create(p, True)
            file.writeBytes(str(date))
            file.close()

    def pointer(self, dataset: str, layer: str) -> str | None:
        """The date that was written last, or None where nothing has been."""
        p, fs = self._fs(f"{self.path(dataset, layer)}/_latest")
        if not fs.exists(p):
            return None
        file = fs.open(p)
        try:
            return bytes(file.readAllBytes()).decode()
        finally:
            file.close()

    def stored_dates(self, dataset: str, layer: str) -> list[str]:
        """Dates with a partition, from a listing of the table's folder; no data file is opened."""
        p, fs = self._fs(self.path(dataset, layer))
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{DT}=") and "HIVE_DEFAULT" not in n)

    def partition(self, dataset: str, layer: str, date: str) -> DataFrame:
        return self.scan(dataset, layer).where(F.col(DT) == F.lit(date).cast("date"))

    def between(self, dataset, layer, after: str, before: str, columns: Sequence[str] | None = None) -> DataFrame:
        """All partitions in the closed date range, with the path date as ``date``."""
        df = self.scan(dataset, layer).where(F.col(DT).between(F.lit(after).cast("date"), F.lit(before).cast("date")))
        keep = columns or [c for c in df.columns if c != DT]
        return df.select(*keep, F.col(DT).alias("date"))

    def trailing(self, dataset, layer, as_of: str, days: int = 90) -> DataFrame:
        """Existing partitions of the trailing window; absent dates are skipped."""
        end = F.lit(as_of).cast("date")
        return self.scan(dataset, layer).where((F.col(DT) > F.date_sub(end, days)) & (F.col(DT) <= end))

    def dates(self, dataset, layer, after: str | None = None, before: str | None = None, newest_first=False) -> DataFrame:
        """Partition dates, from the folder listing: one entry per date, whatever the number of files and rows."""
        found = [(x,) for x in self.stored_dates(dataset, layer)]
        d = self.spark.createDataFrame(found, f"{DT} string").select(F.col(DT).cast("date").alias(DT))
        if after:
            d = d.where(F.col(DT) >= F.lit(after).cast("date"))
        if before:
            d = d.where(F.col(DT) <= F.lit(before).cast("date"))
        return d.orderBy(F.desc(DT) if newest_first else DT)

    def latest(self, dataset: str, layer: str) -> DataFrame:
        """The snapshot that the pointer names, or the newest date of a table without one; only that partition is scanned."""
        date = self.pointer(dataset, layer) or max(self.stored_dates(dataset, layer), default=None)
        return self.partition(dataset, layer, date) if date else self.scan(dataset, layer).limit(0)

    def files(self, dataset: str, layer: str) -> DataFrame:
        """File metadata per partition from the hidden metadata column."""
        m = F.col("_metadata")
        return self.scan(dataset, layer).groupBy(DT, m["file_path"].alias("path")).agg(
            F.max(m["file_size"]).alias("size"), F.max(m["file_modification_time"]).alias("updated"), F.count("*").alias("rows")
        )


def incremental(df: DataFrame, ts: str, since, until=None) -> DataFrame:
    """Rows with ``since ≤ ts ≤ until``; the range reaches the Parquet scan."""
    out = df.where(F.col(ts) >= since)
    return out if until is None else out.where(F.col(ts) <= until)


def by_month(df: DataFrame, ts: str, since, until) -> DataFrame:
    """End-exclusive pull with the calendar month each row belongs to."""
    return df.where((F.col(ts) >= since) & (F.col(ts) < until)).withColumn("month_start", F.trunc(F.col(ts).cast("date"), "MM"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text columns with normalised headers; typing is left to lenient casts."""
    return clean.normalise_headers(spark.read.option("header", True).option("multiLine", False).csv(path))


def synthetic_ids(df: DataFrame, order: str, out: str = "_id") -> DataFrame:
    """Dense 1-based ids in the order of a column, without a global sort. Every row gets its own id: ties are told apart
    by a row hash, and rows without a value come last."""
    from tessera.operators.ordering import numbered

    return numbered(df, order, "_before").withColumn(out, (F.col("_before") + 1).cast("bigint")).drop("_before")


def schedule_csv(spark, path: str, mapping: Mapping[str, str], defaults: Mapping[str, object], contract: Mapping[str, str], order: str):
    """Downloaded schedule: headers, renames, default columns, ids, contract projection."""
    df = clean.with_defaults(clean.rename(read_csv(spark, path), mapping), defaults)
    df = synthetic_ids(df.withColumn(order, F.col(order).try_cast("bigint")), order)
    return clean.reindex(df, contract)


def spreadsheet_csv(spark, path: str, mapping, contract, id_column: str, max_id: int = 50, tokens=("NOT AVAILABLE", "N/A")):
    """Spreadsheet export: null tokens, footer rows (over-long ids) dropped, contract projection."""
    from tessera.functions.strings import null_tokens

    df = read_csv(spark, path)
    df = df.select(*[null_tokens(c, tokens).alias(c) for c in df.columns])
    df = clean.rename(df, mapping).where(F.length(id_column) < max_id)
    return df.select(*[F.col(c).try_cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in contract.items()])


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
