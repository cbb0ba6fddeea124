"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch that is handed to Python: bounds a worker's memory when texts are long.
BATCH_ROWS = 512


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Hand Python workers batches of few rows; texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: later steps start from the files, also after lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def forget(*frames: DataFrame) -> None:
    """Delete what ``settle`` wrote for frames that nothing needs any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, whatever others there are: Spark itself takes ``text`` and ``Text`` for one name."""
    at = [df.columns.index(n) for n in names]
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[F.col(f"c{i}").alias(n) for i, n in zip(at, names)])


def id_crc(column: str) -> Column:
    """crc32 of an integer id's decimal text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def batches(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (b for b in parts if b.num_rows)


def out(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def text_bytes(column: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column one after another, A-Z lower-cased if asked for, and the rows' offsets. Null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    column = pa.concat_arrays([column])  # offsets from 0
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    if fold:
        raw = FOLD[raw]
    return raw, offsets - offsets[0]


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def digests(raw: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each stretch of bytes, eight bytes a step."""
    wide = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray((len(raw) + 1,), "<u8", wide, strides=(1,))
    a = (length.astype(np.uint64) + np.uint64(1)) * MIX[0]
    b = a ^ MIX[3]
    left, at, open_ = length.astype(np.int64), starts.astype(np.int64), np.arange(len(starts))
    while len(open_):
        n = left[open_]
        w = words[at[open_]] & KEEP[np.minimum(n, 8)]
        x = (a[open_] ^ w) * MIX[1]
        a[open_] = x ^ (x >> np.uint64(29))
        y = (b[open_] + w) * MIX[2]
        b[open_] = y ^ (y >> np.uint64(32))
        more = n > 8
        open_ = open_[more]
        left[open_] -= 8
        at[open_] += 8
    a *= MIX[2]
    b *= MIX[0]
    return (a ^ (a >> np.uint64(31))) | np.uint64(1), b ^ (b >> np.uint64(30))


MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


#: Most classes that a classifier learns, the largest ones; their counts pass through the driver.
CLASSES = 200


def bounded_sample(df: DataFrame, column: str, per_class: int) -> tuple[DataFrame, dict]:
    """About ``per_class`` rows of each class (all, if it has fewer), chosen by a hash of the row, and the classes' row counts.

    Of more than CLASSES classes, the largest ones are taken, of equal ones the first by name. Equal rows are drawn together;
    an id among the columns draws them one by one.
    """
    sizes = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(CLASSES)
    counts = {r[0]: r[1] for r in sizes.collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(column) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 30)) < share * (1 << 30)
    return df.filter(drawn), counts
