"""Stream results as mergeable partials: no row is lost, however late, and what a batch reads stays bounded.

A micro-batch is reduced to partials (sums, counts, extremes by window and key, or the rows of new keys) without operator
state. A ``PartialStore`` writes them in one folder a batch, merged with the *open* partials of the folder before: those of the
last ``retention`` of event time before the newest one seen, which are all that a batch reads. Older partials are *sealed*:
they stay where they are and no batch reads them again. A partial that arrives after its window was sealed is sealed as well,
next to the others. Readers merge the newest folder and the sealed partials of the others, so the result is that of one batch
over all rows.

A folder counts once its edge, the time from which on its partials are open, is written beside it. A retried batch starts
from the folder before it and writes its own again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Sealed folders that are put together at a time.
FAN = 16


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be computed in parts: ``kind`` is count, sum, mean, min or max of a column, or count_if of
    a condition, which may be SQL text."""

    name: str
    kind: str
    column: str | Column | None = None

    def parts(self) -> dict[str, Column]:
        c = self.column
        if isinstance(c, str):
            c = F.expr(c) if self.kind == "count_if" else F.col(c)
        one = {"count": lambda: F.count("*" if c is None else c), "count_if": lambda: F.count_if(c), "sum": lambda: F.sum(c), "min": lambda: F.min(c), "max": lambda: F.max(c)}
        if self.kind == "mean":
            return {f"{self.name}_sum": F.sum(c.cast("double")), f"{self.name}_n": F.count(c)}
        return {self.name: one[self.kind]()}

    def merged(self) -> list[Column]:
        how = {"min": F.min, "max": F.max}.get(self.kind, F.sum)
        return [how(n).alias(n) for n in ([f"{self.name}_sum", f"{self.name}_n"] if self.kind == "mean" else [self.name])]

    def result(self) -> Column:
        return (F.try_divide(f"{self.name}_sum", f"{self.name}_n") if self.kind == "mean" else F.col(self.name)).alias(self.name)


@dataclass(frozen=True)
class WindowPartials:
    """Tumbling windows by key. A row without a time has no window and is not counted, as in a windowed aggregate."""

    ts: str
    size: str
    keys: Sequence[str]
    measures: Sequence[Measure]
    at: str = "window_start"

    def of(self, batch: DataFrame) -> DataFrame:
        parts = [c.alias(n) for m in self.measures for n, c in m.parts().items()]
        out = batch.groupBy(F.window(self.ts, self.size), *self.keys).agg(*parts)
        return out.select(F.col("window.start").alias(self.at), *[c for c in out.columns if c != "window"])

    def merge(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(self.at, *self.keys).agg(*[c for m in self.measures for c in m.merged()])

    def result(self, partials: DataFrame) -> DataFrame:
        return self.merge(partials).select(self.at, *self.keys, *[m.result() for m in self.measures])


@dataclass(frozen=True)
class FirstRows:
    """The first row of each key, by time and then by the row's values; keys may be null."""

    key: Sequence[str]
    at: str

    def of(self, batch: DataFrame) -> DataFrame:
        return self.merge(batch)

    def merge(self, partials: DataFrame) -> DataFrame:
        rest = [c for c in partials.columns if c not in self.key]
        values = [self.at, *[c for c in rest if c != self.at]]
        first = partials.groupBy(*self.key).agg(F.min(F.struct(*values)).alias("_first"))
        return first.select(*self.key, "_first.*").select(*partials.columns)

    def result(self, partials: DataFrame) -> DataFrame:
        return self.merge(partials)


class PartialStore:
    """Partials under a folder that all executors reach.

    ``retention`` is an interval such as ``"2 hours"`` or None, which keeps all partials open: then every batch reads the whole
    result. The open rows are at most the keys times the windows of the retention. Partials without a time are sealed at once.
    """

    def __init__(self, spark: SparkSession, path: str, spec, retention: str | None):
        self.spark, self.path, self.spec, self.retention = spark, path, spec, retention
        self._schema = None

    def _fs(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, kind: str, mark: str) -> list[int]:
        """Numbers of the complete folders of a kind."""
        p, fs = self._fs(kind)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit() and fs.exists(self._fs(f"{kind}/{n}/{mark}")[0]))

    def batches(self) -> list[int]:
        return self._numbers("batches", "_edge")

    def runs(self) -> list[int]:
        """Numbers of the last batches whose sealed partials were put together; the newest one holds all before it."""
        return self._numbers("runs", "_SUCCESS")

    def _load(self, kind: str, number: int) -> DataFrame:
        if self._schema is None:
            self._schema = self.spark.read.parquet(f"{self.path}/{kind}/{number}").schema
        return self.spark.read.schema(self._schema).parquet(f"{self.path}/{kind}/{number}")

    def _delete(self, kind: str, number: int) -> None:
        p, fs = self._fs(f"{kind}/{number}")
        fs.delete(p, True)

    def _edge(self, number: int) -> Column | None:
        """The time from which on partials of a folder are open; None if all are."""
        p, fs = self._fs(f"batches/{number}/_edge")
        file = fs.open(p)
        try:
            text = bytes(file.readAllBytes()).decode()
        finally:
            file.close()
        return F.lit(text).cast(self._schema[self.spec.at].dataType) if text else None

    def _open(self, number: int) -> DataFrame:
        rows = self._load("batches", number)
        edge = self._edge(number)
        return rows if edge is None else rows.where(F.col(self.spec.at) >= edge)

    def _sealed(self, number: int) -> DataFrame:
        rows = self._load("batches", number)
        edge = self._edge(number)
        return rows.where("false" if edge is None else F.coalesce(F.col(self.spec.at) < edge, F.lit(True)))

    def absorb(self, batch: DataFrame, batch_id: int) -> None:
        """Take in the rows of a micro-batch; to be called by ``foreachBatch``. One job, besides now and then one that puts
        sealed partials together."""
        before = [n for n in self.batches() if n < batch_id]
        partials = self.spec.of(batch)
        if before:
            partials = self.spec.merge(partials.unionByName(self._open(before[-1])))
        kind = partials.schema[self.spec.at].dataType
        seen = Observation()
        last = F.max(self.spec.at)
        edge = last if self.retention is None else last - F.expr(f"INTERVAL {self.retention}")
        observed = partials.observe(seen, edge.cast(kind).cast("string").alias("edge"))
        p, fs = self._fs(f"batches/{batch_id}/_edge")
        fs.delete(p, False)
        observed.write.mode("overwrite").parquet(f"{self.path}/batches/{batch_id}")
        file = fs.create(p, True)
        file.writeBytes((seen.get["edge"] or "") if self.retention is not None else "")
        file.close()
        self.compact(batch_id)

    def compact(self, batch_id: int) -> None:
        """Put sealed partials together once FAN folders have come up. The newest two folders stay: one may be run again, and
        starts from the other."""
        runs = self.runs()
        done = runs[-1] if runs else -1
        old = [n for n in self.batches() if n < batch_id][:-1]
        for n in old:  # left over from an earlier run that was complete
            if n <= done:
                self._delete("batches", n)
        new = [n for n in old if n > done]
        if len(new) < FAN:
            return
        frames = [self._sealed(n) for n in new] + ([self._load("runs", done)] if runs else [])
        self.spec.merge(reduce(DataFrame.unionByName, frames)).write.mode("overwrite").parquet(f"{self.path}/runs/{new[-1]}")
        for n in new:
            self._delete("batches", n)
        for n in runs[:-1]:
            self._delete("runs", n)

    def open(self) -> DataFrame | None:
        """What the next batch will read."""
        found = self.batches()
        return self._open(found[-1]) if found else None

    def read(self) -> DataFrame | None:
        """The result over all rows so far; None before the first batch."""
        found, runs = self.batches(), self.runs()
        if not found:
            return None
        done = runs[-1] if runs else -1
        frames = [self._load("batches", found[-1]), *[self._sealed(n) for n in found[:-1] if n > done], *[self._load("runs", n) for n in runs[-1:]]]
        return self.spec.result(reduce(DataFrame.unionByName, frames))


def absorb_available(stream: DataFrame, store: PartialStore, keep: Callable[[DataFrame], DataFrame] = lambda b: b) -> PartialStore:
    """Run a stream over what is available, or go on where an earlier run of the same store ended."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, n: store.absorb(keep(batch), n))
        .option("checkpointLocation", f"{store.path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store
