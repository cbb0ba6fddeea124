"""Windowed metric streams, alerts, session state and incremental ingest.

Every transformation works on a static or a streaming DataFrame, so the batch form is the same
code. ``run_available`` replays what is available and leaves a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_dir
from tessera.streaming.partials import FirstRows, Measure, PartialStore, WindowPartials, absorb_available


def file_stream(spark: SparkSession, folder: str, schema, glob: str, files_per_trigger: int | None = 100) -> DataFrame:
    """Parquet files of a folder as a stream, with bounded micro-batches; None: a trigger takes all files that are there."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A table of a folder as a stream, whether ``name``.parquet is a file or a folder of files."""
    # a pattern, because Spark's file stream takes a path without one for a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(f"{folder}/{{{name}.parquet}}")


def windowed(df: DataFrame, ts: str, size: str, keys: Sequence[str], aggs: Sequence[Column], late: str | None = None) -> DataFrame:
    """Tumbling-window aggregates. On a stream ``late`` is needed: windows older than that are closed, and what still arrives for
    them is dropped. Where nothing may be dropped, keep partials (``latency`` and the like, ``replayed``)."""
    if df.isStreaming:
        if not late:
            raise ValueError("a windowed stream without a bound on lateness keeps all windows for ever")
        df = df.withWatermark(ts, late)
    out = df.groupBy(F.window(ts, size), *keys).agg(*aggs)
    return out.select(F.col("window.start").alias("window_start"), *[c for c in out.columns if c != "window"])


def latency(ts="ts", value="value") -> WindowPartials:
    return WindowPartials(ts, "60 seconds", [], [Measure("mean_latency", "mean", value), Measure("max_latency", "max", value)])


def request_sums(ts="ts", status="status", code="status_code") -> WindowPartials:
    sums = [Measure("requests", "count"), Measure("errors", "count_if", F.col(code) >= 400), Measure("not_found", "count_if", F.col(code) == 404)]
    return WindowPartials(ts, "60 seconds", [status], sums)


def tier_counts(ts="ts", tier="tier", value="value") -> WindowPartials:
    return WindowPartials(ts, "300 seconds", [tier], [Measure("served", "count"), Measure("mean_value", "mean", value)])


def drift_series(ts="ts", feature="feature", value="value") -> WindowPartials:
    return WindowPartials(ts, "1 day", [feature], [Measure("mean_drift", "mean", value), Measure("max_drift", "max", value)])


def at_once(df: DataFrame, spec) -> DataFrame:
    """What the partials of a stream come to, from a table."""
    return spec.result(spec.of(df))


def replayed(stream: DataFrame, spec, name: str, retention: str | None) -> DataFrame:
    """Replay what a stream has through partials: all rows count, whatever the order of their files, and a batch reads no more
    than the partials of the last ``retention`` of event time."""
    spark = stream.sparkSession
    store = PartialStore(spark, scratch_dir(spark, name), spec, retention)
    found = absorb_available(stream, store).read()
    if found is None:
        empty = spark.createDataFrame([], stream.schema)
        return at_once(empty, spec)
    return found


def run_available(
    stream: DataFrame, name: str, keys: Sequence[str] | None, mode: str = "update", extra: Callable | None = None,
    parts: Iterable[Callable[[], object]] = (lambda: None,),
) -> DataFrame:
    """Replay a stream to a table. In update mode every micro-batch appends its changed groups with
    the batch number and the reader keeps the newest row per key; nothing is overwritten, so a
    retried batch is harmless. ``parts`` write the stream's input: after each the stream goes on from
    its checkpoint with what is there."""
    spark = stream.sparkSession
    base = scratch_dir(spark, name)
    out = f"{base}/out"

    def append(batch: DataFrame, batch_id: int):
        if extra is not None:
            batch = extra(batch)
        # one folder per batch, overwritten on retry
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for write in parts:
        write()
        query = (
            stream.writeStream.foreachBatch(append)
            .outputMode(mode)
            .option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    p = spark._jvm.org.apache.hadoop.fs.Path(out)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)  # not if the stream had nothing at all
    result = spark.read.schema(schema).parquet(out) if there else spark.createDataFrame([], schema)
    if keys is None:
        return result.drop("batch")
    rest = [c for c in stream.columns if c not in keys]
    newest = result.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*keys, "_r.*").select(*stream.columns)


# -- alerts ------------------------------------------------------------------------------------


def breaches(windows: DataFrame, value: str, limit: float, run: int = 5, start="window_start", seconds: int = 60) -> DataFrame:
    """Windows that end ``run`` consecutive windows above a limit. A window "votes" for the ``run``
    windows it can complete; a window with all votes is an alert. One shuffle on the window start,
    no per-key ordering."""
    hot = windows.where(F.col(value) > limit)
    votes = hot.select(
        F.explode(F.sequence(F.lit(0), F.lit(run - 1))).alias("_i"), F.col(start).alias("_s"), F.col(value).alias("_v")
    ).select((F.col("_s") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_i") * seconds).cast("decimal(18,6)"))).alias(start), "_i", "_v")
    full = votes.groupBy(start).agg(F.count("*").alias("_n"), F.max(F.when(F.col("_i") == 0, F.col("_v"))).alias("peak"))
    return full.where(F.col("_n") == run).select(start, "peak")


def threshold_alerts(row: DataFrame, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """(alert, column, limit) rules over wide metric rows; one output row per fired rule."""
    items = F.array(
        *[
            F.struct(F.lit(n).alias("alert"), F.col(c).cast("double").alias("observed"), F.lit(float(t)).alias("limit"))
            for n, c, t in rules
        ]
    )
    keep = [c for c in row.columns if c not in {c for _, c, _ in rules}]
    return row.select(*keep, F.inline(items)).where("observed > limit")


# -- sessions ----------------------------------------------------------------------------------


def session_rows(sessions: DataFrame) -> DataFrame:
    return sessions.select("conv_id", F.inline(F.arrays_zip("turns", "roles", "texts"))).toDF("conv_id", "turn", "role", "text")


# -- metric events -----------------------------------------------------------------------------


def request_metrics(df: DataFrame, keep: Sequence[str], status="status_code", value="value") -> DataFrame:
    """Each request as metric points: latency, a count, and an error flag for status ≥ 400."""
    labels = F.create_map(F.lit("status"), F.col(status).cast("string"))
    items = F.array(
        F.struct(F.lit("request_latency").alias("metric"), F.col(value).cast("double").alias("point"), labels.alias("labels")),
        F.struct(F.lit("request_count").alias("metric"), F.lit(1.0).alias("point"), labels.alias("labels")),
        F.struct(F.lit("request_error").alias("metric"), (F.col(status) >= 400).cast("double").alias("point"), labels.alias("labels")),
    )
    return df.select(*keep, F.inline(items))


def score_metrics(found: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Score-served and score-not-found points of a lookup."""
    name = F.when(F.col("found"), F.lit("score_served")).otherwise(F.lit("score_not_found"))
    return found.select(*keep, name.alias("metric"), F.when(F.col("found"), F.col("risk_score")).otherwise(1.0).alias("point"), F.col("risk_tier").alias("tier"))


def new_rows(key: Sequence[str], ts: str) -> FirstRows:
    """Each key's first row, as partials of a stream: rows past a stored watermark come through once."""
    return FirstRows(key, ts)
