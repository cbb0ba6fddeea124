"""Watermarks, run lineage, contract versions and the published score table, all as plain tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators.joining import scalar

# -- watermarks: (dataset, value, run_date) rows, newest value wins -----------------------------


def batch_watermark(df: DataFrame, dataset: str, ts: str, run_date: Column | None = None) -> DataFrame:
    """The watermark row a processed batch advances to."""
    run = F.to_date(F.max(ts)) if run_date is None else run_date
    return df.agg(F.lit(dataset).alias("dataset"), F.max(ts).alias("value"), run.alias("run_date")).where("value is not null")


def set_watermarks(history: DataFrame, new: DataFrame, depth: int = 10) -> DataFrame:
    """Append and keep the newest ``depth`` entries of each dataset."""
    both = history.unionByName(new)
    return agg.top_per_group(both, ["dataset"], [F.desc("run_date"), F.desc("value")], depth, "_rn").drop("_rn")


def current_watermarks(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset").agg(F.max_by("value", F.struct("run_date", "value")).alias("value"))


def effective_watermarks(datasets: DataFrame, history: DataFrame, as_of: Column, lookback_days: int) -> DataFrame:
    """Stored watermark, or the reference time minus the lookback where none is stored."""
    out = datasets.join(current_watermarks(history), "dataset", "left")
    return out.withColumn("value", F.coalesce("value", as_of - F.expr(f"INTERVAL {lookback_days} DAYS")))


def ingest_stats(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.max(ts).alias("watermark_end")).withColumn("columns", F.lit(len(df.columns)))


# -- lineage: one row per (dataset, run_date, layer) --------------------------------------------


def lineage_rows(df: DataFrame, dataset: str, layer: str, run: str, schema_version: Column, row_hash: Column | None = None) -> DataFrame:
    """A manifest row per run date: row count and a content version, the sum of the rows' hashes with their number.

    The version does not depend on the rows' order, and rows that occur twice count twice.
    """
    if row_hash is None:
        row_hash = F.xxhash64(*[c for c in df.columns if c != run])
    return df.groupBy(F.col(run).alias("run_date")).agg(
        F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), F.count("*").alias("rows"),
        F.first(schema_version).alias("schema_version"),
        F.concat_ws("-", F.sum(row_hash.cast("decimal(28,0)")).cast("string"), F.count("*").cast("string")).alias("version"),
    )


def history(manifest: DataFrame, dataset: str, limit: int) -> DataFrame:
    return manifest.where(F.col("dataset") == dataset).orderBy(F.desc("run_date"), "layer").limit(limit)


def runs_with_schema(manifest: DataFrame, layer: str, version) -> DataFrame:
    return manifest.where((F.col("layer") == layer) & (F.col("schema_version") == F.lit(version)))


def compare_runs(manifest: DataFrame, dataset: str, start: Column, end: Column) -> DataFrame:
    """Layers added, removed or changed between two run dates, with row counts."""
    rows = manifest.where((F.col("dataset") == dataset) & ((F.col("run_date") == start) | (F.col("run_date") == end)))
    first, second = F.col("run_date") == start, F.col("run_date") == end
    both = rows.groupBy("layer").agg(
        F.max(F.when(first, F.col("version"))).alias("_a"), F.max(F.when(second, F.col("version"))).alias("_b"),
        F.max(F.when(first, F.col("rows"))).alias("rows_from"), F.max(F.when(second, F.col("rows"))).alias("rows_to"),
    )
    status = (
        F.when(F.col("_a").isNull(), "added")
        .when(F.col("_b").isNull(), "removed")
        .when(F.col("_a") != F.col("_b"), "changed")
        .otherwise("same")
    )
    return both.select("layer", status.alias("status"), "rows_from", "rows_to")


# -- contract versions: (dataset, layer, version, column, type, nullable) ------------------------


def register_contract(registry: DataFrame | None, contract: DataFrame, dataset: str, layer: str, version: int) -> DataFrame:
    rows = contract.select(F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), F.lit(version).alias("version"), "*")
    return rows if registry is None else registry.unionByName(rows)


def latest_contract(registry: DataFrame, dataset: str, layer: str) -> DataFrame:
    mine = registry.where((F.col("dataset") == dataset) & (F.col("layer") == layer))
    return mine.where(F.col("version") == scalar(mine, F.max("version")))


def contract_versions(registry: DataFrame) -> DataFrame:
    return registry.groupBy("dataset", "layer", "version").agg(F.count("*").alias("columns"))


# -- published scores: one row per key ----------------------------------------------------------


def score_key() -> Column:
    return F.concat_ws("_", "h3_index", F.col("hour_bucket").cast("string"))


def upsert(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows replace stored rows of the same key."""
    return stored.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def drop_stale(stored: DataFrame, version: str) -> DataFrame:
    return stored.where(F.col("model_version") >= version)


def verify_publish(stored: DataFrame, version: str, expected: Column, share: float = 0.99) -> DataFrame:
    out = stored.agg(F.count_if(F.col("model_version") == version).alias("published"))
    out = out.withColumn("expected", expected)
    return out.withColumn("ok", F.col("published") >= F.col("expected") * share)


def table_stats(stored: DataFrame) -> DataFrame:
    """Row count per version and in total (version NULL)."""
    return stored.rollup("model_version").agg(F.count("*").alias("rows"))


# -- alert routing -------------------------------------------------------------------------------

# Channels per severity.
ROUTING: Mapping[str, Sequence[str]] = {"info": ("log",), "warning": ("log",), "critical": ("log", "slack", "email")}


def route(alerts: DataFrame, severity: str = "severity", routing: Mapping[str, Sequence[str]] = ROUTING) -> DataFrame:
    """One row per alert and channel."""
    pairs = []
    for k, v in routing.items():
        pairs += [F.lit(k), F.array(*[F.lit(c) for c in v])]
    channels = F.coalesce(F.create_map(*pairs)[F.col(severity)], F.array(*[F.lit(c) for c in routing["info"]]))
    return alerts.withColumn("channel", F.explode(channels))


