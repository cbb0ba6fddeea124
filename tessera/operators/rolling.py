"""Rolling measures over daily rows and whole-column or per-group scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joining import attach, scalar


def daily(df: DataFrame, keys: Sequence[str], ts: str, value: str | None = None) -> DataFrame:
    """One row per group and calendar day: row count, or mean of a value. The windows below run
    over these rows, so a group holds at most one row per day."""
    agg = F.count("*").alias("n") if value is None else F.avg(value).alias("mean")
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(agg)


def rolling_count(df, keys: Sequence[str], ts: str, rows: int, out: str) -> DataFrame:
    """Sum of daily counts over the last ``rows`` daily rows (gaps stretch the window)."""
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(-(rows - 1), 0)
    return daily(df, keys, ts).select(*keys, "day", F.sum("n").over(w).alias(out))


def rolling_count_days(df, keys: Sequence[str], ts: str, days: int, out: str) -> DataFrame:
    """Same over calendar days."""
    number = F.date_diff("day", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(number).rangeBetween(-(days - 1), 0)
    return daily(df, keys, ts).select(*keys, "day", F.sum("n").over(w).alias(out))


def rolling_mean(df, keys: Sequence[str], ts: str, value: str, rows: int, out: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(-(rows - 1), 0)
    return daily(df, keys, ts, value).select(*keys, "day", F.avg("mean").over(w).alias(out))


def minmax(df: DataFrame, value: str, out: str, scale: float = 1.0, constant: float = 0.0) -> DataFrame:
    """Whole-column min-max scaling; a constant column gives ``constant``."""
    lo, hi = scalar(df, F.min(value)), scalar(df, F.max(value))
    return df.withColumn(out, F.when(hi > lo, (F.col(value) - lo) / (hi - lo) * scale).otherwise(constant))


def zscore(df: DataFrame, value: str, out: str) -> DataFrame:
    mean, std = scalar(df, F.avg(value)), scalar(df, F.stddev_samp(value))
    return df.withColumn(out, F.when(std > 0, (F.col(value) - mean) / std).otherwise(0.0))


def minmax_by(df, keys: Sequence[str], value: str, out: str, scale=1.0, constant=0.0) -> DataFrame:
    """Min-max scaling inside each group, without shuffling rows by group."""
    stats = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    spread = F.col("_hi") - F.col("_lo")
    scaled = F.when(spread > 0, (F.col(value) - F.col("_lo")) / spread * scale).otherwise(constant)
    return attach(df, stats, keys).withColumn(out, scaled).drop("_lo", "_hi")


def zscore_by(df, keys: Sequence[str], value: str, out: str) -> DataFrame:
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    z = F.when(F.col("_s") > 0, (F.col(value) - F.col("_m")) / F.col("_s")).otherwise(0.0)
    return attach(df, stats, keys).withColumn(out, z).drop("_m", "_s")


def risk_scores(df, value: str, per_bucket: bool = True, bucket: str = "hour_bucket", out="risk_score") -> DataFrame:
    """0–100 scores, scaled within each bucket or over the table; 50 where nothing varies."""
    scaled = (
        minmax_by(df, [bucket], value, out, 100.0, 50.0) if per_bucket else minmax(df, value, out, 100.0, 50.0)
    )
    return scaled.withColumn(out, F.bround(out, 2))
