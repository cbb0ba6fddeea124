"""Slices of a table as grouped rows (dimension, value, size, pct); the data stays a filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates, numbers
from tessera.operators import ordering, profile
from tessera.operators.joining import scalar


def _total(df: DataFrame):
    return scalar(df, F.count("*"))


def by_category(df: DataFrame, dimension: str, min_size: int = 1) -> DataFrame:
    """Sizes per category; the percentage base is the full row count, NULL keys give no slice."""
    out = df.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).cast("string").alias("value"))
    out = out.agg(F.count("*").alias("size")).where(F.col("size") >= min_size)
    return out.select(
        F.lit(dimension).alias("dimension"), "value", "size", numbers.ratio(F.col("size") * 100, _total(df)).alias("pct")
    )


def _by_label(df: DataFrame, label, dimension: str, min_size: int) -> DataFrame:
    return by_category(df.withColumn("_label", label), "_label", min_size).withColumn("dimension", F.lit(dimension))


def by_quantiles(df: DataFrame, dimension: str, n: int = 4, labels: Sequence[str] | None = None, min_size: int = 1):
    """Right-closed bins between exact quantile edges; repeated edges collapse."""
    labels = list(labels or [f"Q{i + 1}" for i in range(n)])
    q = ordering.quantiles(df, [], dimension, {f"e{i}": i / n for i in range(n + 1)}).first()
    if q is None or q[0] is None:
        return _by_label(df.where(F.lit(False)), F.lit(""), dimension, min_size)
    edges = sorted(set(q))  # n + 1 numbers
    v, label = F.col(dimension), F.lit(None).cast("string")
    for i in range(len(edges) - 1, 0, -1):
        label = F.when(v <= edges[i], F.lit(labels[i - 1])).otherwise(label)
    return _by_label(df, F.when(v >= edges[0], label), f"{dimension}_quantile", min_size)


def by_ranges(df: DataFrame, dimension: str, ranges: Sequence[tuple[float, float, str]], min_size: int = 1) -> DataFrame:
    """Half-open ranges [lo, hi) with labels."""
    v, label = F.col(dimension), F.lit(None).cast("string")
    for lo, hi, name in reversed(list(ranges)):
        label = F.when((v >= lo) & (v < hi), F.lit(name)).otherwise(label)
    return _by_label(df, label, f"{dimension}_range", min_size)


def by_time_of_day(df: DataFrame, hour: str, min_size: int = 1) -> DataFrame:
    return by_ranges(df, hour, [(a, b, n.lower()) for a, b, n in dates.DAY_PERIODS], min_size)


def cross(df: DataFrame, dimensions: Sequence[str], min_size: int = 1) -> DataFrame:
    """Slices of a combination of dimensions, keyed "a_x_b"."""
    value = F.concat_ws("_x_", *[F.col(d).cast("string") for d in dimensions])
    rows = df
    for d in dimensions:
        rows = rows.where(F.col(d).isNotNull())
    out = rows.groupBy(value.alias("value")).agg(F.count("*").alias("size")).where(F.col("size") >= min_size)
    return out.select(
        F.lit("_x_".join(dimensions)).alias("dimension"), "value", "size",
        numbers.ratio(F.col("size") * 100, _total(df)).alias("pct"),
    )


def summary(df: DataFrame, dimensions: Sequence[str], min_size: int = 1) -> DataFrame:
    """Slices of the default dimensions; the column type picks the slicer."""
    parts = []
    for d in dimensions:
        if d not in df.columns:
            continue
        if d == "hour_of_day":
            parts.append(by_time_of_day(df, d, min_size))
        elif d in profile.numeric_columns(df):
            parts.append(by_quantiles(df, d, 4, None, min_size))
        else:
            parts.append(by_category(df, d, min_size))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_missing(df: DataFrame, dimension: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Slice size and share with the mean missing percentage over the other columns."""
    columns = list(columns or [c for c in df.columns if c != dimension])
    miss = sum((F.avg(F.col(c).isNull().cast("double")) for c in columns[1:]), F.avg(F.col(columns[0]).isNull().cast("double")))
    out = df.groupBy(dimension).agg(F.count("*").alias("size"), (miss / len(columns) * 100).alias("mean_missing_pct"))
    return out.withColumn("pct", numbers.ratio(F.col("size") * 100, _total(df)))


def null_percentages(df: DataFrame, dimension: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(dimension).agg(
        *[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"{c}_null_pct") for c in columns]
    )


def unusual_rates(df: DataFrame, dimension: str, metric: str, z: float = 2.0) -> DataFrame:
    """Slices whose mean metric is far from the overall mean in overall standard deviations."""
    mean, std = scalar(df, F.avg(metric)), scalar(df, F.stddev_samp(metric))
    out = df.groupBy(dimension).agg(F.avg(metric).alias("rate"), F.count(metric).alias("n"))
    out = out.withColumn("z_score", F.when(std > 0, (F.col("rate") - mean) / std).otherwise(0.0))
    return out.withColumns(
        {"flagged": F.abs("z_score") > z, "deviation_pct": numbers.ratio((F.col("rate") - mean) * 100, mean)}
    )


def unusual_sizes(df: DataFrame, dimension: str, z: float = 1.0) -> DataFrame:
    counts = df.groupBy(dimension).agg(F.count("*").alias("n"))
    mean, std = scalar(counts, F.avg("n")), scalar(counts, F.stddev_samp("n"))
    out = counts.withColumn("z_score", F.when(std > 0, (F.col("n") - mean) / std).otherwise(0.0))
    return out.withColumns(
        {"flagged": F.abs("z_score") > z, "deviation_pct": numbers.ratio((F.col("n") - mean) * 100, mean)}
    )


def representation_bands(df: DataFrame, dimension: str, under_pct: float = 3.0) -> DataFrame:
    """Share of rows, an under-represented flag, and a band against the uniform expectation."""
    counts = df.groupBy(dimension).agg(F.count("*").alias("n"))
    expected = _total(df) / scalar(counts, F.count("*"))
    pct = numbers.ratio(F.col("n") * 100, _total(df))
    band = (
        F.when(F.col("n") < expected * 0.7, "low").when(F.col("n") < expected * 0.9, "mid").otherwise("ok")
    )
    return counts.select(dimension, "n", pct.alias("pct"), (pct < under_pct).alias("under_represented"), band.alias("band"))


def high_medians(df: DataFrame, dimension: str, value: str, factor: float = 2.0) -> DataFrame:
    """Groups whose median is at least ``factor`` times the overall median."""
    overall = scalar(ordering.quantiles(df, [], value, {"m": 0.5}), F.first("m"))
    med = ordering.quantiles(df, [dimension], value, {"median": 0.5})
    return med.withColumn("flagged", F.col("median") >= overall * factor)


def small_groups(df: DataFrame, dimension: str, factor: float = 0.5) -> DataFrame:
    """Groups with at most ``factor`` times the mean group size."""
    counts = df.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") <= scalar(counts, F.avg("n")) * factor)
