"""Grouped measures: trailing windows, modes, ratios, crosstabs, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.functions.dates import days_before
from tessera.operators import ordering
from tessera.operators.joining import constant, scalar


def since(ts: str, ref: Column, days: int) -> Column:
    """Inside the trailing window; the lower bound is closed and there is no upper bound."""
    return F.col(ts) >= days_before(ref, days)


def latest(df: DataFrame, ts: str) -> Column:
    """The newest event time as a literal."""
    return constant(df, F.max(ts))


def trailing_counts(ts: str, ref: Column, windows: Mapping[str, int]) -> list[Column]:
    return [F.count_if(since(ts, ref, d)).alias(name) for name, d in windows.items()]


def windowed_sum(value, ts: str, ref: Column, days: int) -> Column:
    return F.coalesce(F.sum(F.when(since(ts, ref, days), value)), F.lit(0.0))


def mean_if(cond: Column, within: Column | None = None) -> Column:
    """Share of rows (of those ``within``) that meet a condition; 0 when there are none."""
    hit = cond if within is None else cond & within
    base = F.count(F.lit(1)) if within is None else F.count_if(within)
    return numbers.ratio(F.count_if(hit), base, 0.0)


def mode(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per group, ties to the smallest. Counts per (group, value)
    first, so no task holds a group's value map."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias(out or value))


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Count and share of each non-NULL value (share of the non-NULL rows)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    total = scalar(df, F.count(value))
    return counts.withColumn("share", numbers.ratio("n", total))


def top_values(df: DataFrame, value: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; equal counts in value order."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), value).limit(n)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence, shares: bool = False) -> DataFrame:
    """Counts of ``column``'s listed values per ``row`` value, optionally as row shares. A
    conditional aggregate, so one shuffle and a fixed column order."""
    counts = df.groupBy(row).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"{column}_{v}") for v in values]
    )
    if not shares:
        return counts
    names = [f"{column}_{v}" for v in values]
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return counts.select(row, *[numbers.ratio(c, total, 0.0).alias(c) for c in names])


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence, value: str) -> DataFrame:
    return df.groupBy(row).agg(
        *[F.avg(F.when(F.col(column) == F.lit(v), F.col(value))).alias(f"{column}_{v}") for v in values]
    )


def pivot_last(df, row: str, column: str, values: Sequence, value: str, order: Sequence[str]) -> DataFrame:
    """Last value in the given order for each listed column value."""
    rank = F.struct(*order)
    return df.groupBy(row).agg(
        *[
            F.max_by(F.when(F.col(column) == F.lit(v), F.col(value)), F.when(F.col(column) == F.lit(v), rank)).alias(
                str(v)
            )
            for v in values
        ]
    )


def group_table(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """count, sum, mean and exact median of a value per group."""
    also = {"n": F.count("*"), "total": F.sum(value), "mean": F.avg(value)}
    return ordering.group_quantiles(df, keys, value, {"median": 0.5}, also)


def disparity(stats: DataFrame, value: str) -> DataFrame:
    """Largest against smallest group value: ratio and gap, one row."""
    hi, lo = F.max(value), F.min(value)
    return stats.agg(
        hi.alias("highest"), lo.alias("lowest"), numbers.ratio(hi, lo).alias("ratio"), (hi - lo).alias("gap")
    )


def variation(stats: DataFrame, value: str) -> DataFrame:
    """Coefficient of variation of group means, with a rating."""
    cv = numbers.ratio(F.stddev_samp(value), F.avg(value))
    out = stats.agg(cv.alias("cv"))
    return out.withColumn(
        "rating",
        F.when(F.col("cv") > 0.3, "high").when(F.col("cv") < 0.15, "acceptable").otherwise("moderate"),
    )


def groups_without(df: DataFrame, group: str, category: str, value) -> DataFrame:
    """Groups that have rows but none in the given category."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count("*").alias("n"), F.count_if(F.col(category) == F.lit(value)).alias("hits"))
        .where("hits = 0")
        .drop("hits")
    )


def grid_coverage(df: DataFrame, x: str, y: str, cells_total: int) -> DataFrame:
    """Populated cells of a fixed grid: how many, their share, mean and max count, empty cells."""
    counts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("populated"),
        (F.count("*") / cells_total).alias("coverage"),
        F.avg("n").alias("mean_count"),
        F.max("n").alias("max_count"),
        (F.lit(cells_total) - F.count("*")).alias("empty"),
    )


def describe(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """One row per numeric column: moments with bias-corrected skewness and kurtosis, quantiles."""
    long = melt(df, columns)
    n = F.count("value").cast("double")
    skew = F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis("value") + 6)
    base = long.groupBy("column").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.when(n > 2, skew).alias("skewness"), F.when(n > 3, kurt).alias("kurtosis"),
    )
    return base.join(ordering.quantiles(long, ["column"], "value", dict(probs)), "column", "left")


def melt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns as (column, value) rows; NaN reads as NULL."""
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias("value"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair from one pass."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    items = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*items)))


def wide_shares(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each numeric attribute's sum and its share of the row group's total."""
    sums = df.groupBy(*keys).agg(*[F.sum(c).cast("double").alias(c) for c in columns])
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in columns[1:]), F.coalesce(F.col(columns[0]), F.lit(0.0)))
    items = [
        F.struct(F.lit(c).alias("attribute"), F.col(c).alias("amount"), numbers.ratio(c, total, 0.0).alias("share"))
        for c in columns
    ]
    return sums.select(*keys, F.inline(F.array(*items)))


def daily_summary(df: DataFrame, ts: str) -> DataFrame:
    daily = df.groupBy(F.to_date(ts).alias("d")).agg(F.count("*").alias("n"))
    return daily.agg(
        F.count("*").alias("days"), F.avg("n").alias("mean_per_day"),
        F.min("n").alias("min_per_day"), F.max("n").alias("max_per_day"),
    )


def score_summary(scores: DataFrame, cell="h3_index", score="risk_score", tier="risk_tier") -> DataFrame:
    base = scores.agg(
        F.count("*").alias("rows"), F.count_distinct(cell).alias("cells"), F.avg(score).alias("mean_score"),
        *[F.count_if(F.col(tier) == t).alias(f"tier_{t.lower()}") for t in ("LOW", "MEDIUM", "HIGH")],
    )
    median = ordering.quantiles(scores, [], score, {"median_score": 0.5})
    return base.withColumn("median_score", scalar(median, F.first("median_score")))


def weekend_gap(df: DataFrame, group: str, ts: str, value: str, flag_pct: float = 10.0) -> DataFrame:
    from tessera.functions.dates import is_weekend

    w = is_weekend(ts)
    out = df.groupBy(group).agg(
        F.avg(F.when(~w, F.col(value))).alias("weekday_mean"), F.avg(F.when(w, F.col(value))).alias("weekend_mean")
    )
    gap = F.abs(F.col("weekend_mean") - F.col("weekday_mean")) * 100
    out = out.withColumn("gap_pct", numbers.ratio(gap, F.abs(F.col("weekday_mean"))))
    return out.withColumn("flagged", F.coalesce(F.col("gap_pct") > flag_pct, F.lit(False)))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank="rank") -> DataFrame:
    """First ``n`` rows per group. Spark limits each map task to ``n`` rows per key before the
    shuffle (WindowGroupLimit), so a hot key does not reach one task whole."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
