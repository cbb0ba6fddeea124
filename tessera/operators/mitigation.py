"""Bias mitigation: weights, resampling targets, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import fairness, ordering, sampling
from tessera.operators.joining import attach, scalar


def group_weights(df: DataFrame, dimension: str, inverse_share: bool = False) -> DataFrame:
    """Per group: size and weight n / (k · size), or n / size for the inverse-share variant."""
    sizes = df.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.count("*").alias("count"))
    n, k = scalar(sizes, F.sum("count")), scalar(sizes, F.count("*"))
    weight = n / F.col("count") if inverse_share else n / (k * F.col("count"))
    return sizes.withColumn("sample_weight", weight)


def reweight(df: DataFrame, dimension: str, inverse_share: bool = False) -> DataFrame:
    """Rows with inverse-frequency weights that sum to the row count; no shuffle of the rows."""
    return attach(df, group_weights(df, dimension, inverse_share).drop("count"), [dimension])


def reweight_actions(df: DataFrame, dimension: str) -> DataFrame:
    g = group_weights(df, dimension)
    n, k = scalar(g, F.sum("count")), scalar(g, F.count("*"))
    pct, expected = F.col("count") * 100.0 / n, F.lit(100.0) / k
    return g.select(
        F.col(dimension).alias("value"), "count", F.round("sample_weight", 4).alias("weight"),
        F.round(pct, 2).alias("original_pct"), F.round(expected, 2).alias("expected_pct"),
        (F.abs(pct - expected) / expected).alias("before_disparity"), F.lit(0.0).alias("after_disparity"),
    )


def _median_size(df: DataFrame, dimension: str):
    sizes = sampling.group_sizes(df, dimension)
    return scalar(ordering.quantiles(sizes, [], "_n", {"m": 0.5}), F.floor(F.first("m")))


def stratified(df: DataFrame, dimension: str, key: str) -> DataFrame:
    """Every group resampled to the median group size."""
    return sampling.resample(df, dimension, key, _median_size(df, dimension))


def oversample_to_share(df: DataFrame, dimension: str, key: str, pct: float) -> DataFrame:
    """Groups below ``pct`` percent of all rows grow to that floor; others are unchanged."""
    floor = F.floor(scalar(df, F.count("*")) * pct / 100)
    return sampling.resample(df, dimension, key, F.greatest(F.col("_n"), floor))


def oversample_to_largest(df: DataFrame, dimension: str, key: str, fraction: float = 0.5) -> DataFrame:
    """Groups below ``fraction`` of the largest group grow to that size."""
    top = scalar(sampling.group_sizes(df, dimension), F.max("_n"))
    return sampling.resample(df, dimension, key, F.greatest(F.col("_n"), F.floor(top * fraction)))


def undersample_to_second(df: DataFrame, dimension: str, key: str) -> DataFrame:
    """The dominant group shrinks to the size of the second largest."""
    sizes = sampling.group_sizes(df, dimension)
    second = scalar(sizes.orderBy(F.desc("_n")).limit(2), F.min("_n"))
    return sampling.resample(df, dimension, key, F.least(F.col("_n"), second))


def adjusted_thresholds(df: DataFrame, dimension: str, outcome: str, base: float = 0.5) -> DataFrame:
    """Per group: rate, threshold moved half-way against the rate gap, clipped to 0.1–0.9."""
    overall = scalar(df, F.avg(F.col(outcome).cast("double")))
    g = df.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.avg(F.col(outcome).cast("double")).alias("rate"))
    return g.withColumns(
        {
            "adjusted_threshold": numbers.clip(F.lit(base) - (overall - F.col("rate")) * 0.5, 0.1, 0.9),
            "before_disparity": F.when(overall > 0, F.abs(F.col("rate") - overall) / overall).otherwise(0.0),
        }
    )


def with_thresholds(df: DataFrame, dimension: str, outcome: str, base: float = 0.5) -> DataFrame:
    return attach(df, adjusted_thresholds(df, dimension, outcome, base).select(dimension, "adjusted_threshold"), [dimension])


THRESHOLD_GRID = tuple(round(0.25 + 0.05 * i, 2) for i in range(11))


def thresholds_for_fpr(df: DataFrame, group: str, truth: str, score: str, target=0.2, grid: Sequence[float] = THRESHOLD_GRID, least=5):
    """Per group the grid threshold whose false-positive rate is closest to the target. All grid
    points are counted in one conditional aggregation."""
    neg = F.col(truth) == 0
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(neg).alias("_neg"),
        *[F.count_if(neg & (F.col(score) > t)).alias(f"_fp{i}") for i, t in enumerate(grid)],
    )
    items = F.array(
        *[
            F.struct(F.lit(float(t)).alias("t"), (F.col(f"_fp{i}") / F.greatest("_neg", F.lit(1))).alias("fpr"))
            for i, t in enumerate(grid)
        ]
    )
    best = F.array_min(
        F.transform(items, lambda x: F.struct(F.round(F.abs(x["fpr"] - target), 9).alias("gap"), x["t"].alias("t"), x["fpr"].alias("fpr")))
    )
    return g.where(F.col("n") >= least).select(
        group, "n", best["t"].alias("threshold"), best["fpr"].alias("fpr"), best["gap"].alias("gap")
    )


def service_rate(df: DataFrame, group: str, amount: str) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("units"), F.sum(amount).alias("total"), numbers.ratio(F.sum(amount), F.count("*")).alias("per_unit")
    )


def comparison(runs: Mapping[str, DataFrame], group: str, truth: str, predicted: str) -> DataFrame:
    """Overall accuracy and the group gaps of several prediction tables, one row each."""
    out = None
    for name, df in runs.items():
        m = fairness.group_metrics(df, group, truth, predicted)
        by = F.col("value").isNotNull()

        def gap(c, by=by):
            return F.max(F.when(by, F.col(c))) - F.min(F.when(by, F.col(c)))

        row = m.agg(
            F.max(F.when(~by, F.col("accuracy"))).alias("accuracy"), gap("accuracy").alias("accuracy_gap"),
            gap("fpr").alias("fpr_gap"), gap("fnr").alias("fnr_gap"),
        ).select(F.lit(name).alias("method"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def mitigate(df: DataFrame, dimension: str, strategy: str = "reweighting", key: str | None = None, outcome: str | None = None):
    """Mitigation by strategy name."""
    if strategy == "reweighting":
        return reweight(df, dimension)
    if strategy == "stratified_sampling":
        return stratified(df, dimension, key)
    if strategy == "threshold_adjustment":
        return with_thresholds(df, dimension, outcome)
    raise ValueError(f"unknown strategy {strategy!r}")

