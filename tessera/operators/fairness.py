"""Fairness checks over slices, group metrics of predictions and per-slice error gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import slices
from tessera.operators.joining import scalar
from tessera.operators.quality import GateFailed

REPRESENTATION = (0.6, 1.5)
OUTCOME = (0.25, 0.5)


def reference_share(value: Column, shares: Mapping[str, float] | None, default: Column) -> Column:
    """Expected percentage of a slice value; fractions below 1 are read as shares of 1."""
    if not shares:
        return default
    pairs = []
    for k, v in shares.items():
        pairs += [F.lit(str(k).strip().lower()), F.lit(float(v * 100 if 0 < v < 1 else v))]
    return F.coalesce(F.create_map(*pairs)[F.lower(F.trim(value))], default)


def representation(
    df: DataFrame, dimension: str, shares: Mapping[str, float] | None = None, min_size: int = 1,
    warning: float = REPRESENTATION[0], critical: float = REPRESENTATION[1],
) -> DataFrame:
    """Slice shares against reference shares (uniform where none is given)."""
    s = slices.by_category(df, dimension, min_size)
    uniform = F.lit(100.0) / scalar(s, F.count("*"))
    expected = reference_share(F.col("value"), shares, uniform)
    disparity = F.when(expected > 0, F.abs(F.col("pct") - expected) / expected).otherwise(F.col("pct") / 100)
    return s.select(
        F.lit("representation").alias("metric"), "dimension", "value", "size", expected.alias("expected"),
        F.col("pct").alias("actual"), disparity.alias("disparity"),
        numbers.severity(disparity, warning, critical).alias("severity"),
    )


def zero_or_one(column: str) -> Column:
    """A 0/1 (or boolean) column as int; any other value, such as a score, stops the query instead of being cut to 0."""
    value = F.col(column).cast("double")
    wrong = F.raise_error(F.concat(F.lit(f"{column} is not 0 or 1: "), value.cast("string"))).cast("int")
    return F.when(value.isNull() | value.isin(0.0, 1.0), value.cast("int")).otherwise(wrong)


def outcome_rates(df: DataFrame, dimension: str, outcome: str, min_size: int = 1) -> DataFrame:
    """Group rates of a 0/1 outcome with the overall rate and the parity difference. The overall
    numbers come from the group rows."""
    g = df.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).cast("string").alias("value")).agg(
        F.count("*").alias("size"), F.sum(zero_or_one(outcome)).alias("_pos")
    )
    g = g.where(F.col("size") >= min_size)
    rate = numbers.ratio("_pos", "size", 0.0)
    return g.select(
        "value", "size", rate.alias("rate"),
        scalar(g, F.sum("_pos") / F.sum("size")).alias("overall"),
        scalar(g, F.max(rate) - F.min(rate)).alias("parity_difference"),
        scalar(g, F.count("*")).alias("_groups"),
    )


def outcome_disparity(
    df: DataFrame, dimension: str, outcome: str, min_size: int = 1, warning: float = OUTCOME[0], critical: float = OUTCOME[1]
) -> DataFrame:
    r = outcome_rates(df, dimension, outcome, min_size).where("_groups >= 2")
    gap = F.abs(F.col("rate") - F.col("overall"))
    disparity = F.when(F.col("overall") > 0, gap / F.col("overall")).otherwise(F.abs("rate"))
    return r.select(
        F.lit("outcome_disparity").alias("metric"), F.lit(dimension).alias("dimension"), "value", "size",
        F.col("overall").alias("expected"), F.col("rate").alias("actual"), disparity.alias("disparity"),
        numbers.severity(disparity, warning, critical).alias("severity"),
    )


def evaluate(
    df: DataFrame, dimensions: Sequence[str], outcome: str | None = None,
    shares: Mapping[str, Mapping[str, float]] | None = None, min_size: int = 1, ignore: Sequence[str] = (),
) -> DataFrame:
    """All violations over the given dimensions. Dimensions absent from the table are reported as
    such rather than passing silently; ``ignore`` drops whole metrics."""
    parts = []
    for d in dimensions:
        if d not in df.columns:
            parts.append(
                df.sparkSession.range(1).select(
                    F.lit("dimension_missing").alias("metric"), F.lit(d).alias("dimension"), F.lit(None).cast("string").alias("value"),
                    F.lit(0).cast("bigint").alias("size"), F.lit(0.0).alias("expected"), F.lit(0.0).alias("actual"),
                    F.lit(0.0).alias("disparity"), F.lit("warning").alias("severity"),
                )
            )
            continue
        if "representation" not in ignore:
            parts.append(representation(df, d, (shares or {}).get(d), min_size))
        if outcome and "outcome_disparity" not in ignore:
            parts.append(outcome_disparity(df, d, outcome, min_size))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("severity != 'none'")


def report(violations: DataFrame) -> DataFrame:
    """Violation counts by severity and the pass flag (no critical violation)."""
    return violations.agg(
        F.count("*").alias("violations"), F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.count_if(F.col("severity") == "critical").alias("criticals"),
        (F.count_if(F.col("severity") == "critical") == 0).alias("passed"),
    )


def check(violations: DataFrame) -> DataFrame:
    if violations.where("severity = 'critical'").limit(1).count():
        raise GateFailed("critical fairness violations")
    return violations


def group_metrics(df: DataFrame, group: str, truth: str, predicted: str) -> DataFrame:
    """Classification metrics per group and overall (value NULL) from one rollup of confusion
    counts."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    c = df.where(F.col(group).isNotNull()).rollup(F.col(group).alias("value")).agg(
        F.count("*").alias("n"), F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision, recall = numbers.ratio(tp, tp + fp, 0.0), numbers.ratio(tp, tp + fn, 0.0)
    return c.select(
        "value", "n", numbers.ratio(tp + tn, "n").alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        numbers.ratio(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"), numbers.ratio(tp + fp, "n").alias("selection_rate"),
        numbers.ratio(fp, fp + tn, 0.0).alias("fpr"), numbers.ratio(fn, fn + tp, 0.0).alias("fnr"),
    )


METRICS = ("accuracy", "precision", "recall", "f1", "selection_rate", "fpr", "fnr")


def metric_spread(metrics: DataFrame) -> DataFrame:
    """Difference (max - min) and ratio (min / max) of each metric over the groups."""
    g = metrics.where("value is not null").agg(
        *[F.max(m).alias(f"_hi_{m}") for m in METRICS], *[F.min(m).alias(f"_lo_{m}") for m in METRICS]
    )
    items = [
        F.struct(
            F.lit(m).alias("metric"), (F.col(f"_hi_{m}") - F.col(f"_lo_{m}")).alias("difference"),
            numbers.ratio(f"_lo_{m}", f"_hi_{m}").alias("ratio"),
        )
        for m in METRICS
    ]
    return g.select(F.inline(F.array(*items)))


def disparate_impact(df: DataFrame, group: str, outcome: str) -> DataFrame:
    """Lowest over highest group rate and the 80 % rule."""
    r = outcome_rates(df, group, outcome)
    out = r.agg(numbers.ratio(F.min("rate"), F.max("rate")).alias("impact_ratio"))
    return out.withColumn("passes", F.col("impact_ratio") >= 0.8)


def equalized_odds(metrics: DataFrame) -> DataFrame:
    g = metrics.where("value is not null")
    tpr = F.max("recall") - F.min("recall")
    fpr = F.max("fpr") - F.min("fpr")
    return g.agg(tpr.alias("tpr_gap"), fpr.alias("fpr_gap"), F.greatest(tpr, fpr).alias("equalized_odds_difference"))


def slice_errors(df: DataFrame, dimensions: Sequence[str], truth: str, predicted: str, extra: Mapping[str, Column] | None = None):
    """RMSE per slice of every dimension in one pass, with the overall RMSE. ``extra`` adds named
    aggregate Columns (user-defined slice metrics)."""
    err = F.pow(F.col(truth) - F.col(predicted), 2)
    items = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    rows = df.select(F.inline(items), *[c for c in df.columns if c not in ("dimension", "value")])
    s = rows.groupBy("dimension", "value").agg(
        F.count("*").alias("count"), F.sqrt(F.avg(err)).alias("rmse"), *[c.alias(n) for n, c in (extra or {}).items()]
    )
    overall = scalar(df, F.sqrt(F.avg(err)))
    dev = numbers.ratio(F.abs(F.col("rmse") - overall), overall, 0.0)
    return s.withColumns({"overall_rmse": overall, "deviation": dev})


def slice_gate(
    df: DataFrame, dimensions: Sequence[str], truth: str, predicted: str, max_deviation=0.5, min_size=30, max_multiple=3.0,
    small_fail: bool = False,
) -> DataFrame:
    """Per-slice pass flags: deviation and multiple limits; small slices never fail the gate, and
    with ``small_fail`` still show whether they would."""
    s = slice_errors(df, dimensions, truth, predicted)
    small = F.col("count") < min_size
    over = (F.col("deviation") > max_deviation) | (F.col("rmse") > F.col("overall_rmse") * max_multiple)
    return s.select(
        "dimension", "value", F.round("rmse", 4).alias("rmse"), F.round(F.col("deviation") * 100, 2).alias("deviation_pct"),
        "count", small.alias("is_small"), (~over if small_fail else ~(over & ~small)).alias("passed"),
    )


def gate_summary(gate: DataFrame, count_small: bool = False) -> DataFrame:
    """Passed and failed slices and the worst one (small slices only count if asked)."""
    big = F.lit(True) if count_small else ~F.col("is_small")
    name = F.concat_ws("=", "dimension", "value")
    return gate.agg(
        F.count("*").alias("slices"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed") & ~F.col("is_small")).alias("failed"),
        F.max_by(F.when(big, name), F.when(big, F.struct("deviation_pct", name))).alias("worst_slice"),
        F.max(F.when(big, F.col("deviation_pct"))).alias("worst_deviation_pct"),
    )
