"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import numbers
from tessera.operators import aggregates as agg
from tessera.operators import ordering, profile, stat_tests

EPSILON = 1e-6
BINS = 10
WARNING, CRITICAL = 0.1, 0.25


def _sides(current: DataFrame, reference: DataFrame) -> DataFrame:
    return current.withColumn("current", F.lit(True)).unionByName(reference.withColumn("current", F.lit(False)))


def psi_term(cur: Column, ref: Column) -> Column:
    c, r = F.greatest(cur, F.lit(EPSILON)), F.greatest(ref, F.lit(EPSILON))
    return (c - r) * F.log(c / r)


def _psi(counts: DataFrame) -> DataFrame:
    """PSI per column from (column, part, n_cur, n_ref) counts. Totals come from the counts."""
    totals = counts.groupBy("column").agg(F.sum("n_cur").alias("_tc"), F.sum("n_ref").alias("_tr"))
    joined = counts.join(totals, "column")
    term = psi_term(numbers.ratio("n_cur", "_tc", 0.0), numbers.ratio("n_ref", "_tr", 0.0))
    return joined.groupBy("column").agg(
        F.when((F.max("_tc") > 0) & (F.max("_tr") > 0), F.sum(term)).otherwise(0.0).alias("psi")
    )


def equal_width_bin(value: Column, lo: Column, hi: Column, bins: int = BINS) -> Column:
    """1-based bin between evenly spaced edges, the last bin closed."""
    step = (hi - lo) / bins
    out = F.lit(1)
    for i in range(1, bins):
        out = out + (value >= step * i + lo).cast("int")
    return out


def psi_numeric(current: DataFrame, reference: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """PSI of every numeric column over equal-width bins of the joint range; all columns share one
    pass for the ranges and one shuffle of bin counts."""
    long = _sides(agg.melt(current, columns), agg.melt(reference, columns)).where("value is not null")
    ranges = long.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    binned = long.join(F.broadcast(ranges), "column")  # one row per column of the table
    counts = binned.groupBy("column", equal_width_bin(F.col("value"), F.col("_lo"), F.col("_hi"), bins).alias("part")).agg(
        F.count_if("current").alias("n_cur"), F.count_if(~F.col("current")).alias("n_ref")
    )
    return _psi(counts)


def psi_categorical(current: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PSI over the union of values, per column."""

    def melt(df):
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("part")) for c in columns]
        return df.select(F.inline(F.array(*pairs))).where("part is not null")

    counts = _sides(melt(current), melt(reference)).groupBy("column", "part").agg(
        F.count_if("current").alias("n_cur"), F.count_if(~F.col("current")).alias("n_ref")
    )
    return _psi(counts)


def split_columns(current: DataFrame, reference: DataFrame, ignore: Sequence[str] = (), only=None):
    """Shared columns by kind; booleans count as categorical."""
    shared = [c for c in current.columns if c in reference.columns and c not in ignore]
    if only:
        shared = [c for c in shared if c in only] or shared
    numeric = [c for c in shared if c in profile.numeric_columns(current)]
    return numeric, [c for c in shared if c not in numeric]


def detect(
    current: DataFrame,
    reference: DataFrame,
    ignore: Sequence[str] = (),
    only: Sequence[str] | None = None,
    warning: float = WARNING,
    critical: float = CRITICAL,
) -> DataFrame:
    """One row per shared column: kind, PSI and severity."""
    numeric, other = split_columns(current, reference, ignore, only)
    parts = []
    if numeric:
        parts.append(psi_numeric(current, reference, numeric).withColumn("kind", F.lit("numerical")))
    if other:
        parts.append(psi_categorical(current, reference, other).withColumn("kind", F.lit("categorical")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select("column", "kind", "psi", numbers.severity("psi", warning, critical).alias("severity"))


def numeric_stats(current: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Side-by-side mean, std, min, max and exact median of both tables."""
    long = _sides(agg.melt(current, columns), agg.melt(reference, columns)).where("value is not null")
    long = long.withColumn("side", F.when(F.col("current"), "current").otherwise("reference")).drop("current")
    base = long.groupBy("column", "side").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    return base.join(ordering.quantiles(long, ["column", "side"], "value", {"median": 0.5}), ["column", "side"], "left")


def severity_from_test(score, test: str) -> Column:
    """Severity of a p-value (ks, chi2) or of a distance."""
    s = F.col(score) if isinstance(score, str) else score
    if "chi2" in test.lower() or "ks" in test.lower():
        return F.when(s < 0.01, F.lit("critical")).when(s < 0.05, F.lit("warning")).otherwise(F.lit("none"))
    return F.when(s > CRITICAL, F.lit("critical")).when(s > WARNING, F.lit("warning")).otherwise(F.lit("none"))


def test_statistics(current: DataFrame, reference: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """KS distance of each numeric column and chi-square of each other column, all columns at once."""
    numeric, other = split_columns(current, reference, only=columns)
    parts = []
    if numeric:
        long = _sides(agg.melt(current, numeric), agg.melt(reference, numeric))
        ks = stat_tests.ks_two_sample(long, "value", "current", ["column"])
        parts.append(ks.select("column", F.lit("ks").alias("test"), F.col("statistic"), F.lit(None).cast("bigint").alias("dof"), "n_first", "n_second"))
    if other:

        def melt(df):
            return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("part")) for c in other])))

        long = _sides(melt(current), melt(reference)).where("part is not null")
        chi = stat_tests.chi_square(long, "current", "part", ["column"])
        none = F.lit(None).cast("bigint")
        parts.append(chi.select("column", F.lit("chi2").alias("test"), "statistic", "dof", none.alias("n_first"), none.alias("n_second")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def with_p_values(stats: DataFrame) -> DataFrame:
    """Add p-value and severity to ``test_statistics`` (one small row per column)."""

    def p(rows):
        for pdf in rows:
            pdf["p_value"] = [
                stat_tests.ks_p(s, a, b) if t == "ks" else stat_tests.chi2_sf(s, d)
                for t, s, d, a, b in zip(pdf.test, pdf.statistic, pdf.dof, pdf.n_first, pdf.n_second)
            ]
            yield pdf

    out = stats.mapInPandas(p, T.StructType([*stats.schema.fields, T.StructField("p_value", T.DoubleType())]))
    return out.withColumn("severity", severity_from_test("p_value", "chi2"))


def dataset_drift(features: DataFrame, share: float = 0.5) -> DataFrame:
    """Roll per-column drift up: drifted count and share, dataset flag, largest score."""
    hit = F.col("severity") != "none"
    out = features.agg(
        F.count("*").alias("columns"), F.count_if(hit).alias("drifted"), F.max("psi").alias("max_score")
    ).withColumn("drift_share", numbers.ratio("drifted", "columns", 0.0))
    return out.withColumn("dataset_drift", F.col("drift_share") >= share)


def retrain_decision(
    summary: DataFrame, hours_since_last: float | None = None, limits: Mapping[str, float] | None = None
) -> DataFrame:
    """Whether to retrain, with the reasons; a recent trigger suppresses it."""
    lim = {"score": 0.25, "share": 0.30, "cooldown_hours": 24, **(limits or {})}
    cooling = F.lit(hours_since_last is not None and hours_since_last < lim["cooldown_hours"])
    reasons = F.array_compact(
        F.array(
            F.when(F.col("max_score") > lim["score"], F.lit("feature score")),
            F.when(F.col("drift_share") > lim["share"], F.lit("drift share")),
            F.when(F.col("dataset_drift"), F.lit("dataset drift")),
        )
    )
    return summary.select(
        "*",
        F.when(cooling, F.lit("cooldown")).otherwise(F.array_join(reasons, ", ")).alias("reasons"),
        (~cooling & (F.size(reasons) > 0)).alias("retrain"),
    )


def window_vs_baseline(df: DataFrame, ts: str, split: Column, columns_ignored: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(current, reference) parts of one table at a time split."""
    part = df.drop(*columns_ignored)
    return part.where(F.col(ts) >= split).drop(ts), part.where(F.col(ts) < split).drop(ts)
