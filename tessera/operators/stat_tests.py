"""Rank and contingency tests as distributed aggregates. Only one number per test (or per column)
reaches Python, for its p-value."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import ordering
from tessera.operators.joining import sized


def chi2_sf(x: float, dof: float) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma)."""
    if x is None or dof is None or not x > 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    scale = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= z / n
            total += term
        return max(0.0, 1.0 - total * scale)
    b, c = z + 1 - a, 1e300
    d = h = 1.0 / b
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return scale * h


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def ks_p(d: float, n: int, m: int) -> float:
    """Asymptotic two-sample Kolmogorov–Smirnov p-value."""
    if not n or not m or d is None:
        return 1.0
    t = d * math.sqrt(n * m / (n + m))
    if t < 1e-8:
        return 1.0
    s = sum((-1) ** (k - 1) * math.exp(-2 * (k * t) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * s))


def _rank_sums(df: DataFrame, group: str, value: str, min_n: int) -> DataFrame:
    """Per group: size, mid-rank sum and share of the tie term. Works on (group, value) counts."""
    gv = (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group, F.col(value).cast("double").alias("_x"))
        .agg(F.count("*").alias("_c"))
    )
    if min_n > 1:
        big = gv.groupBy(group).agg(F.sum("_c").alias("_t")).where(F.col("_t") >= min_n).select(group)
        gv = gv.join(sized(big), group, "left_semi")
    c, t = F.col("_c").cast("double"), F.col("ties").cast("double")
    return ordering.mid_ranks(gv, "_x", "_c").groupBy(group).agg(
        F.sum("_c").alias("n"), F.sum(c * F.col("mid_rank")).alias("rank_sum"), F.sum(c * (t * t - 1)).alias("tie_term")
    )


def kruskal(df: DataFrame, group: str, value: str, min_n: int = 1) -> DataFrame:
    """Tie-corrected Kruskal–Wallis H over groups with at least ``min_n`` rows."""
    out = _rank_sums(df, group, value, min_n).agg(
        F.count("*").alias("groups"), F.sum("n").alias("rows"), F.sum("tie_term").alias("_tie"),
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("_s"),
    )
    n = F.col("rows").cast("double")
    h = F.lit(12.0) / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)
    correction = 1 - F.col("_tie") / (n * n * n - n)
    return out.select("groups", "rows", numbers.ratio(h, correction).alias("statistic"), (F.col("groups") - 1).alias("dof"))


def mann_whitney(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """U of the first group against the second, with its tie-corrected normal score."""
    two = df.where(F.col(group).isin(first, second))
    sums = _rank_sums(two, group, value, 1)
    is_first = F.col(group) == F.lit(first)
    out = sums.agg(
        F.sum(F.when(is_first, F.col("n"))).alias("n_first"),
        F.sum(F.when(~is_first, F.col("n"))).alias("n_second"),
        F.sum(F.when(is_first, F.col("rank_sum"))).alias("_r"),
        F.sum("tie_term").alias("_tie"),
    )
    a, b = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    u = F.col("_r") - a * (a + 1) / 2
    n = a + b
    sigma = F.sqrt(a * b / 12 * ((n + 1) - F.col("_tie") / (n * (n - 1))))
    z = (F.greatest(u, a * b - u) - a * b / 2 - 0.5) / sigma
    return out.select("n_first", "n_second", u.alias("statistic"), z.alias("z"))


def ks_two_sample(df: DataFrame, value: str, is_first: str, keys: Sequence[str] = ()) -> DataFrame:
    """Two-sample KS distance per key, ``is_first`` being a boolean column."""
    rows = df.where(F.col(value).isNotNull())
    dist = ordering.cumulative(
        rows, keys, value, {"a": F.col(is_first).cast("bigint"), "b": (~F.col(is_first)).cast("bigint")}
    )
    fa = numbers.ratio(F.col("before_a") + F.col("a"), "total_a", 0.0)
    fb = numbers.ratio(F.col("before_b") + F.col("b"), "total_b", 0.0)
    return dist.groupBy(*keys).agg(
        F.max(F.abs(fa - fb)).alias("statistic"), F.max("total_a").alias("n_first"), F.max("total_b").alias("n_second")
    )


def chi_square(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Chi-square independence per key; with one degree of freedom Yates' correction applies.

    Uses sum(o²/e) - N, so empty cells need no rows and the table is never crossed out in full.
    """
    keys = list(keys)
    o = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*keys, a, b).agg(F.count("*").alias("_o"))
    ra = o.groupBy(*keys, a).agg(F.sum("_o").alias("_ra"))
    rb = o.groupBy(*keys, b).agg(F.sum("_o").alias("_rb"))

    def margin(m, name):
        return m.groupBy(*keys).agg(F.count("*").alias(f"_k{name}"), F.sum(1 / F.col(f"_r{name}")).alias(f"_i{name}"), F.sum(f"_r{name}").alias(f"_n{name}"))

    cells = o.join(ra, [*keys, a]).join(rb, [*keys, b])
    e = F.col("_ra") * F.col("_rb")
    if keys:
        both = margin(ra, "a").join(margin(rb, "b"), keys)
        base = cells.join(both, keys)
    else:
        ma, mb = margin(ra, "a"), margin(rb, "b")
        base = cells.withColumns(
            {c: ma.select(c).scalar() for c in ("_ka", "_ia", "_na")} | {c: mb.select(c).scalar() for c in ("_kb", "_ib")}
        )
    n = F.col("_na").cast("double")
    out = base.groupBy(*keys).agg(
        F.max("_na").alias("_na"), F.max("_ka").alias("_ka"), F.max("_kb").alias("_kb"), F.max("_ia").alias("_ia"), F.max("_ib").alias("_ib"),
        F.sum(F.col("_o").cast("double") * F.col("_o") / e).alias("_s"),
        F.max(F.abs(F.col("_o") - e / n)).alias("_d"),
    )
    dof = (F.col("_ka") - 1) * (F.col("_kb") - 1)
    gap = F.greatest(F.col("_d") - 0.5, F.lit(0.0))
    yates = gap * gap * n * F.col("_ia") * F.col("_ib")
    stat = F.when(dof == 1, yates).otherwise(n * F.col("_s") - n)
    return out.select(*keys, stat.alias("statistic"), dof.alias("dof"), F.col("_na").alias("n"))


def levene(df: DataFrame, group: str, value: str) -> DataFrame:
    """Median-centred Levene statistic across groups."""
    rows = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_x"))
    med = ordering.quantiles(rows, [group], "_x", {"_m": 0.5})
    z = F.abs(F.col("_x") - F.col("_m"))
    g = rows.join(sized(med), group).groupBy(group).agg(
        F.count("*").alias("n"), F.sum(z).alias("s"), F.sum(z * z).alias("ss")
    )
    out = g.agg(
        F.count("*").alias("groups"), F.sum("n").alias("rows"), F.sum("s").alias("_s"),
        F.sum("ss").alias("_ss"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("_b"),
    )
    k, n = F.col("groups"), F.col("rows")
    between = F.col("_b") - F.col("_s") * F.col("_s") / n
    within = F.col("_ss") - F.col("_b")
    return out.select("groups", "rows", numbers.ratio((n - k) * between, (k - 1) * within).alias("statistic"))


def p_value(result: DataFrame, kind: str) -> float:
    """p-value of a one-row test result: "chi2" (also Kruskal–Wallis), "ks" or "mw"."""
    r = result.first()
    if kind == "ks":
        return ks_p(r.statistic, r.n_first, r.n_second)
    return normal_two_sided(r.z) if kind == "mw" else chi2_sf(r.statistic, r.dof)


