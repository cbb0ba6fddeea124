"""Column profiles that can be merged: one small state per day and column, from which any range of days is profiled.

A state holds counts, moments and extremes, a KLL sketch of the values of numeric columns, a HyperLogLog sketch of the distinct
values and a sketch of the frequent values of text columns, all as plain or binary columns of a table. Merging adds them up
without reading the rows again. Counts, moments and extremes are exact; quantiles are within ``RANK_ERROR`` of their rank,
distinct counts within a few per cent. ``profile.profile`` is the exact form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import profile
from tessera.sources.layers import LayerStore

#: KLL size; a quantile's rank is off by less than RANK_ERROR of the rows in 99 of 100 cases, by a third of it typically.
KLL, RANK_ERROR = 400, 0.01
#: Base-2 logarithm of the HyperLogLog registers: a standard error of 1.6 per cent.
HLL = 12
#: Values tracked for each text column and day; counts are exact while there are at most three quarters as many values.
TRACKED = 1000


def states(df: DataFrame, day: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(dt, column, ...): the state of each column for each day, from one aggregate. Rows without a day are left out.

    NaN counts as missing. A column is numeric or counts as text; a day on which it has no values has empty sketches.
    """
    columns = list(columns or df.columns)
    numeric = set(profile.numeric_columns(df))
    rows = df.withColumn("_dt", day.cast("date")).where("_dt is not null")
    aggs, items = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        v, num = F.col(f"`{c}`"), c in numeric
        if num:
            v = F.when(~F.isnan(v.cast("double")), v.cast("double"))
            aggs += [F.avg(v).alias(f"_mean{i}"), (F.var_pop(v) * F.count(v)).alias(f"_m2{i}"), F.min(v).alias(f"_min{i}"), F.max(v).alias(f"_max{i}")]
            aggs += [F.count_if(v == 0).alias(f"_zeros{i}"), F.kll_sketch_agg_double(v, F.lit(KLL)).alias(f"_kll{i}")]
        else:
            v = v.cast("string")
            aggs.append(F.expr(f"approx_top_k_accumulate(cast(`{c}` as string), {TRACKED})").alias(f"_top{i}"))
        aggs += [F.count(v).alias(f"_n{i}"), F.hll_sketch_agg(v.cast("string"), F.lit(HLL)).alias(f"_hll{i}")]

        def own(name: str, kind: str, here: bool, i=i) -> Column:
            return (F.col(f"_{name}{i}") if here else F.lit(None).cast(kind)).alias(name)

        items.append(F.struct(
            F.lit(c).alias("column"), F.lit(num).alias("numeric"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("present"),
            own("zeros", "bigint", num), *[own(m, "double", num) for m in ("mean", "m2", "min", "max")],
            own("kll", "binary", num), own("hll", "binary", True)))
    wide = rows.groupBy(F.col("_dt").alias("dt")).agg(*aggs)
    texts = [F.struct(F.lit(c).alias("_c"), F.col(f"_top{i}").alias("top")) for i, c in enumerate(columns) if c not in numeric]
    long = wide.select("dt", F.inline(F.array(*items)), *[F.array(*texts).alias("_tops")] if texts else [])
    if not texts:
        return long.withColumn("top", F.lit(None))
    return long.withColumn("top", F.expr("get(filter(_tops, x -> x._c = column), 0).top")).drop("_tops")


def merged(states_: DataFrame) -> DataFrame:
    """One state per column over all given days."""
    # few values per column: a day's moments are combined pairwise, which keeps means of large values exact
    moments = F.collect_list(F.when(F.col("present") > 0, F.struct(F.col("present").alias("n"), "mean", "m2")))
    out = states_.groupBy("column").agg(
        F.max("numeric").alias("numeric"), F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.sum("zeros").alias("zeros"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.array_sort(moments).alias("_m"),
        F.kll_merge_agg_double("kll").alias("kll"), F.hll_union_agg("hll").alias("hll"))
    step = """aggregate(_m, named_struct('n', 0L, 'mean', 0D, 'm2', 0D), (a, x) -> named_struct('n', a.n + x.n,
        'mean', a.mean + (x.mean - a.mean) * x.n / (a.n + x.n), 'm2', a.m2 + x.m2 + (x.mean - a.mean) * (x.mean - a.mean) * a.n * x.n / (a.n + x.n)))"""
    return out.withColumn("_m", F.expr(f"case when numeric then {step} end"))


def profiled(states_: DataFrame) -> DataFrame:
    """The profile of all given days, with the columns of ``profile.profile``; distinct counts and quartiles are estimates."""
    m = merged(states_)
    some = F.col("numeric") & (F.col("present") > 0)
    q = F.when(some, F.kll_sketch_get_quantile_double("kll", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    missing = F.col("rows") - F.col("present")
    return m.select(
        "column", "rows", "present", missing.alias("missing"), numbers.ratio(missing, "rows", 0.0).alias("missing_ratio"),
        F.when(some, F.col("_m.mean")).alias("mean"), F.when(some & (F.col("present") > 1), F.sqrt(F.col("_m.m2") / (F.col("present") - 1))).alias("std"),
        "min", "max", "zeros", F.hll_sketch_estimate("hll").alias("distinct"),
        q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"))


def frequent(states_: DataFrame, n: int = 10) -> DataFrame:
    """(column, value, n): the most frequent values of text columns over all given days, by their estimated counts."""
    tops = states_.where("not numeric").groupBy("column").agg(F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("_top"))
    found = tops.select("column", F.inline(F.expr(f"approx_top_k_estimate(_top, {n})")))
    return found.select("column", F.col("item").alias("value"), F.col("count").alias("n"))


class ProfileStore:
    """Profile states of a dataset by date, in the layer store."""

    def __init__(self, store: LayerStore, layer: str = "profile_states"):
        self.store, self.layer = store, layer

    def save(self, df: DataFrame, dataset: str, day: Column, columns: Sequence[str] | None = None) -> None:
        """Profile the days of a frame; days that are stored already are replaced."""
        self.store.write(states(df, day, columns), dataset, self.layer)

    def dates(self, dataset: str) -> list[str]:
        return self.store.stored_dates(dataset, self.layer)

    def between(self, dataset: str, after: str, before: str) -> DataFrame:
        """States of a closed range of dates; only their partitions are read."""
        dt = F.col("dt")
        return self.store.scan(dataset, self.layer).where(dt.between(F.lit(after).cast("date"), F.lit(before).cast("date")))

    def load(self, dataset: str, date: str | None = None) -> DataFrame:
        """The profile of one date, or of the newest one."""
        date = date or max(self.dates(dataset))
        return profiled(self.between(dataset, date, date))

    def over(self, dataset: str, after: str, before: str) -> DataFrame:
        return profiled(self.between(dataset, after, before))
