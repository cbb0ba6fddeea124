"""Column profiles: every column from one wide aggregate and one value-count shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import numbers
from tessera.operators import aggregates as agg
from tessera.operators import ordering
from tessera.operators.joining import settle

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def time_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]


def moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, present and missing counts and, where numeric, mean, std, min, max and
    zeros. One aggregate row over all columns, unpivoted."""
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        v = F.col(c)
        if c in numeric:
            v = F.when(~F.isnan(v.cast("double")), v.cast("double"))
            aggs += [
                F.avg(v).alias(f"_mean{i}"), F.stddev_samp(v).alias(f"_std{i}"), F.min(v).alias(f"_min{i}"),
                F.max(v).alias(f"_max{i}"), F.count_if(v == 0).alias(f"_zeros{i}"),
            ]
        aggs.append(F.count(v).alias(f"_n{i}"))
    nothing = F.lit(None).cast("double")

    def item(i, c):
        num = c in numeric
        return F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("present"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("missing"),
            numbers.ratio(F.col("_rows") - F.col(f"_n{i}"), "_rows", 0.0).alias("missing_ratio"),
            *[(F.col(f"_{m}{i}") if num else nothing).alias(m) for m in ("mean", "std", "min", "max")],
            (F.col(f"_zeros{i}") if num else F.lit(None).cast("bigint")).alias("zeros"),
        )

    return df.agg(*aggs).select(F.inline(F.array(*[item(i, c) for i, c in enumerate(columns)])))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value as text, n) for every non-NULL value of every column, in one shuffle."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns or df.columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


#: Characters by which longer values are grouped, together with their fingerprint.
HEAD = 32
SEEDS = (1, 2, 3)


def fingerprint(columns: Sequence[str | Column], seed: int) -> Column:
    """A 64-bit hash of some columns in which a null is a value of its own."""
    values = [F.col(f"`{c}`") if isinstance(c, str) else c for c in columns]
    return F.xxhash64(F.lit(seed), *[F.isnull(v) for v in values], *values)


def keyed_counts(df: DataFrame, columns: Sequence[str] | None = None, hashed=fingerprint) -> DataFrame:
    """(column, head, f1, f2, n): occurrences of each value of each column, of long values by their first characters and two
    hashes, so that no long text is shuffled. A third hash tells whether a group is one value; groups that are not are counted
    by their whole values, without ``f2`` and with the value as head."""
    value = F.col("value")
    long = F.length(value) > HEAD
    keys = [F.left(value, F.lit(HEAD)).alias("head"), *[F.when(long, hashed([value], s)).alias(f"f{s}") for s in SEEDS]]
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns or df.columns]
    values = df.select(F.inline(F.array(*pairs))).where("value is not null")
    found = values.select("column", *keys).groupBy("column", "head", "f1", "f2")
    found = settle(found.agg(F.count("*").alias("n"), (F.min("f3") != F.max("f3")).alias("_mixed")))
    one = found.where("_mixed is not true").drop("_mixed")
    mixed = found.where("_mixed").select("column", "head", "f1", "f2")
    if not mixed.limit(1).count():
        return one
    own = values.select("column", "value", *keys).join(mixed, ["column", "head", "f1", "f2"], "left_semi")
    whole = own.groupBy("column", "value").agg(F.count("*").alias("n"))
    return one.unionByName(whole.select("column", F.col("value").alias("head"), F.lit(0).cast("bigint").alias("f1"), F.lit(None).cast("bigint").alias("f2"), "n"))


def distinct_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(F.count("*").alias("distinct"), F.count_if(F.col("n") == 1).alias("singletons"))


def top_values(df: DataFrame, n: int = 10, columns: Sequence[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """(column, value, n, rank) of each column's most frequent values, smaller ones first where counts tie.

    Ranks go by count and first characters; the whole text of long values is fetched for those that may be reported only.
    """
    counts = keyed_counts(df, columns) if counts is None else counts
    # values with the same head tie until their texts are known; rank() keeps all that tie at the end
    near = Window.partitionBy("column").orderBy(F.desc("n"), F.left("head", F.lit(HEAD)))
    near = counts.withColumn("_rank", F.rank().over(near)).where(F.col("_rank") <= n).drop("_rank")
    short = near.where("f2 is null").select("column", F.col("head").alias("value"), "n")
    long = settle(near.where("f2 is not null"))
    if long.limit(1).count():
        wanted = [r[0] for r in long.select("column").distinct().collect()]  # names of columns
        pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in wanted]
        value = F.col("value")
        values = df.select(F.inline(F.array(*pairs))).where(F.length("value") > HEAD)
        keyed = values.select("column", "value", F.left(value, F.lit(HEAD)).alias("head"), fingerprint([value], 1).alias("f1"), fingerprint([value], 2).alias("f2"))
        found = keyed.join(long, ["column", "head", "f1", "f2"]).groupBy("column", "head", "f1", "f2").agg(F.min("value").alias("value"), F.max("n").alias("n"))
        short = short.unionByName(found.select("column", "value", "n"))
    return agg.top_per_group(short, ["column"], [F.desc("n"), F.col("value")], n)


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The full column profile: moments, exact quartiles and distinct counts."""
    columns = list(columns or df.columns)
    numeric = [c for c in columns if c in set(numeric_columns(df))]
    out = moments(df, columns).join(distinct_counts(keyed_counts(df, columns)).drop("singletons"), "column", "left")
    out = out.withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    if not numeric:
        return out.withColumns({q: F.lit(None).cast("double") for q in ("q1", "median", "q3")})
    q = ordering.quantiles(agg.melt(df, numeric), ["column"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return out.join(q, "column", "left")


def compare(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Column-wise differences of two profiles, with presence flags."""
    c, r = current.alias("c"), reference.alias("r")
    both = c.join(r, F.col("c.column") == F.col("r.column"), "full")

    def change(m):
        return (F.col(f"c.{m}") - F.col(f"r.{m}")).alias(f"{m}_change")

    return both.select(
        F.coalesce("c.column", "r.column").alias("column"),
        F.col("c.column").isNotNull().alias("in_current"),
        F.col("r.column").isNotNull().alias("in_reference"),
        change("rows"),
        numbers.ratio((F.col("c.rows") - F.col("r.rows")) * 100, F.col("r.rows")).alias("rows_change_pct"),
        *[change(m) for m in ("missing_ratio", "mean", "std", "distinct")],
    )


def psi_from_profiles(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Rough drift score from two profiles alone: scaled mean shift, or change of distinct count."""
    c, r = current.alias("c"), reference.alias("r")
    both = c.join(r, F.col("c.column") == F.col("r.column"))
    shift = F.abs(F.col("c.mean") - F.col("r.mean")) / F.col("r.std") * 0.1
    uniq = F.abs(F.col("c.distinct") - F.col("r.distinct")) / F.greatest(F.col("r.distinct"), F.lit(1))
    has_mean = F.col("c.mean").isNotNull() & F.col("r.mean").isNotNull()
    psi = (
        F.when(has_mean & (F.col("r.std") > 0), F.least(shift, F.lit(1.0)))
        .when(has_mean, F.lit(0.0))
        .when((F.col("c.distinct") > 0) & (F.col("r.distinct") > 0), F.least(uniq, F.lit(1.0)))
        .otherwise(F.lit(0.0))
    )
    return both.select(F.col("c.column").alias("column"), psi.alias("psi"))


def null_overview(df: DataFrame) -> DataFrame:
    out = moments(df).select("column", "missing", (F.col("missing_ratio") * 100).alias("missing_pct"))
    return out.orderBy(F.desc("missing_pct"), "column")


def feature_ranges(df: DataFrame, definitions: Sequence[tuple[str, float | None, float | None]]) -> DataFrame:
    """Check feature definitions (name, min, max): NULLs and values outside the allowed range."""
    m = moments(df, [d[0] for d in definitions])
    rules = F.lit(None).cast("double")
    lo, hi = rules, rules
    for name, a, b in definitions:
        here = F.col("column") == name
        lo = lo if a is None else F.when(here, F.lit(float(a))).otherwise(lo)
        hi = hi if b is None else F.when(here, F.lit(float(b))).otherwise(hi)
    return m.select(
        "column", "missing", "min", "max",
        F.coalesce(F.col("min") < lo, F.lit(False)).alias("below_min"),
        F.coalesce(F.col("max") > hi, F.lit(False)).alias("above_max"),
    )


def group_sizes(df: DataFrame, keys: Sequence[str] | None = None, hashed=fingerprint) -> DataFrame:
    """(n): the size of each group of equal rows, or rows with an equal key, grouped by two 64-bit hashes.

    Rows are never shuffled, only hashes are. A third hash tells whether a group's rows are equal; groups whose rows are not
    are told apart by their values.
    """
    keys = list(keys or df.columns)
    hashes = df.select(*[hashed(keys, s).alias(f"f{s}") for s in SEEDS])
    found = settle(hashes.groupBy("f1", "f2").agg(F.count("*").alias("n"), (F.min("f3") != F.max("f3")).alias("_mixed")))
    one = found.where(~F.col("_mixed")).select("n")
    mixed = found.where("_mixed").select("f1", "f2")
    if not mixed.limit(1).count():
        return one
    marked = df.select(*[F.col(f"`{k}`") for k in keys], hashed(keys, 1).alias("f1"), hashed(keys, 2).alias("f2"))
    return one.unionByName(marked.join(mixed, ["f1", "f2"], "left_semi").groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("n")).select("n"))


def duplicates(df: DataFrame, keys: Sequence[str] | None = None, hashed=fingerprint) -> DataFrame:
    """Rows beyond the first of each distinct row (or key), their count and share."""
    groups = group_sizes(df, keys, hashed)
    out = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("_d"))
    dup = F.col("rows") - F.col("_d")
    return out.select("rows", dup.alias("duplicates"), numbers.ratio(dup, "rows", 0.0).alias("duplicate_ratio"))


def training_baseline(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    p = profile(df, columns)
    return p.select(
        "column", "mean", "std", "min", F.col("q1").alias("p25"), F.col("median").alias("p50"),
        F.col("q3").alias("p75"), "max", (F.col("missing_ratio") * 100).alias("null_pct"),
    )


def categorical_baseline(df: DataFrame, columns: Sequence[str], top: int = 20) -> DataFrame:
    """Per text column the ``top`` most frequent values with their share of the present ones, and the number of distinct values."""
    counts = keyed_counts(df, columns)
    sizes = counts.groupBy("column").agg(F.sum("n").alias("_present"), F.count("*").alias("n_unique"))
    kept = top_values(df, top, columns, counts).join(sizes, "column")
    return kept.select("column", "value", "n", numbers.ratio("n", "_present", 0.0).alias("share"), "n_unique")
