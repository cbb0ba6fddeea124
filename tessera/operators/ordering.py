"""Exact ranks, cumulative counts and order statistics without a single-task sort.

Spark's exact ``percentile`` keeps every distinct value of a group in one task and a window without
``partitionBy`` sorts a whole table in one task. The functions here split the value axis into
buckets of about equal weight (boundaries come from one bounded quantile sketch), count per bucket,
prefix-sum the bucket counts and only then look inside a bucket. No task ever sees more than one
bucket of one group, however large a group is, and results are exact: the sketch only decides how
even the buckets are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joining import settle, sized

BUCKETS = 256  # at least; more where buckets would hold more than BUCKET_ROWS rows
BUCKET_ROWS = 2_000_000
MAX_BUCKETS = 65_536  # bounds both the sketch result on the driver and the prefix-sum rows per group


def boundaries(df: DataFrame, value: str, buckets: int = BUCKETS) -> list[float]:
    """Increasing cut points of about equal weight: ``buckets - 1`` at most, or as many as keep buckets at BUCKET_ROWS rows.

    The first read counts the rows beside its sketch; only tables too large for ``buckets`` are sketched again, finer.
    """

    def sketch(n: int, accuracy: int):
        probs = [i / n for i in range(1, n)]
        return df.agg(F.percentile_approx(value, probs, accuracy).alias("c"), F.count(value).alias("n")).first()

    found = sketch(buckets, 10_000)
    wanted = min(MAX_BUCKETS, -(-found.n // BUCKET_ROWS))
    if wanted > buckets:
        found = sketch(wanted, 8 * wanted)
    return sorted({c for c in found.c or [] if math.isfinite(c)})


def add_bucket(df: DataFrame, value: str, cuts: list[float], out: str = "_bucket") -> DataFrame:
    """Bucket number of a numeric column; a plain function of the value, so always repeatable."""
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    splits = [-float("inf"), *cuts, float("inf")]
    df = df.withColumn("_num", F.col(value).cast("double"))
    return Bucketizer(splits=splits, inputCol="_num", outputCol=out).transform(df).drop("_num")


def _positioned(df, keys, order, position):
    """Key, order value and numeric position of the rows that have all of them (NaN counts as
    missing)."""
    pos = F.col(order) if position is None else F.col(position) if isinstance(position, str) else position
    rows = df.where(pos.isNotNull() & ~F.isnan(pos.cast("double")))
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    return rows.withColumns({"_v": F.col(order), "_pos": pos.cast("double")})


def _offsets(bucketed, keys, names):
    """Per (group, bucket) of ``_in_<name>`` sums: weight before the bucket and in the group."""
    group = Window.partitionBy(*(keys or [F.lit(0)]))  # at most MAX_BUCKETS rows per group
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cols = []
    for n in names:
        cols.append(F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)).alias(f"_off_{n}"))
        cols.append(F.sum(f"_in_{n}").over(group).alias(f"total_{n}"))
    return bucketed.select("*", *cols)


def _inside(keys):
    return Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)


def cumulative(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    weights: dict[str, Column] | None = None,
    position: str | Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Distinct order values per group with, for each weight ``n``: ``n`` itself, ``before_n``
    (sum over strictly smaller values) and ``total_n``. Rows with a NULL key or value are left out.
    """
    keys = list(keys)
    weights = weights or {"n": F.lit(1)}
    names = list(weights)
    rows = _positioned(df, keys, order, position)
    values = rows.groupBy(*keys, "_v").agg(F.max("_pos").alias("_pos"), *[F.sum(w).alias(n) for n, w in weights.items()])
    values = add_bucket(values, "_pos", boundaries(rows, "_pos", buckets))
    per_bucket = values.groupBy(*keys, "_bucket").agg(*[F.sum(n).alias(f"_in_{n}") for n in names])
    offsets = _offsets(per_bucket, keys, names)
    # without keys the offsets are at most MAX_BUCKETS rows; with keys both sides share a partitioning
    out = values.join(offsets if keys else F.broadcast(offsets), [*keys, "_bucket"])
    return out.select(
        *keys,
        F.col("_v").alias(order),
        *names,
        *[(F.col(f"_off_{n}") + F.coalesce(F.sum(n).over(_inside(keys)), F.lit(0))).alias(f"before_{n}") for n in names],
        *[f"total_{n}" for n in names],
    )


def mid_ranks(counts: DataFrame, value: str, weight: str, buckets: int = BUCKETS) -> DataFrame:
    """Global mid-ranks of weighted values that may repeat over rows (for example one row per group
    and value): adds ``mid_rank`` and ``ties``, the weight that shares the value. The rows are
    shuffled once, by bucket."""
    rows = _positioned(counts, [], value, None)
    rows = add_bucket(rows, "_pos", boundaries(rows, "_pos", buckets))
    per_bucket = rows.groupBy("_bucket").agg(F.sum(weight).alias("_in_n"))
    offsets = F.broadcast(_offsets(per_bucket, [], ["n"]).drop("_in_n", "total_n"))  # at most MAX_BUCKETS rows
    upto = Window.partitionBy("_bucket").orderBy("_v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("_bucket", "_v")
    out = rows.join(offsets, "_bucket").withColumns({"_le": F.sum(weight).over(upto), "ties": F.sum(weight).over(same)})
    mid = F.col("_off_n") + F.col("_le") - F.col("ties") + (F.col("ties") + 1) / 2
    return out.withColumn("mid_rank", mid).drop("_bucket", "_v", "_pos", "_off_n", "_le")


def _at_positions(df, keys, order, position, want: Column, buckets):
    """Distinct values whose rank range holds one of the 0-based positions in ``want``, an array
    column over ``total_n``.

    All rows are only counted per bucket, which map tasks do before the shuffle. The few buckets
    that hold a wanted position are then opened: their rows alone are grouped and ranked.
    """
    keys = list(keys)
    rows = _positioned(df, keys, order, position)
    rows = add_bucket(rows, "_pos", boundaries(rows, "_pos", buckets))
    offsets = _offsets(rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_in_n")), keys, ["n"])
    return _opened(rows, offsets, keys, want)


def _opened(rows: DataFrame, offsets: DataFrame, keys: Sequence[str], want: Column) -> DataFrame:
    """The distinct values at the wanted positions; only the buckets that hold one are grouped and ranked."""
    hit = F.exists("_want", lambda i: (i >= F.col("_off_n")) & (i < F.col("_off_n") + F.col("_in_n")))
    needed = sized(offsets.withColumn("_want", want).where(hit).drop("_in_n"))
    on = [*keys, "_bucket"]
    opened = rows.join(needed.select(*on), on, "left_semi").groupBy(*on, "_v").agg(F.count("*").alias("n"))
    ranked = opened.join(needed, on).withColumn(
        "before", F.col("_off_n") + F.coalesce(F.sum("n").over(_inside(keys)), F.lit(0))
    )
    holds = F.exists("_want", lambda i: (i >= F.col("before")) & (i < F.col("before") + F.col("n")))
    return ranked.where(holds)


#: Groups up to this size are ranked by one window; larger ones are cut into buckets of about so many rows first.
GROUP_ROWS = 1_000_000
#: Most cut points of one group.
GROUP_CUTS = 255


def _large(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys and sizes of groups above GROUP_ROWS, kept in the checkpoint folder: at most one for so many rows. None if there are none."""
    found = settle(rows.groupBy(*keys).agg(F.count("*").alias("_size")).where(F.col("_size") > GROUP_ROWS))
    return found if found.limit(1).count() else None


def _group_buckets(rows: DataFrame, keys: Sequence[str], large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of large groups with a bucket by their own group's cut points, and the groups' offsets.

    A group of n rows gets ceil(n / GROUP_ROWS) buckets, from its own sketch, so the offsets are at most data / GROUP_ROWS and
    the groups, and however the groups' values differ, their buckets are even.
    """
    rows = rows.join(sized(large), list(keys))
    shares = [(i + 1) / (GROUP_CUTS + 1) for i in range(GROUP_CUTS)]
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_pos", shares, 10_000).alias("_all"), F.max("_size").alias("_size"))
    n = F.least(F.ceil(F.col("_size") / GROUP_ROWS), F.lit(GROUP_CUTS + 1)).cast("int")
    at = F.when(n > 1, F.sequence(F.lit(1), n - 1))
    cuts = F.transform(at, lambda i: F.get("_all", (i * (GROUP_CUTS + 1) / n - 1).cast("int")))
    cuts = sized(sketch.select(*keys, F.coalesce(cuts, F.array().cast("array<double>")).alias("_cuts")))
    rows = rows.drop("_size").join(cuts, list(keys))
    rows = rows.withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col("_pos"))).cast("double")).drop("_cuts")
    return rows, _offsets(rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_in_n")), keys, ["n"])


def _picked(at: Column, last: Column, probs: dict[str, float]) -> list[Column]:
    """For each probability the largest value of the rows at the positions below and above it; ``at(i)`` says which are."""
    aggs = []
    for name, p in probs.items():
        pos = F.lit(p) * last
        for side, i in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when(at(i), F.col("_v"))).cast("double").alias(f"_{side}_{name}"))
    return aggs


def _interpolated(picked: DataFrame, keep: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Linear interpolation between the picked values of rows with ``total_n``."""
    out = list(keep)
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("total_n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return picked.select(*out)


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], also: dict[str, Column] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, beside other aggregates of the group's rows.

    Groups' sizes come first. Groups of at most GROUP_ROWS rows take one exchange by key and one sort that spills; their
    aggregates come from the same rows. The few larger ones are counted in buckets of their own, of which only those that hold
    a wanted position are opened. Rows with a null key are a group, always by the window; null and NaN values have no
    position, and a group without others has null quantiles.
    """
    keys, also = list(keys), also or {}
    v = F.col(value)
    rows = df.withColumn("_v", F.when(~F.isnan(v.cast("double")), v))
    large = _large(rows, keys)
    small = rows if large is None else rows.join(sized(large.select(*keys)), keys, "left_anti")
    w = Window.partitionBy(*keys)
    placed = small.withColumns({"_rn": F.row_number().over(w.orderBy(F.col("_v").asc_nulls_last())) - 1, "total_n": F.count("_v").over(w)})
    named = [c.alias(n) for n, c in also.items()]
    picked = placed.groupBy(*keys).agg(*named, F.max("total_n").alias("total_n"), *_picked(lambda i: F.col("_rn") == i, F.col("total_n") - 1, probs))
    out = _interpolated(picked, [*keys, *also], probs)
    if large is None:
        return out
    own = rows.join(sized(large.select(*keys)), keys, "left_semi").groupBy(*keys).agg(*named, F.count("*").alias("_rows")).drop("_rows")
    bucketed, offsets = _group_buckets(rows.where("_v is not null").withColumn("_pos", F.col("_v").cast("double")), keys, large)
    return out.unionByName(own.join(_quantiles_at(_opened(bucketed, offsets, keys, _wanted(probs)), keys, probs), keys, "left"))


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group: one column per entry of ``probs``."""
    if keys:
        return group_quantiles(_positioned(df, keys, value, None), keys, value, probs)
    found = _at_positions(df, [], value, None, _wanted(probs), buckets)
    return _quantiles_at(found, [], probs)


def _wanted(probs: dict[str, float]) -> Column:
    last = F.col("total_n") - 1
    sides = [F.array(F.floor(F.lit(p) * last), F.ceil(F.lit(p) * last)).cast("array<bigint>") for p in probs.values()]
    return F.array_distinct(F.flatten(F.array(*sides)))


def _quantiles_at(found: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    def at(i):
        return (i >= F.col("before")) & (i < F.col("before") + F.col("n"))

    picked = found.groupBy(*keys).agg(F.max("total_n").alias("total_n"), *_picked(at, F.col("total_n") - 1, probs))
    return _interpolated(picked, list(keys), probs)


def order_statistic(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rank: Column,
    position: str | Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per group the order value at 1-based ``rank`` (an expression over ``total_n`` and the keys)
    as ``cutoff``, and ``before``, the rows strictly below it. Groups whose rank is outside
    1..total_n give no row."""
    keys = list(keys)
    want = F.array((rank - 1).cast("bigint"))
    found = _at_positions(df, keys, order, position, want, buckets)
    return found.select(*keys, F.col("_v").alias("cutoff"), "before", "n", "total_n")


def hash_order(key: str) -> tuple[Column, Column]:
    """A repeatable pseudo-random order of an integer key: (unique order value, its position).

    The multiplicative hash stays inside 64 bits; the key breaks ties, so the order is total.
    """
    h = F.pmod(F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761), F.lit(4294967296))
    return F.struct(h.alias("h"), F.col(key).cast("bigint").alias("k")), h


def numbered(df: DataFrame, order: str, out: str) -> DataFrame:
    """Dense numbers from 0 in the order of a column, NULLs last, ties in the order of a row hash; every row gets its own.

    Rows are range-partitioned by (column, hash), so a value that a third of them share is spread; each partition numbers its
    own rows and the partitions' sizes, one row each, are summed up.
    """
    names = df.columns
    keys = [F.col(order).isNull(), F.col(order), F.xxhash64(*[F.col(c) for c in names])]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = settle(rows)
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.withColumn("_part", part).join(starts, "_part").select(*names, (F.col("_start") + place).alias(out))
