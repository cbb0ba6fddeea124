"""Repeatable samples, splits and resampling. "Random" means the order of a key hash, so every run
and every recomputed task agrees. Ranks are never materialised for all rows: a cutoff per group is
found with an order statistic and rows are compared with it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joining import attach, settle
from tessera.operators.ordering import hash_order, order_statistic

COPY_CHUNK = 1000  # copies of one row that a single expansion makes


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows in hash order; a bounded top-n, each task keeps at most ``n``."""
    order, _ = hash_order(key)
    return df.orderBy(order).limit(n)


def newest(df: DataFrame, ts: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def hash_split(df: DataFrame, key: str, percent: int = 80, out: str = "split") -> DataFrame:
    """Train / validation by key hash: no shuffle at all."""
    h = F.pmod(F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761), F.lit(4294967296))
    return df.withColumn(out, F.when(F.pmod(h, F.lit(100)) < percent, "train").otherwise("validation"))


def _ranked_split(df, keys, order: Column, position: Column, fractions: Mapping[str, float], out: str) -> DataFrame:
    """Cut each group at floor(cumulative fraction · size) in the given order."""
    work = df.withColumn("_ord", order)
    names, cuts, total = list(fractions), [], 0.0
    for name in names[:-1]:
        total += fractions[name]
        rank = F.floor(F.lit(round(total, 9)) * F.col("total_n"))
        cut = order_statistic(work, keys, "_ord", rank, position).select(*keys, F.col("cutoff").alias(f"_cut{len(cuts)}"))
        cuts.append(cut)
    label = F.lit(names[-1])
    for i in reversed(range(len(cuts))):
        label = F.when(F.col("_ord") <= F.col(f"_cut{i}"), F.lit(names[i])).otherwise(label)
    for i, cut in enumerate(cuts):
        work = attach(work, cut, keys) if keys else work.withColumn(f"_cut{i}", settle(cut).scalar())
    return work.withColumn(out, label).drop("_ord", *[f"_cut{i}" for i in range(len(cuts))])


def stratified_split(df, stratum: str, key: str, fractions: Mapping[str, float], out="split") -> DataFrame:
    order, position = hash_order(key)
    return _ranked_split(df, [stratum], order, position, fractions, out)


def time_split(df: DataFrame, ts: str, key: str, fractions: Mapping[str, float], out: str = "split") -> DataFrame:
    """Split by position in (time, key) order. Each cut is found in two steps, first the timestamp
    and then the key among the rows that share it, so even one timestamp holding a third of the
    table is cut in pieces."""
    n = df.count()
    names, cuts, total = list(fractions), [], 0.0
    for name in names[:-1]:
        total += fractions[name]
        k = int(round(total, 9) * n)
        at = order_statistic(df, [], ts, F.lit(k), F.col(ts).cast("timestamp").cast("double")).first() if k else None
        if at is None:
            cuts.append(F.lit(False))
            continue
        same = df.where(F.col(ts) == F.lit(at.cutoff))
        edge = order_statistic(same, [], key, F.lit(k - at.before), F.col(key).cast("double")).first()
        t = F.col(ts)
        cuts.append((t < F.lit(at.cutoff)) | ((t == F.lit(at.cutoff)) & (F.col(key) <= edge.cutoff)))
    label = F.lit(names[-1])
    for name, cond in reversed(list(zip(names, cuts))):
        label = F.when(cond, F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


def resample(df: DataFrame, group: str, key: str, target: Column) -> DataFrame:
    """Bring each group to ``target`` rows (an expression over the group size ``_n``).

    Row copies are floor(target / size), plus one for the first target mod size rows in hash order:
    smaller groups repeat rows evenly, larger groups keep a hash sample, equal ones are unchanged.
    """
    order, position = hash_order(key)
    rows = df.where(F.col(group).isNotNull()).withColumn("_ord", order)
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).withColumn("_t", target.cast("bigint"))
    plan = sizes.select(
        group, F.floor(F.col("_t") / F.col("_n")).alias("_copies"), F.pmod("_t", "_n").alias("_extra")
    )
    plan = settle(plan)
    # The wanted rank differs per group, so it travels with the rows as a group constant.
    extra = attach(rows.select(group, "_ord"), plan.select(group, "_extra"), [group]).where("_extra > 0")
    cut = order_statistic(extra, [group, "_extra"], "_ord", F.col("_extra"), position=F.col("_ord.h"))
    plan = plan.join(cut.select(group, F.col("cutoff").alias("_cut")), group, "left")
    more = F.coalesce((F.col("_ord") <= F.col("_cut")).cast("int"), F.lit(0))
    out = attach(rows, plan, [group]).withColumn("copy", F.col("_copies") + more).where("copy > 0")
    most = plan.agg(F.max("_copies")).first()[0] or 0
    if most > COPY_CHUNK:
        # a small group far below its target: spread blocks of copies over tasks, then expand them
        block = F.sequence(F.lit(0), F.floor((F.col("copy") - 1) / COPY_CHUNK))
        out = out.withColumn("_block", F.explode(block)).repartition(F.xxhash64("_ord", "_block"))
        first = F.col("_block") * COPY_CHUNK + 1
        copies = F.sequence(first, F.least(F.col("copy"), first + COPY_CHUNK - 1))
        out = out.withColumn("copy", F.explode(copies)).withColumn("copy", F.col("copy").cast("int")).drop("_block")
    else:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copy").cast("int"))))
    return out.drop("_ord", "_copies", "_extra", "_cut")


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("_n"))


def union_samples(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

