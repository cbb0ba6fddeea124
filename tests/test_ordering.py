"""Exact ranks and quantiles against pandas, including hot values and edge cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators import ordering, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            # one group and one value hold more than a third of all rows
            "g": np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abc"), n)),
            "x": np.where(rng.random(n) < 0.4, 7.0, np.round(rng.lognormal(2, 2, n), 3)),
        }
    )
    return pdf, spark.createDataFrame(pdf)


def test_quantiles_match_pandas(skewed):
    pdf, df = skewed
    got = ordering.quantiles(df, ["g"], "x", {"a": 0.0, "q1": 0.25, "m": 0.5, "p95": 0.95, "z": 1.0}, buckets=16).toPandas()
    for r in got.itertuples():
        want = pdf[pdf.g == r.g].x.quantile([0.0, 0.25, 0.5, 0.95, 1.0]).to_numpy()
        np.testing.assert_allclose([r.a, r.q1, r.m, r.p95, r.z], want, rtol=1e-12)
    assert len(got) == pdf.g.nunique()


def test_quantiles_edge_cases(spark):
    df = spark.createDataFrame([("one", 5.0), ("null", None), ("const", 2.0), ("const", 2.0)], "g string, x double")
    got = {r.g: r.m for r in ordering.quantiles(df, ["g"], "x", {"m": 0.5}).collect()}
    assert got == {"one": 5.0, "const": 2.0}
    assert ordering.quantiles(df.where("false"), ["g"], "x", {"m": 0.5}).count() == 0
    # a global quantile of nothing is one NULL, as in SQL
    assert [r.m for r in ordering.quantiles(df.where("g = 'null'"), [], "x", {"m": 0.5}).collect()] == [None]


def test_cumulative_counts(skewed):
    pdf, df = skewed
    got = ordering.cumulative(df, [], "x", buckets=8).toPandas().sort_values("x")
    counts = pdf.x.value_counts().sort_index()
    assert got.n.tolist() == counts.tolist()
    assert got.before_n.tolist() == (counts.cumsum() - counts).tolist()
    assert set(got.total_n) == {len(pdf)}


def test_no_unpartitioned_sort_of_raw_rows(skewed):
    _, df = skewed
    plan = ordering.cumulative(df, ["g"], "x")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_order_statistic(skewed):
    pdf, df = skewed
    got = ordering.order_statistic(df, ["g"], "x", F.lit(10)).toPandas()
    for r in got.itertuples():
        assert r.cutoff == sorted(pdf[pdf.g == r.g].x)[9]


def test_time_split_with_one_hot_timestamp(spark):
    rows = [(i, "2024-01-02" if i % 3 else f"2024-01-0{1 + i % 5}") for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, d string").select("id", F.col("d").cast("timestamp_ntz").alias("ts"))
    got = sampling.time_split(df, "ts", "id", {"a": 0.7, "b": 0.15, "c": 0.15}).toPandas()
    assert got.split.value_counts().to_dict() == {"a": 210, "b": 45, "c": 45}
    ordered = got.sort_values(["ts", "id"]).split.tolist()
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("target,expect", [("100", 100), ("2000", 2000), ("_n", None)])
def test_resample_reaches_target(skewed, target, expect):
    pdf, df = skewed
    got = sampling.resample(df, "g", "id", F.expr(target)).groupBy("g").count().toPandas().set_index("g")["count"]
    for g, n in pdf.g.value_counts().items():
        assert got[g] == (n if expect is None else expect)


def test_resample_is_repeatable_and_keeps_rows(skewed):
    pdf, df = skewed
    big = sampling.resample(df, "g", "id", F.lit(2000)).toPandas()
    assert set(big.id) == set(pdf.id)
    a = sampling.resample(df, "g", "id", F.lit(100)).toPandas().id.sort_values().tolist()
    b = sampling.resample(df.repartition(7), "g", "id", F.lit(100)).toPandas().id.sort_values().tolist()
    assert a == b


def test_stratified_split_sizes(skewed):
    pdf, df = skewed
    got = sampling.stratified_split(df, "g", "id", {"train": 0.8, "test": 0.2}).groupBy("g", "split").count().collect()
    sizes = {(r.g, r.split): r["count"] for r in got}
    for g, n in pdf.g.value_counts().items():
        assert sizes[(g, "train")] == int(0.8 * n)


def test_resample_of_a_tiny_group(spark):
    df = spark.createDataFrame([(1, "tiny"), (2, "tiny"), (3, "other")], "id long, g string")
    got = sampling.resample(df, "g", "id", F.lit(5001)).groupBy("g", "id").agg(F.count("*").alias("n"), F.count_distinct("copy").alias("d")).collect()
    assert sorted((r.g, r.n) for r in got) == [("other", 5001), ("tiny", 2500), ("tiny", 2501)]
    assert all(r.n == r.d for r in got)


def test_mid_ranks_match_pandas(skewed):
    pdf, df = skewed
    counts = df.groupBy("g", "x").agg(F.count("*").alias("c"))
    got = ordering.mid_ranks(counts, "x", "c", buckets=8).select("x", "mid_rank", "ties").distinct().toPandas().set_index("x")
    want = pdf.assign(r=pdf.x.rank()).groupby("x").r.agg(["first", "size"])
    assert (got.mid_rank.sort_index() == want["first"]).all() and (got.ties.sort_index() == want["size"]).all()


def test_top_per_group_limits_before_the_shuffle(skewed):
    from tessera.operators.aggregates import top_per_group

    _, df = skewed
    plan = top_per_group(df, ["g"], [F.desc("x"), F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_nan_is_missing_and_infinities_are_values(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in [nan, None, -inf, 1.0, 2.0, inf, inf]], "x double")
    got = ordering.quantiles(df, [], "x", {"lo": 0.0, "m": 0.5, "hi": 1.0, "q3": 0.75}).first()
    assert (got.lo, got.m, got.hi, got.q3) == (-inf, 2.0, inf, inf)
    assert ordering.cumulative(df, [], "x").count() == 4


def test_bucket_count_follows_the_rows(spark, monkeypatch):
    """Twice the rows are twice the buckets: the largest bucket does not grow with the table."""
    monkeypatch.setattr(ordering, "BUCKETS", 4)
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 100)

    def largest(n):
        df = spark.range(n).selectExpr("id * 7919 % 100003 as v")
        cuts = ordering.boundaries(df, "v", 4)
        return ordering.add_bucket(df, "v", cuts).groupBy("_bucket").count().agg({"count": "max"}).first()[0]

    small, large = largest(4000), largest(8000)
    assert small <= 160 and large <= 160
    got = ordering.quantiles(spark.range(4001).selectExpr("id * 1000 % 4001 as v"), [], "v", {"m": 0.5}, 4).first().m
    assert got == 2000.0


# -- quantiles of many groups -------------------------------------------------------------------------


def grouped(spark, rows, schema="g string, x double"):
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.mark.parametrize("most", [40, 1_000_000])
def test_quantiles_of_small_and_large_groups(spark, monkeypatch, most):
    """A third of all rows in one group, groups whose values lie apart, ties, nulls, NaN and a null group."""
    monkeypatch.setattr(ordering, "GROUP_ROWS", most)
    rng = np.random.default_rng(4)
    values = {"hot": rng.integers(0, 30, 1500) / 4, "far": 1e9 + rng.random(700), "one": np.array([5.0]), "same": np.full(300, 2.5), **{f"g{i}": rng.normal(i, 1, 20 + i) for i in range(40)}}
    rows = [(g, float(x)) for g, own in values.items() for x in own]
    rows += [("hot", None), ("hot", float("nan")), ("none", None), (None, 1.0), (None, 3.0)]
    probs = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    got = {r.g: r for r in ordering.quantiles(grouped(spark, rows), ["g"], "x", probs).collect()}
    assert set(got) == set(values)
    for g, own in values.items():
        assert np.allclose([got[g][n] for n in probs], np.quantile(own, list(probs.values())), rtol=1e-12)


@pytest.mark.parametrize("most", [40, 1_000_000])
def test_group_table_in_one_pass(spark, monkeypatch, most):
    monkeypatch.setattr(ordering, "GROUP_ROWS", most)
    rows = [("a", float(i % 7)) for i in range(301)] + [("b", None), ("c", 1.0), ("c", 2.0), (None, 4.0), ("a", None)]
    got = {r.g: tuple(r)[1:] for r in agg.group_table(grouped(spark, rows), ["g"], "x").collect()}
    a = [float(i % 7) for i in range(301)]
    assert got == {"a": (302, sum(a), sum(a) / 301, 3.0), "b": (1, None, None, None), "c": (2, 3.0, 1.5, 1.5), None: (1, 4.0, 4.0, 4.0)}


def test_offsets_follow_the_data(spark, monkeypatch):
    """Large groups get one bucket for so many rows; nothing is kept for each group and each bucket of all."""
    monkeypatch.setattr(ordering, "GROUP_ROWS", 50)
    df = grouped(spark, [(f"g{i % 20}", float(i * (i % 20) ** 3)) for i in range(6000)]).withColumns({"_v": F.col("x"), "_pos": F.col("x")})
    large = ordering._large(df, ["g"])
    assert large.count() == 20
    rows, offsets = ordering._group_buckets(df, ["g"], large)
    assert offsets.count() <= 6000 / 50 + 20
    assert rows.where("g <> 'g0'").groupBy("g", "_bucket").count().agg(F.max("count")).first()[0] <= 3 * 50  # g0 is one value


def test_one_exchange_for_groups(spark):
    df = grouped(spark, [("a", 1.0), ("b", 2.0)])
    plan = agg.group_table(df, ["g"], "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(g") == 1
