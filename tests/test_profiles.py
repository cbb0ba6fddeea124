"""Fingerprint grouping and mergeable profiles against the exact forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tessera.operators import profile, profile_state, quality
from tessera.sources.layers import LayerStore

LONG = "x" * 40


def texts(spark):
    rng = random.Random(2)
    values = [LONG + str(i % 7) for i in range(60)] + [LONG + "a" * 500, "short", "short", "", None, "é" * 33, "é" * 33, "é" * 32]
    rows = [(v, rng.randint(0, 3), float("nan") if i % 9 == 0 else float(i % 4)) for i, v in enumerate(values)]
    return rows + rows[:11], spark.createDataFrame(rows + rows[:11], "t string, k int, v double").repartition(3)


def colliding(columns, seed):
    """Hashes that say little, but for the third, which tells groups apart."""
    h = profile.fingerprint(columns, seed)
    return h if seed == 3 else F.pmod(h, F.lit(2))


@pytest.mark.parametrize("hashed", [profile.fingerprint, colliding])
def test_value_counts_by_fingerprint(spark, hashed):
    rows, df = texts(spark)
    counts = profile.keyed_counts(df, hashed=hashed)
    got = {r.column: (r.distinct, r.singletons) for r in profile.distinct_counts(counts).collect()}
    for i, c in enumerate(df.columns):
        own = [str(r[i]) for r in rows if r[i] is not None]
        assert got[c] == (len(set(own)), sum(own.count(v) == 1 for v in set(own)))


@pytest.mark.parametrize("hashed", [profile.fingerprint, colliding])
@pytest.mark.parametrize("keys", [None, ["t"], ["k", "v"]])
def test_duplicates_by_fingerprint(spark, hashed, keys):
    rows, df = texts(spark)
    groups = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("n"))
    n, d = groups.agg(F.sum("n"), F.count("*")).first()
    got = profile.duplicates(df, keys, hashed).first()
    assert (got.rows, got.duplicates) == (n, n - d) and math.isclose(got.duplicate_ratio, (n - d) / n)


def test_nulls_have_a_place_in_a_fingerprint(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    assert profile.duplicates(df).first().duplicates == 0
    assert profile.duplicates(df.limit(0)).first().rows == 0


def test_top_values_fetch_long_texts_late(spark):
    rows, df = texts(spark)
    got = {}
    for r in profile.top_values(df, 4, ["t", "k"]).collect():
        got.setdefault(r.column, []).append((r.rank, r.value, r.n))
    for i, c in enumerate(["t", "k"]):
        own = [str(r[i]) for r in rows if r[i] is not None]
        want = sorted({(-own.count(v), v.encode()) for v in own})[:4]
        assert sorted(got[c]) == [(k + 1, v.decode(), -n) for k, (n, v) in enumerate(want)]


def shuffled(spark, work):
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        executors = store.executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    before = total()
    work()
    return total() - before


def test_texts_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert shuffled(spark, lambda: profile.duplicates(docs).collect()) < size / 10
    assert shuffled(spark, lambda: profile.distinct_counts(profile.keyed_counts(docs)).collect()) < size / 10
    assert shuffled(spark, lambda: quality.category_anomalies(docs, ["text", "source"]).collect()) < size / 10


# -- states -----------------------------------------------------------------------------------------


def history(spark, days=90):
    df = spark.range(days * 200).select(
        F.expr(f"date_add(date'2024-01-01', cast(id % {days} as int))").alias("day"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7.0 + 1e9).alias("v"),
        F.when(F.col("id") % 50 == 3, float("nan")).otherwise((F.col("id") % 5).cast("double")).alias("w"),
        F.concat(F.lit("kind"), F.pmod(F.xxhash64("id"), F.lit(9)).cast("string")).alias("kind"), F.lit(None).cast("string").alias("none"))
    return df


def test_ninety_days_from_stored_states(spark, tmp_path):
    df = history(spark)
    columns = ["v", "w", "kind", "none"]
    store = profile_state.ProfileStore(LayerStore(spark, str(tmp_path)))
    store.save(df, "d", F.col("day"), columns)
    assert len(store.dates("d")) == 90
    merged = store.over("d", "2024-01-11", "2024-03-10")
    own = df.where("day between '2024-01-11' and '2024-03-10'")
    exact = {r.column: r for r in profile.profile(own, columns).collect()}
    for r in merged.collect():
        e = exact[r.column]
        assert (r.rows, r.present, r.missing, r.missing_ratio, r.min, r.max, r.zeros) == (e.rows, e.present, e.missing, e.missing_ratio, e.min, e.max, e.zeros)
        for m in ("mean", "std"):
            assert (r[m] is None) == (e[m] is None) and (r[m] is None or math.isclose(r[m], e[m], rel_tol=1e-9))
        assert abs(r.distinct - e.distinct) <= 0.08 * e.distinct + (r.column == "w")  # the exact form counts NaN as a value
        if e.q1 is not None:
            values = sorted(x[0] for x in own.select(r.column).collect() if x[0] is not None and x[0] == x[0])
            for q, v in ((0.25, r.q1), (0.5, r.median), (0.75, r.q3)):
                low, high = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
                assert low - profile_state.RANK_ERROR <= q <= high + profile_state.RANK_ERROR
    top = {r.value: r.n for r in profile_state.frequent(store.between("d", "2024-01-11", "2024-03-10"), 5).where("column = 'kind'").collect()}
    want = {r.kind: r["count"] for r in own.groupBy("kind").count().collect()}
    assert len(top) == 5 and all(want[v] == n for v, n in top.items()) and min(top.values()) >= sorted(want.values())[-5]


def test_states_are_small_and_rows_unread(spark, tmp_path):
    store = profile_state.ProfileStore(LayerStore(spark, str(tmp_path)))
    store.save(history(spark, 3), "d", F.col("day"))
    files = store.over("d", "2024-01-01", "2024-01-03").inputFiles()
    assert files and all("profile_states" in f for f in files)
    assert store.load("d").where("column = 'w'").first().rows == 200  # the newest date
    assert store.load("d", "2024-01-01").where("column = 'w'").first().rows == 200
    store.save(history(spark, 3).where("day = '2024-01-02'").limit(50), "d", F.col("day"))  # replaces its own day only
    assert store.over("d", "2024-01-01", "2024-01-03").where("column = 'w'").first().rows == 450


def test_profiles_of_states_can_be_compared(spark, tmp_path):
    store = profile_state.ProfileStore(LayerStore(spark, str(tmp_path)))
    store.save(history(spark, 4), "d", F.col("day"), ["w", "kind"])
    a, b = store.load("d", "2024-01-01"), store.over("d", "2024-01-01", "2024-01-04")
    assert {r.column for r in profile.compare(b, a).where("rows_change = 600").collect()} == {"w", "kind"}
    assert all(0 <= r.psi < 0.1 for r in profile.psi_from_profiles(b, a).collect())
