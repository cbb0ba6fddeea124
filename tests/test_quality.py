"""Gates, anomalies, profiles, drift and tests on small frames."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import drift, profile, quality, slices, stat_tests


def rules(df):
    return {(r.rule, r.feature): (r.severity, r.n) for r in df.collect()}


def test_contract_findings(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, name string")
    contract = {"id": {"type": "string"}, "name": {"type": "string", "nullable": False, "enum": ["a"]}, "gone": {"type": "integer"}}
    got = rules(quality.contract_findings(df, contract, allow_extra=False))
    assert set(got) == {("type_mismatch", "id"), ("null_in_required", "name"), ("not_in_enum", "name"), ("missing_column", "gone")}
    assert ("missing_column", "gone") not in rules(quality.contract_findings(df, contract, required=["id"]))
    assert rules(quality.contract_findings(df.select("id"), {"name": {"type": "string"}}, False)) == {("missing_column", "name"): ("error", 0), ("extra_column", "id"): ("error", 0)}


def test_threshold_resolution_and_strict_mode(spark):
    assert quality.threshold_for("a", {"a": 0.9}, 0.5, 0.25) == 0.9
    assert quality.threshold_for("b", {"a": 0.9}, 0.5, 0.25) == 0.5
    assert quality.threshold_for("b", {}, None, 0.25) == 0.25
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(quality.GateFailed):
        quality.enforce(quality.min_rows(df, 2))
    quality.enforce(quality.min_rows(df, 2), strict=False)
    quality.enforce(quality.min_rows(df, 1))


def test_gates_on_empty_input(spark):
    df = spark.createDataFrame([], "id int, lat double, long double, when_date timestamp_ntz, name string")
    as_of = F.lit("2024-01-01").cast("timestamp_ntz")
    assert set(rules(quality.raw_gate(df, {"id": {"type": "integer"}}))) == {("min_rows", "__all__")}
    assert quality.anomalies(df, as_of).count() == 0


def test_edges_of_geo_and_time_bounds(spark):
    as_of = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = [(42.2, -71.2, dt.datetime(2024, 1, 2)), (42.4, -70.9, dt.datetime(2014, 1, 3)), (42.41, -70.9, dt.datetime(2024, 1, 2, 0, 0, 1)), (None, None, None)]
    df = spark.createDataFrame(rows, "lat double, long double, event_date timestamp_ntz")
    assert rules(quality.geo_bounds(df)) == {("latitude_bounds", "lat"): ("warning", 1)}
    assert rules(quality.time_bounds(df, as_of)) == {("future_dates", "event_date"): ("warning", 1)}


def test_nan_coordinates_are_missing_not_outside(spark):
    df = spark.createDataFrame([(float("nan"), -71.0), (99.0, -71.0)], "lat double, long double")
    assert rules(quality.geo_bounds(df)) == {("latitude_bounds", "lat"): ("warning", 1)}
    assert rules(quality.contract_findings(df, {"lat": {"type": "number", "maximum": 50}})) == {("above_maximum", "lat"): ("warning", 1)}


def test_outliers_match_pandas(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 300), [50.0] * 30])
    got = quality.outlier_counts(spark.createDataFrame(pd.DataFrame({"x": x}))).first()
    z = np.abs((x - x.mean()) / x.std())
    q1, q3 = np.quantile(x, [0.25, 0.75])
    assert got.z_outliers == (z > 3.5).sum()
    assert got.iqr_outliers == ((x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))).sum()


def test_missing_and_duplicate_severities(spark):
    df = spark.createDataFrame([(1, None, 1)] * 6 + [(2, "x", 2)] * 2 + [(i, "y", None) for i in range(3, 5)], "a int, b string, c int")
    got = rules(quality.missing_anomalies(df))
    assert got == {("missing_values", "b"): ("critical", 6)}
    assert rules(quality.duplicate_anomalies(df)) == {("duplicate_rows", "__all__"): ("critical", 6)}
    assert rules(quality.suppress_expected(quality.missing_anomalies(df.withColumnRenamed("b", "lat")), "crime")) == {}


def test_profile_edge_columns(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, None, 5, "a"), (nan, None, 5, "a"), (3.0, None, 5, None)], "x double, n double, c int, s string")
    p = {r.column: r for r in profile.profile(df).collect()}
    assert p["x"].present == 2 and p["x"].mean == 2.0 and p["x"].median == 2.0
    assert p["n"].missing == 3 and p["n"].mean is None and p["n"].distinct == 0
    assert p["c"].std == 0.0 and p["c"].q1 == 5.0 and p["s"].distinct == 1


def pandas_psi(cur, ref, bins=10):
    lo, hi = min(cur.min(), ref.min()), max(cur.max(), ref.max())
    edges = np.linspace(lo, hi, bins + 1)
    c, r = (np.maximum(np.histogram(v, edges)[0] / len(v), 1e-6) for v in (cur, ref))
    return float(((c - r) * np.log(c / r)).sum())


@pytest.fixture(scope="module")
def frames(spark):
    def make(seed, mean, p):
        rng = np.random.default_rng(seed)
        return pd.DataFrame({"income": rng.normal(mean, 15000, 1000), "score": rng.uniform(0, 100, 1000), "category": rng.choice(list("ABC"), 1000, p=p)})

    ref, same, moved = make(42, 50000, [0.5, 0.3, 0.2]), make(43, 50000, [0.5, 0.3, 0.2]), make(44, 70000, [0.2, 0.3, 0.5])
    return {n: (f, spark.createDataFrame(f)) for n, f in (("ref", ref), ("same", same), ("moved", moved))}


def test_drift_found_only_when_shifted(frames):
    ref = frames["ref"]
    same = {r.column: r for r in drift.detect(frames["same"][1], ref[1]).collect()}
    moved = {r.column: r for r in drift.detect(frames["moved"][1], ref[1]).collect()}
    assert all(r.severity != "critical" for r in same.values())
    assert moved["income"].severity == "critical" and moved["category"].severity == "critical" and moved["score"].severity == "none"
    assert moved["income"].psi == pytest.approx(pandas_psi(frames["moved"][0].income, ref[0].income), rel=1e-9)
    assert moved["category"].kind == "categorical"


def test_constant_and_disjoint_columns(spark):
    a = spark.createDataFrame([(1.0, True)] * 3, "x double, flag boolean")
    got = {r.column: (r.psi, r.kind) for r in drift.detect(a, a).collect()}
    assert got["x"] == (0.0, "numerical") and got["flag"] == (0.0, "categorical")


def test_drift_p_values(frames):
    out = {r.column: r for r in drift.with_p_values(drift.test_statistics(frames["moved"][1], frames["ref"][1])).collect()}
    assert out["income"].severity == "critical" and out["category"].p_value < 1e-6
    assert drift.retrain_decision(drift.dataset_drift(drift.detect(frames["moved"][1], frames["ref"][1]))).first().retrain
    cool = drift.retrain_decision(drift.dataset_drift(drift.detect(frames["moved"][1], frames["ref"][1])), hours_since_last=2).first()
    assert not cool.retrain and cool.reasons == "cooldown"


def test_profile_psi(spark):
    schema = "column string, mean double, std double, distinct bigint"
    cur = spark.createDataFrame([("a", 10.0, 1.0, 5), ("b", None, None, 15)], schema)
    ref = spark.createDataFrame([("a", 5.0, 1.0, 5), ("b", None, None, 10)], schema)
    assert {r.column: r.psi for r in profile.psi_from_profiles(cur, ref).collect()} == {"a": 0.5, "b": 0.5}


def test_rank_tests_against_direct_formulas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(list("ab"), 400), "x": rng.integers(0, 20, 400).astype(float)})
    df = spark.createDataFrame(pdf)
    ranks = pdf.x.rank()
    n = len(pdf)
    s = sum(ranks[pdf.g == g].sum() ** 2 / (pdf.g == g).sum() for g in "ab")
    t = pdf.x.value_counts()
    h = (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - (t**3 - t).sum() / (n**3 - n))
    kw = stat_tests.kruskal(df, "g", "x")
    assert kw.first().statistic == pytest.approx(h)
    assert 0 <= stat_tests.p_value(kw, "chi2") <= 1
    a = pdf.g == "a"
    u = ranks[a].sum() - a.sum() * (a.sum() + 1) / 2
    mw = stat_tests.mann_whitney(df, "g", "x", "a", "b")
    assert mw.first().statistic == pytest.approx(u)
    # both tests ask the same question of two groups (one corrects for continuity)
    assert stat_tests.p_value(mw, "mw") == pytest.approx(stat_tests.p_value(kw, "chi2"), abs=0.01)


@pytest.mark.parametrize("x,dof,want", [(3.841, 1, 0.05), (5.991, 2, 0.05), (18.307, 10, 0.05), (0.0, 3, 1.0), (200.0, 5, 0.0)])
def test_chi_square_tail(x, dof, want):
    assert stat_tests.chi2_sf(x, dof) == pytest.approx(want, abs=1e-4)


def test_quantile_slices_cover_the_table(spark):
    df = spark.createDataFrame([(float(i % 50),) for i in range(200)], "x double")
    out = slices.by_quantiles(df, "x", 4).collect()
    assert sum(r["size"] for r in out) == 200 and {r.value for r in out} == {"Q1", "Q2", "Q3", "Q4"}
    const = slices.by_quantiles(spark.createDataFrame([(1.0,)] * 5, "x double"), "x", 4)
    assert const.count() == 0
    assert slices.by_quantiles(df.where("false"), "x").count() == 0


def test_outcomes_other_than_0_and_1_are_rejected(spark):
    from tessera.operators import fairness

    good = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", None)], "g string, y double")
    assert {r.value: r.rate for r in fairness.outcome_rates(good, "g", "y").collect()}["a"] == 0.5
    with pytest.raises(Exception, match="not 0 or 1"):
        fairness.outcome_rates(spark.createDataFrame([("a", 0.9)], "g string, y double"), "g", "y").collect()
