"""Routes, retrieval, evaluation, publishing and model gates."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.operators import fairness, mitigation, model, retrieval, routes
from tessera.sources import layers, state


def test_route_labels_each_once_and_both_directions(spark):
    rows = [("r", i, s, d) for i, (s, d) in enumerate([(85.0, 300.0), (60.0, 100.0), (70.0, 200.0), (10.0, 900.0)])] + [("one", 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "req string, route int, route_score double, duration_s double")
    high = {(r.req, r.route): r for r in routes.rank_routes(df, "req", "route").collect()}
    assert [high[("r", i)].rank_label for i in range(4)] == ["safest", "fastest", "balanced", "alternative"]
    assert [high[("r", i)].place for i in range(4)] == [0, 2, 1, 3]
    assert high[("one", 0)].rank_label == "safest / fastest / balanced"
    low = {r.route: r.rank_label for r in routes.rank_routes(df.where("req = 'r'"), "req", "route", high_is_safe=False).collect()}
    assert low[3] == "safest" and low[1] == "fastest"


def test_next_best_is_taken_when_the_fastest_is_also_safest(spark):
    df = spark.createDataFrame([("r", 0, 90.0, 10.0), ("r", 1, 80.0, 20.0), ("r", 2, 70.0, 15.0)], "req string, route int, route_score double, duration_s double")
    got = {r.route: r.rank_label for r in routes.rank_routes(df, "req", "route").collect()}
    assert got == {0: "fastest", 1: "safest", 2: "balanced"}


def test_points_without_a_cell_are_neutral(spark):
    scores = spark.createDataFrame([("1:1", 0, 80.0, "HIGH")], "h3_index string, hour_bucket int, risk_score double, risk_tier string")
    pts = spark.createDataFrame([(1, "1:1", 0), (2, None, 0), (3, "1:1", None), (4, "9:9", 0)], "id int, h3_index string, hour_bucket int")
    got = {r.id: (r.risk_score, r.risk_tier, r.found, r.h3_index) for r in routes.lookup_scores(pts, scores).collect()}
    assert got == {1: (80.0, "HIGH", True, "1:1"), 2: (50.0, "MEDIUM", False, None), 3: (50.0, "MEDIUM", False, "1:1"), 4: (50.0, "MEDIUM", False, "9:9")}


def test_route_scores_with_long_and_empty_paths(spark):
    cell = spark.range(1).select(geo.hex_cell(F.lit(42.3), F.lit(-71.05)).alias("c")).first().c
    scores = spark.createDataFrame([(cell, 3, 80.0, "HIGH")], "h3_index string, hour_bucket int, risk_score double, risk_tier string")
    rows = [("a", [(42.3, -71.05)] * 250, 13), ("b", [], 13), ("c", [(42.3, -71.05), (42.21, -71.19)], 13)]
    df = spark.createDataFrame(rows, "route string, geometry array<struct<lat:double,lon:double>>, hour int")
    assert {r.route: r.route_score for r in routes.score_routes(df, scores, ["route"]).collect()} == {"a": 80.0, "b": 50.0, "c": 65.0}
    assert [routes.path_points(df, ["route"], n).where("route = 'a'").count() for n in (100, None)] == [100, 250]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(400, 16))
    m[7] = m[8]  # a tie
    pdf = pd.DataFrame({"vec_id": np.arange(400), "embedding": m.tolist()})
    return m, spark.createDataFrame(pdf)


def test_both_retrieval_paths_equal_brute_force(vectors, monkeypatch):
    m, df = vectors
    q = df.where("vec_id < 30").select(F.col("vec_id").alias("query_id"), "embedding")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sim = unit[:30] @ unit.T
    want = {(i, int(v)) for i in range(30) for v in np.lexsort((np.arange(400), -np.round(sim[i], 12)))[:5]}
    few = retrieval.top_k(q, df, 5)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 8)
    monkeypatch.setattr(retrieval, "VECTOR_BLOCK", 64)
    many = retrieval.top_k(q, df, 5, max_queries=10)
    assert {(r.query_id, r.vec_id) for r in few.collect()} == want
    assert {(r.query_id, r.vec_id) for r in many.collect()} == want
    assert retrieval.top_k(q, df.where("vec_id < 3"), 5).groupBy("query_id").count().agg(F.max("count")).first()[0] == 3
    assert retrieval.top_k(q.where("false"), df, 5).count() == 0


def test_question_evaluation(spark):
    q = spark.createDataFrame(
        [(1, "c", "easy", ["crime"], ["Theft", "zzz"]), (2, "c", "hard", ["none"], ["x"]), (3, "d", "hard", ["none"], [])],
        "query_id long, category string, difficulty string, expected array<string>, keywords array<string>",
    )
    h = spark.createDataFrame([(1, "crime", "theft here", 0.5, 1), (1, "food", "b", 0.7, 2), (2, "food", "b", 0.1, 1)], "query_id long, dataset string, text string, score double, rank int")
    got = {r.query_id: r for r in retrieval.evaluate_questions(q, h).collect()}
    assert got[1].retrieval_hit and got[1].keyword_coverage == 0.5 and got[1].avg_score == 0.6
    assert got[2].false_positive and not got[2].retrieval_hit
    assert got[3].retrieval_hit and got[3].chunks == 0


def test_chunk_ids_continue(spark):
    first = retrieval.append_chunks(None, spark.createDataFrame([(5, "a" * 600), (9, "b")], "k long, text string"), "k")
    more = retrieval.append_chunks(first, spark.createDataFrame([(2, "c")], "k long, text string"), "k")
    assert sorted((r.chunk_id, len(r.text), len(r.head)) for r in first.collect()) == [(0, 600, 500), (1, 1, 1)]
    assert more.first().chunk_id == 2


def test_every_row_gets_an_id(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (None, "c"), (2, "d"), (None, None)], "k long, text string")
    rows = layers.synthetic_ids(df, "k").orderBy("_id").collect()
    assert [r._id for r in rows] == [1, 2, 3, 4, 5] and [r.k for r in rows] == [1, 2, 2, None, None]
    many = layers.synthetic_ids(spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) as k", "id"), "k").orderBy("_id").collect()
    assert [r._id for r in many] == list(range(1, 3001)) and [r.k for r in many] == sorted(r.k for r in many)
    assert layers.synthetic_ids(df.limit(0), "k").count() == 0


def test_latest_follows_the_pointer(spark, tmp_path):
    store = layers.LayerStore(spark, str(tmp_path))
    assert store.pointer("t", "raw") is None
    for d, v in (("2024-01-02", 2), ("2024-01-01", 1)):
        store.write(spark.createDataFrame([(v,)], "x int"), "t", "raw", d)
    assert store.pointer("t", "raw") == "2024-01-01" and store.latest("t", "raw").first().x == 1
    assert [str(r.dt) for r in store.dates("t", "raw").collect()] == ["2024-01-01", "2024-01-02"]


def test_layer_store_round_trip(spark, tmp_path):
    store = layers.LayerStore(spark, str(tmp_path), merge_schema=True)
    for d, v in (("2024-01-01", 1), ("2024-01-02", 2)):
        store.write(spark.createDataFrame([(v,)], "x int"), "t", "raw", d)
    store.write(spark.createDataFrame([(3, "new")], "x int, extra string"), "t", "raw", "2024-01-02")
    assert store.latest("t", "raw").first().x == 3
    assert store.partition("t", "raw", "2024-01-01").first().extra is None
    assert [str(r.dt) for r in store.dates("t", "raw", newest_first=True).collect()] == ["2024-01-02", "2024-01-01"]
    assert store.trailing("t", "raw", "2024-01-02", 1).count() == 1
    plan = store.partition("t", "raw", "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_score_publishing(spark):
    schema = "h3_index string, hour_bucket int, s double, model_version string"
    old = spark.createDataFrame([("a", 0, 1.0, "v1"), ("b", 0, 2.0, "v1")], schema)
    new = spark.createDataFrame([("a", 0, 9.0, "v2")], schema)
    both = state.upsert(old, new, ["h3_index", "hour_bucket"])
    assert {r.h3_index: r.s for r in both.collect()} == {"a": 9.0, "b": 2.0}
    assert state.drop_stale(both, "v2").count() == 1
    assert state.verify_publish(both, "v2", F.lit(1)).first().ok and not state.verify_publish(both, "v2", F.lit(2)).first().ok


def test_watermark_history_depth_and_lookback(spark):
    rows = [("d", i, f"2024-01-{i:02d}") for i in range(1, 13)]
    h = spark.createDataFrame(rows, "dataset string, v int, d string").select("dataset", F.col("d").cast("timestamp_ntz").alias("value"), F.col("d").cast("date").alias("run_date"))
    kept = state.set_watermarks(h.limit(0), h)
    assert kept.count() == 10 and state.current_watermarks(kept).first().value.day == 12
    eff = state.effective_watermarks(spark.createDataFrame([("d",), ("x",)], "dataset string"), kept, F.lit("2024-02-01").cast("timestamp_ntz"), 7)
    assert {r.dataset: (r.value.month, r.value.day) for r in eff.collect()} == {"d": (1, 12), "x": (1, 25)}


def test_promotion_gate(spark):
    versions = spark.createDataFrame([("v1", 0.4, "production"), ("v0", 0.3, "archived")], "version string, val_rmse double, stage string")
    cand = spark.createDataFrame([("ok", 0.405), ("bad", 0.5)], "candidate string, val_rmse double")
    assert {r.candidate: r.should_promote for r in model.compare_to_production(cand, versions, 0.02).collect()} == {"ok": True, "bad": False}
    cold = model.compare_to_production(cand, versions.where("false"), 0.0).collect()
    assert all(r.should_promote for r in cold)
    assert {r.version: r.stage for r in model.rollback(versions, "v0").collect()} == {"v1": "archived", "v0": "production"}


def test_slice_gate_exempts_small_slices(spark):
    rows = [("big", 1.0, 1.1)] * 40 + [("odd", 1.0, 3.0)] * 5
    df = spark.createDataFrame(rows, "g string, y double, p double")
    gate = {r.value: r for r in fairness.slice_gate(df, ["g"], "y", "p").collect()}
    assert gate["odd"].is_small and gate["odd"].passed and gate["big"]["count"] == 40


def test_fairness_edges(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 0), ("b", 0)], "g string, y int")
    rep = {r.value: r for r in fairness.representation(df, "g").collect()}
    assert rep["a"].actual == 50.0 and rep["b"].actual == 25.0
    out = {r.value: r for r in fairness.outcome_disparity(df, "g", "y").collect()}
    assert out["a"].expected == pytest.approx(2 / 3) and out["b"].severity == "critical"
    assert fairness.outcome_disparity(df.where("g = 'a'"), "g", "y").count() == 0
    assert fairness.report(fairness.evaluate(df, ["g"], "y")).first().passed is False


def test_weights_sum_to_rows_and_thresholds_clip(spark):
    df = spark.createDataFrame([("a", 1)] * 6 + [("b", 0)] * 2, "g string, y int")
    assert mitigation.reweight(df, "g").agg(F.sum("sample_weight")).first()[0] == pytest.approx(8)
    th = {r.g: r.adjusted_threshold for r in mitigation.adjusted_thresholds(df, "g", "y").collect()}
    assert th["b"] == pytest.approx(0.125) and th["a"] == pytest.approx(0.625)


def test_training_run_stops_at_the_right_gate(spark):
    rng = np.random.default_rng(1)
    cols = [c for c in model.INPUTS if c != "hour_bucket"]
    pdf = pd.DataFrame(rng.random((240, len(cols))), columns=cols)
    pdf["h3_index"] = [f"{i // 6}:0" for i in range(240)]
    pdf["hour_bucket"] = [i % 6 for i in range(240)]
    feats = spark.createDataFrame(pdf)
    inc = feats.select("h3_index", "hour_bucket", F.lit("2024-01-01").cast("timestamp_ntz").alias("occurred_on_date"), F.col("weighted_score_30d").alias("severity_weight"), F.lit("i").alias("incident_number"), F.lit("A1").alias("district"))
    small = model.ModelConfig(trees=3, depth=2, min_cells=5, rmse_gate=10.0)
    run = model.train_run(feats, inc, small, "v1", "2024-01-01")
    assert run.promoted and run.scores.count() == 240
    assert run.scores.where("risk_score < 0 or risk_score > 100").count() == 0
    assert model.train_run(feats, inc, model.ModelConfig(min_rows=1000), "v1", "d").stopped_at == "too few rows"
    assert model.train_run(feats, inc, model.ModelConfig(trees=2, min_cells=5, rmse_gate=0.0), "v1", "d").stopped_at == "error gate"
    versions = spark.createDataFrame([("v0", 1e-9, "production")], "version string, val_rmse double, stage string")
    assert model.train_run(feats, inc, small, "v1", "d", versions).stopped_at == "promotion"
