"""Cell and grid features on small frames with hand-checked expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.operators import features, rolling

REF = "2024-01-15"


@pytest.fixture(scope="module")
def events(spark):
    """Ten incidents, one per day back from the reference date, in two cells."""
    rows = []
    for i in range(10):
        when = dt.datetime(2024, 1, 15, 10) - dt.timedelta(days=i)
        rows.append((str(i), when, bool(i % 4 == 0), 3.0 * (2 if i % 4 == 0 else 1), "0:0" if i % 2 else "5:5", 2, when.weekday() >= 5, "A1"))
    schema = "incident_number string, occurred_on_date timestamp_ntz, shooting boolean, severity_weight double, h3_index string, hour_bucket int, weekend boolean, district string"
    return spark.createDataFrame(rows, schema)


def ref():
    return F.lit(REF).cast("timestamp_ntz")


def test_cells_are_densified_and_bounded(events):
    out = features.cell_features(events, ref()).toPandas()
    assert len(out) == 12 and set(out.hour_bucket) == set(range(6))
    assert out.trend_3v10.le(3.4).all() and out.trend_10v30.le(3.1).all() and out.trend_30v90.le(3.1).all()
    assert (out.groupby("h3_index").trend_3v10.nunique() == 1).all()
    for c in ("night_score_ratio", "evening_score_ratio", "weekend_score_ratio", "high_severity_ratio_30d"):
        assert out[c].between(0, 1).all()


def test_cell_sums(events):
    out = features.cell_features(events, ref()).toPandas().set_index(["h3_index", "hour_bucket"])
    own = out.loc[("5:5", 2)]
    # even days 0,2,4,6,8: weights 6,3,6,3,6
    assert own.weighted_score_30d == 24.0 and own.incident_count_30d == 5 and own.gun_incident_count_30d == 3
    assert own.violent_score_30d == 18.0
    assert own.neighbor_weighted_score_30d == pytest.approx(24.0 / 6.4)
    assert out.loc[("5:5", 0)].neighbor_weighted_score_30d == 0.0


def test_window_lower_bound_is_closed_and_upper_open(spark, events):
    edge = events.limit(1).withColumn("occurred_on_date", ref() - F.expr("INTERVAL 3 DAYS"))
    later = edge.withColumn("occurred_on_date", ref() + F.expr("INTERVAL 2 DAYS"))
    got = features.bucket_sums(edge.unionByName(later), ref(), features.CellConfig()).first()
    assert got.incident_count_30d == 2 and got.weighted_score_3d == got.weighted_score_90d


def test_neighbours_agree_with_brute_force(spark):
    cells = [(q, r) for q in range(4) for r in range(4)]
    rows = [(f"{q}:{r}", b, float(q * 7 + r * 3 + b)) for q, r in cells for b in (0, 1) if (q + r + b) % 3]
    df = spark.createDataFrame(rows, "h3_index string, hour_bucket int, v double")
    got = {(x.h3_index, x.hour_bucket): x.near for x in features.neighbour_means(df, {"near": "v"}, features.CellConfig()).collect()}
    value = {(c, b): v for c, b, v in rows}
    for c, b, _ in rows:
        q, r = map(int, c.split(":"))
        want = sum(value.get((f"{q + dq}:{r + dr}", b), 0) * geo.RING_WEIGHTS[k] for dq, dr, k in geo.ring_offsets())
        assert got[(c, b)] == pytest.approx(want / 6.4)


def test_ring_sizes():
    rings = [k for *_, k in geo.ring_offsets(2)]
    assert (rings.count(0), rings.count(1), rings.count(2)) == (1, 6, 12)
    assert geo.total_ring_weight() == pytest.approx(1 + 3 + 2.4)


def test_snapshots_and_event_lags_agree(events):
    cfg = features.CellConfig()
    past = [
        features.bucket_sums(events.where(F.col("occurred_on_date") <= r), r, cfg)
        for r in (ref() - F.expr("INTERVAL 1 DAY"), ref() - F.expr("INTERVAL 7 DAYS"))
    ]
    a = features.cell_features(events, ref(), cfg, *past)
    b = features.cell_features(events, ref(), cfg, lags_from_events=True).select(*a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_densify_first_keeps_neighbour_values(events):
    out = features.cell_features(events, ref(), features.CellConfig(densify_first=True)).toPandas()
    assert (out.neighbor_trend_3v10 > 0).all() and len(out) == 12


def test_bucket_level_trends_and_empty_input(spark, events):
    cfg = features.CellConfig(trend_level="bucket")
    out = features.cell_features(events, ref(), cfg).toPandas()
    assert (out[out.weighted_score_90d == 0].trend_3v10 == 1.0).all()
    assert features.cell_features(events.where("false"), ref()).count() == 0


def test_danger_rate_and_matrix(spark):
    inc = spark.createDataFrame(
        [("1", "c", 1, "2024-01-01", 2.0, "A1"), ("2", "c", 1, "2024-01-02", 3.0, "A1")],
        "incident_number string, h3_index string, hour_bucket int, d string, severity_weight double, district string",
    ).withColumn("occurred_on_date", F.col("d").cast("timestamp_ntz"))
    assert features.danger_rate(inc).first().danger_rate == 2.5
    feats = spark.createDataFrame([("c", 1), ("c", 2), ("z", 1)], "h3_index string, hour_bucket int")
    got = {(r.h3_index, r.hour_bucket): (r.danger_rate, r.district) for r in features.training_matrix(feats, inc).collect()}
    assert got == {("c", 1): (2.5, "A1"), ("c", 2): (0.0, "A1"), ("z", 1): (0.0, "UNKNOWN")}


def test_scores_scale_per_bucket(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 3.0), ("a", 1, 5.0), ("b", 1, 5.0)], "h3_index string, hour_bucket int, d double")
    got = {(r.h3_index, r.hour_bucket): r.risk_score for r in rolling.risk_scores(df, "d").collect()}
    assert got == {("a", 0): 0.0, ("b", 0): 100.0, ("a", 1): 50.0, ("b", 1): 50.0}


def test_flagship_plan_has_three_exchanges(events):
    plan = features.cell_features(events, ref())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_city_scores_of_many_metrics_take_the_long_form(spark, monkeypatch):
    from tessera.plans import datasets

    rows = [("2024-01-01 01:00:00", m, s) for m, s in (("a", 1.0), ("b", 2.0), ("c", None))] + [("2024-01-01 02:00:00", "a", 3.0), ("2024-01-02 01:00:00", "b", 5.0)]
    df = spark.createDataFrame(rows, "timestamp string, metric_name string, day_score double").withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "date": F.to_date("timestamp")})
    wide = {str(r.date): (r.avg_day_score, r.a, r.b, r.c) for r in datasets._score_features(df, None).collect()}
    assert wide == {"2024-01-01": (2.0, 3.0, 2.0, None), "2024-01-02": (5.0, None, 5.0, None)}
    monkeypatch.setattr(datasets, "MAX_METRICS", 2)
    long = {(str(r.date), r.metric_name): (r.day_score, r.avg_day_score) for r in datasets._score_features(df, None).collect()}
    assert long == {("2024-01-01", "a"): (3.0, 2.0), ("2024-01-01", "b"): (2.0, 2.0), ("2024-01-01", "c"): (None, 2.0), ("2024-01-02", "b"): (5.0, 5.0)}


@pytest.mark.parametrize("name", ["on_time", "ontime"])
def test_requests_keep_their_status(spark, name):
    from tessera.plans import datasets

    raw = spark.createDataFrame([("1", "2024-01-01", "OVERDUE")], f"case_enquiry_id string, open_dt string, {name} string")
    assert datasets.cleaning.rename(raw, datasets.SERVICE_REQUESTS.mappings).columns == ["case_id", "open_date", "on_time"]
