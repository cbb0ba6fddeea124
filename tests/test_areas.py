"""Points in many areas against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import areas
from tessera.operators import features

POINT = "id long, lat double, long double, name string"
BOX = "name string, priority long, min_lat double, max_lat double, min_lon double, max_lon double"


def test_many_boxes(spark):
    rng = np.random.default_rng(1)
    n, m = 100_000, 3000
    at = np.column_stack([42.2 + rng.random(n) * 0.2, -71.2 + rng.random(n) * 0.3])
    size = np.where(np.arange(n) % 1000 == 0, 0.1, 10.0 ** rng.uniform(-6, -3, n))  # from centimetres to a town
    size[:3] = 200.0
    low, high = at - size[:, None], at + size[:, None]
    rank = rng.permutation(n) + 10
    rank[:3] = n + 100
    boxes = [(f"b{i}", int(rank[i]), *map(float, (low[i, 0], high[i, 0], low[i, 1], high[i, 1]))) for i in range(n)]
    odd = [("turned", 0, 43.0, 42.0, -72.0, -71.0), ("holes", 0, None, 43.0, -72.0, -71.0)]
    points = np.column_stack([42.1 + rng.random(m) * 0.4, -71.3 + rng.random(m) * 0.5])
    points[: m // 3] = points[0]  # a third at one place
    points[-5:] = low[5:10]  # corners are inside
    rows = [(i, *map(float, p), "x") for i, p in enumerate(points)] + [(m, None, 1.0, "x"), (m + 1, 1.0, None, "x"), (m + 2, -89.0, -179.0, "x")]
    df = areas.tag_areas(spark.createDataFrame(rows, POINT), spark.createDataFrame(boxes + odd, BOX), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = {r.id: r.area for r in df.collect()}
    for i, (y, x) in enumerate(points):
        hit = np.flatnonzero((low[:, 0] <= y) & (y <= high[:, 0]) & (low[:, 1] <= x) & (x <= high[:, 1]))
        assert got[i] == (f"b{hit[rank[hit].argmin()]}" if len(hit) else "Other")
    assert got[m] == got[m + 1] == "Unknown" and len(got) == m + 3


def rows_joined(node):
    """The most rows that leave a join of a plan that was run."""
    name = node.nodeName()
    kids = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
    own = node.metrics().get("numOutputRows").get().value() if "Join" in name else 0
    return max([own, *map(rows_joined, kids)])


def test_crowded_places_meet_crowded_areas_once(spark):
    boxes = [(f"b{i}", i, 42.0, 42.0 + i / 1e6, -71.0, -71.0 + i / 1e6) for i in range(1, 401)]
    points = [(i, 42.0 + (i % 2) * 0.0002, -71.0, "x") for i in range(500)] + [(0, 42.0, -71.0, "again"), (None, 42.0002, -71.0, "x")]
    df = areas.tag_areas(spark.createDataFrame(points, POINT), spark.createDataFrame(boxes, BOX), ["id"])
    got = {(r.id, r.name): r.area for r in df.collect()}
    assert got[0, "x"] == got[0, "again"] == "b1" and got[None, "x"] == "b200" and len(got) == 502
    assert all(got[i, "x"] == ("b200" if i % 2 else "b1") for i in range(500))
    assert rows_joined(df._jdf.queryExecution().executedPlan()) <= 502  # not points times areas


def test_outlines(spark):
    rng = np.random.default_rng(2)

    def star(y, x, k):
        turn = np.sort(rng.random(k)) * 2 * np.pi
        r = rng.uniform(0.002, 0.02, k)
        return [{"lat": float(y + a * np.sin(t)), "lon": float(x + a * np.cos(t))} for a, t in zip(r, turn)]

    shapes = [(f"s{i}", i, star(42.3 + rng.random() * 0.05, -71.1 + rng.random() * 0.05, int(rng.integers(3, 12)))) for i in range(60)]
    shapes += [("line", -1, star(42.3, -71.1, 2)), ("none", -1, [])]
    table = spark.createDataFrame(shapes, "name string, priority long, outline array<struct<lat:double,lon:double>>")
    points = [(i, float(42.28 + rng.random() * 0.09), float(-71.12 + rng.random() * 0.09), "p") for i in range(1500)]

    def holds(outline, y, x):
        odd = False
        for a, b in zip(outline, outline[1:] + outline[:1]):
            if (a["lat"] > y) != (b["lat"] > y) and x < a["lon"] + (y - a["lat"]) / (b["lat"] - a["lat"]) * (b["lon"] - a["lon"]):
                odd = not odd
        return odd

    got = {r.id: r.area for r in areas.tag_areas(spark.createDataFrame(points, POINT), table, ["id"]).collect()}
    want = {i: next((n for n, _, o in shapes if len(o) > 2 and holds(o, y, x)), "Other") for i, y, x, _ in points}
    assert got == want and len(set(want.values())) > 30


def test_shared_edges_and_empty_tables(spark):
    def box(name, x0, x1):
        return (name, 0, [{"lat": y, "lon": x} for y, x in ((0.0, x0), (0.0, x1), (1.0, x1), (1.0, x0))])

    schema = "name string, priority long, outline array<struct<lat:double,lon:double>>"
    edge = spark.createDataFrame([(i, 0.1 * i, 1.0, "e") for i in range(10)], POINT)
    one = areas.tag_areas(edge, spark.createDataFrame([box("l", 0.0, 1.0)], schema), ["id"]).where("area = 'l'").count()
    two = areas.tag_areas(edge, spark.createDataFrame([box("r", 1.0, 2.0)], schema), ["id"]).where("area = 'r'").count()
    assert one + two == 10
    assert {r.area for r in areas.tag_areas(edge, spark.createDataFrame([], schema), ["id"]).collect()} == {"Other"}
    assert areas.tag_areas(edge.limit(0), spark.createDataFrame([box("l", 0.0, 1.0)], schema), ["id"]).count() == 0


def test_ranks_of_texts_with_a_common_prefix(spark):
    values = [f"{'same prefix of many bytes ' * 2}{i:05d}" for i in range(5000)] + ["", "é", None]
    df = spark.createDataFrame([(v,) for v in values for _ in range(2)], "t string").repartition(4)
    got = {r.t: r.code for r in features.category_code(df, "t", "code").collect()}
    ranked = sorted({v for v in values if v is not None}, key=str.encode)
    assert got == {**{v: i for i, v in enumerate(ranked)}, None: -1}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # else Spark puts so few rows together
        ranks = features.ordering_text_rank(df.distinct(), "t").withColumn("p", F.spark_partition_id())
        rows = [n for (n,) in ranks.groupBy("p").count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) >= 3 and max(rows) < 3000  # spread over tasks by the values themselves
