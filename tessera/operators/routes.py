"""Score lookup for points and paths, and ranking of alternative routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import arrays, dates, geo
from tessera.operators import aggregates as agg
from tessera.operators.joining import sized

NEUTRAL = 50.0
#: Points that a route is scored at. Longer paths are sampled evenly, first and last point included; None scores every point.
ROUTE_POINTS = 100


def lookup_scores(points: DataFrame, scores: DataFrame) -> DataFrame:
    """Score and tier of each point's (cell, bucket); unknown cells are neutral.

    The score table has one row per key and a city's is small: it is broadcast when a count shows
    that, so points are not shuffled at all. Beyond that size, points without a cell get one of many
    keys that match nothing instead of all meeting in the NULL partition, and a hot cell is split by
    AQE's skew join.
    """
    spread = F.concat(F.lit("none:"), F.pmod(F.xxhash64(*points.columns), F.lit(4096)).cast("string"))
    table = scores.select(
        F.col("h3_index").alias("_cell"), F.col("hour_bucket").alias("_bucket"), "risk_score", "risk_tier"
    )
    on = (F.coalesce(F.col("h3_index"), spread) == F.col("_cell")) & (F.col("hour_bucket") == F.col("_bucket"))
    found = points.join(sized(table), on, "left").drop("_cell", "_bucket")
    return found.withColumns(
        {
            "found": F.col("risk_score").isNotNull(),
            "risk_score": F.coalesce("risk_score", F.lit(NEUTRAL)),
            "risk_tier": F.coalesce("risk_tier", F.lit("MEDIUM")),
        }
    )


def path_points(
    routes: DataFrame, keep: list[str], most: int | None, geometry="geometry", hour="hour", outer: bool = False
) -> DataFrame:
    """Points of every path, at most ``most`` of them evenly sampled (None: all), with their cell and bucket; ``outer``
    keeps a route without points as one row without a cell."""
    explode = F.posexplode_outer if outer else F.posexplode
    pts = routes.select(*keep, hour, explode(F.col(geometry) if most is None else arrays.even_sample(geometry, most)).alias("position", "_p"))
    return pts.select(
        *keep, "position", geo.hex_cell(F.col("_p.lat"), F.col("_p.lon")).alias("h3_index"),
        dates.hour_bucket(hour).alias("hour_bucket"),
    )


def score_routes(routes: DataFrame, scores: DataFrame, key: list[str], keep: list[str] = (), points: int | None = ROUTE_POINTS) -> DataFrame:
    """Mean score along each route, neutral for one without points. The scalar columns in ``keep``
    travel with the points, so the routes are read once and not joined back."""
    pts = lookup_scores(path_points(routes, [*key, *keep], points, outer=True), scores)
    mean = F.round(F.avg("risk_score"), 2).alias("route_score")
    return pts.groupBy(*key).agg(*[F.first(c).alias(c) for c in keep], mean)


def rank_routes(
    routes: DataFrame, request: str, route: str, high_is_safe: bool = True, safety_weight=0.6, speed_weight=0.4
) -> DataFrame:
    """Labels fastest → safest → balanced → alternative per request, each label taking the best
    route not yet claimed, and the display order safest, balanced, fastest, alternative.

    The alternatives of one request are few by nature (a directions service returns three or so),
    so the windows share one shuffle on it.
    """
    req = Window.partitionBy(request)
    score = F.col("route_score")
    safe = score if high_is_safe else F.lit(100.0) - score
    out = routes.withColumns(
        {
            "_n": F.count("*").over(req),
            "composite": safe / 100 * safety_weight
            + (1 - F.col("duration_s") / F.when(F.max("duration_s").over(req) != 0, F.max("duration_s").over(req)).otherwise(1.0)) * speed_weight,
            "_safe": safe,
            "_fast": F.row_number().over(req.orderBy("duration_s", route)) == 1,
        }
    )
    free = Window.partitionBy(request, "_fast")
    out = out.withColumn("_safest", ~F.col("_fast") & (F.row_number().over(free.orderBy(F.desc("_safe"), route)) == 1))
    free = Window.partitionBy(request, "_fast", "_safest")
    out = out.withColumn(
        "_balanced", ~F.col("_fast") & ~F.col("_safest") & (F.row_number().over(free.orderBy(F.desc("composite"), route)) == 1)
    )
    label = (
        F.when(F.col("_n") == 1, "safest / fastest / balanced")
        .when(F.col("_fast"), "fastest")
        .when(F.col("_safest"), "safest")
        .when(F.col("_balanced"), "balanced")
        .otherwise("alternative")
    )
    place = F.when(F.col("_safest") | (F.col("_n") == 1), 0).when(F.col("_balanced"), 1).when(F.col("_fast"), 2).otherwise(3)
    return out.withColumns({"rank_label": label, "place": place}).drop("_n", "_safe", "_fast", "_safest", "_balanced")


def last_turns(df: DataFrame, session: str, turn: str, pairs: int) -> DataFrame:
    """Last ``2 · pairs`` messages of each session."""
    return agg.top_per_group(df, [session], [F.desc(turn)], 2 * pairs, "_rn").drop("_rn")
