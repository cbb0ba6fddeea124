"""Points in many areas: an equi-join on grid cells, then the exact test, then the area that comes first.

Areas are boxes or outlines, in a table. Each lies on the level of a quadtree at which it is about as wide as a cell, so it
covers at most nine cells however large or small it is. A point has one cell on each level that areas lie on. Both sides meet
by (level, cell): no point is compared with areas that are nowhere near it, and a crowded cell is an ordinary skewed join key.
Points at the same place are one row there, so that crowded places meet crowded areas once and not once a point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joining import settle, sized

#: Finest level: cells of 360 / 2^22 degrees, about ten metres. Smaller areas lie there too.
FINEST = 22
LEFT, BOTTOM, SPAN = -180.0, -90.0, 360.0


def _cell(value: Column, low: float, level) -> Column:
    return F.floor((value - F.lit(low)) / F.lit(SPAN) * F.pow(F.lit(2.0), level)).cast("bigint")


def boxed(areas: DataFrame) -> DataFrame:
    """Areas with the box around their ``outline``, an array of structs (lat, lon), where they have one instead of a box."""
    if "outline" not in areas.columns:
        return areas.withColumn("outline", F.lit(None).cast("array<struct<lat:double,lon:double>>"))
    ends = {"min_lat": ("lat", F.array_min), "max_lat": ("lat", F.array_max), "min_lon": ("lon", F.array_min), "max_lon": ("lon", F.array_max)}
    box = {}
    for name, (axis, end) in ends.items():
        own = end(F.col("outline")[axis])  # the field of all structs
        box[name] = F.coalesce(own, F.col(name)) if name in areas.columns else own
    return areas.withColumns(box)


def placed(areas: DataFrame) -> DataFrame:
    """Each area once for every cell of its level that it touches. Areas without a whole box, or whose sides are turned, have none."""
    width = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon"))
    fits = F.floor(F.log2(F.lit(SPAN) / F.greatest(width, F.lit(SPAN / 2**FINEST))))
    rows = boxed(areas).where("min_lat <= max_lat and min_lon <= max_lon").withColumn("_level", F.greatest(F.lit(0), F.least(fits, F.lit(FINEST))).cast("int"))
    level = F.col("_level")
    for axis, low in (("lon", LEFT), ("lat", BOTTOM)):
        rows = rows.withColumn(f"_{axis}", F.explode(F.sequence(_cell(F.col(f"min_{axis}"), low, level), _cell(F.col(f"max_{axis}"), low, level))))
    return rows


def inside(lat: Column, lon: Column) -> Column:
    """Whether a point lies in an area: in its closed box and, where it has an outline, inside that by the even-odd rule.

    Points on an outline count for the side to which the rule puts them: of two outlines that share an edge exactly one holds
    a point of it.
    """
    box = lat.between(F.col("min_lat"), F.col("max_lat")) & lon.between(F.col("min_lon"), F.col("max_lon"))
    n = F.size("outline")

    def crosses(i):
        a, b = F.get("outline", i), F.get("outline", (i + 1) % n)
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        at = a["lon"] + (lat - a["lat"]) / (b["lat"] - a["lat"]) * (b["lon"] - a["lon"])
        return spans & F.when(spans, lon < at).otherwise(False)

    odd = F.size(F.filter(F.sequence(F.lit(0), n - 1), crosses)) % 2 == 1
    return box & F.when(F.col("outline").isNull(), True).when(n < 3, False).otherwise(odd)


def tag_areas(
    points: DataFrame, areas: DataFrame, key: Sequence[str], lat: str = "lat", lon: str = "long", out: str = "area",
    outside: str = "Other", missing: str = "Unknown",
) -> DataFrame:
    """Each point with the name of the first area it lies in, by ``priority`` and then name.

    ``areas`` has name, priority, and min_lat, max_lat, min_lon, max_lon, or an ``outline``. ``key`` tells points apart; points
    with the same key get the area that comes first among all of theirs. A point without a coordinate is ``missing``, one in no
    area ``outside``.
    """
    key = list(key)
    cells = settle(placed(areas).select("name", "priority", "min_lat", "max_lat", "min_lon", "max_lon", "outline", "_level", "_lon", "_lat"))
    levels = [r[0] for r in cells.select("_level").distinct().collect()]  # FINEST + 1 at most
    where = points.select(*key, F.col(lat).cast("double").alias("_y"), F.col(lon).cast("double").alias("_x")).where("_y is not null and _x is not null")
    # each place is looked up once, however many points are there
    spots = where.select("_y", "_x").distinct().withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    level = F.col("_level")
    spots = spots.withColumns({"_lon": _cell(F.col("_x"), LEFT, level), "_lat": _cell(F.col("_y"), BOTTOM, level)})
    found = spots.join(sized(cells), ["_level", "_lon", "_lat"]).where(inside(F.col("_y"), F.col("_x")))
    places = found.groupBy("_y", "_x").agg(F.min(F.struct("priority", "name")).alias("_first"))
    first = where.join(sized(places), ["_y", "_x"]).groupBy(*key).agg(F.min("_first")["name"].alias(out))
    name = F.when(F.col(lat).isNull() | F.col(lon).isNull(), F.lit(missing)).otherwise(F.coalesce(out, F.lit(outside)))
    first = first.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(key)})
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)]
    return points.join(first, same, "left").select(*points.columns, name.alias(out))
