"""Grid cells, hexagon cells and neighbour rings by column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numbers import in_range
from tessera.functions.strings import col

# Bounding box and the local projection's origin.
BOX = {"min_lat": 42.2, "max_lat": 42.4, "min_lon": -71.2, "max_lon": -70.9}
ORIGIN_LAT, ORIGIN_LON = 42.3, -71.05
KM_PER_LAT, KM_PER_LON = 110.574, 111.32 * math.cos(math.radians(42.3))
HEX_EDGE_KM = 0.2
RING_WEIGHTS = {0: 1.0, 1: 0.5, 2: 0.2}
# Named boxes (lon_min, lon_max, lat_min, lat_max), first match wins.
DISTRICT_BOXES = {
    "Beacon Hill / North End": (-71.072, -71.050, 42.355, 42.377),
    "Downtown / Back Bay": (-71.082, -71.045, 42.345, 42.365),
    "South End": (-71.093, -71.060, 42.334, 42.360),
    "South Boston": (-71.065, -71.033, 42.330, 42.352),
    "East Boston": (-71.043, -70.998, 42.353, 42.397),
    "Charlestown": (-71.087, -71.050, 42.369, 42.403),
    "Fenway / Kenmore": (-71.118, -71.083, 42.339, 42.362),
    "Brighton / Allston": (-71.158, -71.108, 42.344, 42.373),
    "Jamaica Plain": (-71.128, -71.090, 42.293, 42.328),
    "Roxbury": (-71.103, -71.065, 42.308, 42.343),
    "Dorchester": (-71.082, -71.043, 42.285, 42.340),
    "Mattapan": (-71.107, -71.068, 42.262, 42.302),
    "Hyde Park": (-71.142, -71.083, 42.238, 42.288),
    "West Roxbury": (-71.178, -71.128, 42.268, 42.323),
    "Roslindale": (-71.142, -71.093, 42.274, 42.313),
}


def in_box(lat, lon, box=BOX) -> Column:
    return in_range(lat, box["min_lat"], box["max_lat"]) & in_range(lon, box["min_lon"], box["max_lon"])


def snap(c, size: float = 0.001) -> Column:
    return F.bround(col(c) / size) * size


def grid_key(lat, lon, size: float = 0.001) -> Column:
    return F.format_string("%.3f_%.3f", snap(lat, size), snap(lon, size))


def grid_centre(cell) -> tuple[Column, Column]:
    parts = F.split(col(cell), "_")
    return F.get(parts, 0).cast("double"), F.get(parts, 1).cast("double")


def hex_axial(lat, lon, edge_km: float = HEX_EDGE_KM) -> tuple[Column, Column]:
    """Axial (q, r) of the pointy-top hexagon that holds a point.

    Both fractional coordinates are rounded; what the two roundings leave over then moves the
    coordinate with the larger remainder to the neighbouring hexagon where needed.
    """
    x, y = col(lon) - ORIGIN_LON, col(lat) - ORIGIN_LAT
    q = x * (KM_PER_LON * math.sqrt(3) / 3 / edge_km) - y * (KM_PER_LAT / 3 / edge_km)
    r = y * (KM_PER_LAT * 2 / 3 / edge_km)
    rq, rr = F.floor(q + 0.5), F.floor(r + 0.5)
    dq, dr = q - rq, r - rr
    q_moves = F.abs(dq) >= F.abs(dr)
    return (
        F.when(q_moves, rq + F.floor(dq + dr / 2 + 0.5)).otherwise(rq).cast("int"),
        F.when(q_moves, rr).otherwise(rr + F.floor(dr + dq / 2 + 0.5)).cast("int"),
    )


def hex_id(q, r) -> Column:
    q, r = col(q), col(r)
    return F.when(
        q.isNotNull() & r.isNotNull(), F.concat_ws(":", q.cast("string"), r.cast("string"))
    )


def hex_cell(lat, lon, edge_km: float = HEX_EDGE_KM) -> Column:
    return hex_id(*hex_axial(lat, lon, edge_km))


def ring_offsets(max_ring: int = 2) -> list[tuple[int, int, int]]:
    """(dq, dr, ring) of every cell within ``max_ring`` steps: 1 + 6 + 12 for two rings."""
    span = range(-max_ring, max_ring + 1)
    steps = [(dq, dr, max(abs(dq), abs(dr), abs(dq + dr))) for dq in span for dr in span]
    return sorted((s for s in steps if s[2] <= max_ring), key=lambda s: (s[2], s[0], s[1]))


def ring_array(weights=RING_WEIGHTS) -> Column:
    """Offsets with their ring and weight as a constant array, to explode in place."""
    items = [
        f"named_struct('dq', {dq}, 'dr', {dr}, 'ring', {k}, 'weight', {float(weights[k])}D)"
        for dq, dr, k in ring_offsets(max(weights))
    ]
    return F.expr(f"array({', '.join(items)})")


def total_ring_weight(weights=RING_WEIGHTS) -> float:
    return sum(weights[k] for _, _, k in ring_offsets(max(weights)))


def cell_axes(cell) -> tuple[Column, Column]:
    parts = F.split(col(cell), ":")
    return F.get(parts, 0).try_cast("int"), F.get(parts, 1).try_cast("int")


def wkt_centroid(wkt) -> tuple[Column, Column]:
    """(lat, lon) mean of the vertices of WKT line text; NULL without vertices."""
    number = r"(-?\d+(?:\.\d+)?)"
    lons, lats = (
        F.transform(
            F.regexp_extract_all(col(wkt), F.lit(rf"{number}\s+{number}"), F.lit(i)),
            lambda v: v.try_cast("double"),
        )
        for i in (1, 2)
    )

    def mean(a):
        return F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, v: s + v), F.size(a))

    return mean(lats), mean(lons)


def first_box(lat, lon, boxes=DISTRICT_BOXES, outside="Other", missing="Unknown") -> Column:
    lat, lon = col(lat), col(lon)
    out = F.lit(outside)
    for name, (x0, x1, y0, y1) in reversed(list(boxes.items())):
        out = F.when(lon.between(x0, x1) & lat.between(y0, y1), F.lit(name)).otherwise(out)
    return F.when(lat.isNull() | lon.isNull(), F.lit(missing)).otherwise(out)


def axis_bin(c, lo: float, hi: float, n: int) -> Column:
    """1-based equal-width bin with a closed last bin; NULL outside the range."""
    v = col(c)
    return F.when(v.between(lo, hi), F.least(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(n)), F.lit(n)))
