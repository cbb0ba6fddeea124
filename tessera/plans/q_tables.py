"""Queries of the join, aggregation, window, top-k, sampling and set sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import dates, geo, numbers, strings
from tessera.operators import aggregates as agg
from tessera.operators import clean, features, joining, ordering, profile, rolling, routes, sampling
from tessera.plans.q_clean import BIN_LAT, BIN_LON, DAYS, DAYSUM, EVERY, GRID, GRID_LAT, GRID_LON, WEEKS, _bins, _flags
from tessera.plans.registry import INC, REQ, incidents, point, point_sql, reg, requests, rounded, staged

CFG = features.CellConfig()


def as_of(t):
    """Midnight of the newest event day."""
    return joining.constant(t.events, F.date_trunc("DAY", F.max("ts")).cast("timestamp_ntz"))


REF = "ref AS (SELECT date_trunc('day', max(ts))::timestamp AS ref FROM events)"


def _sql_sums(keys: str, src: str = "inc", shift: int = 0) -> str:
    def ws(days, cond="true"):
        return f"coalesce(sum(severity_weight) FILTER (WHERE occurred_on_date >= r - INTERVAL {days} DAY AND {cond}),0)"

    base = "occurred_on_date >= r - INTERVAL 30 DAY"
    upto = "" if not shift else " AND occurred_on_date <= r"
    return f"""SELECT {keys}, {ws(3)} AS weighted_score_3d, {ws(10)} AS weighted_score_10d, {ws(30)} AS weighted_score_30d, {ws(90)} AS weighted_score_90d,
 count(*) FILTER (WHERE {base}) AS incident_count_30d, {ws(30, 'severity_weight >= 5')} AS violent_score_30d, count(*) FILTER (WHERE {base} AND shooting) AS gun_incident_count_30d,
 {ws(30, 'weekend')} AS weekend_30d FROM (SELECT {src}.*, ref - INTERVAL {shift} DAY AS r FROM {src}, ref) WHERE occurred_on_date >= r - INTERVAL 90 DAY{upto} GROUP BY {keys}"""


def _trend(a, b, cap):
    (x, n), (y, m) = a, b
    return f"least(coalesce((weighted_score_{x}d/{n}e0)/nullif(weighted_score_{y}d/{m}e0,0),1e0),{cap}e0)"


TRENDS = f"""{_trend((3, 3), (10, 10), 3.4)} AS trend_3v10, {_trend((10, 10), (30, 30), 3.1)} AS trend_10v30, {_trend((30, 30), (90, 90), 3.1)} AS trend_30v90"""
BUCKET_SQL = f"{INC}, {REF}, b AS ({_sql_sums('h3_index, hour_bucket')})"
CELL_SQL = f"""{BUCKET_SQL}, c AS (SELECT h3_index, sum(weighted_score_3d) AS weighted_score_3d, sum(weighted_score_10d) AS weighted_score_10d, sum(weighted_score_30d) AS weighted_score_30d,
 sum(weighted_score_90d) AS weighted_score_90d, sum(CASE WHEN hour_bucket IN (0,5) THEN weighted_score_30d ELSE 0 END) AS nt, sum(CASE WHEN hour_bucket=4 THEN weighted_score_30d ELSE 0 END) AS ev,
 sum(weekend_30d) AS wk FROM b GROUP BY 1),
ct AS (SELECT h3_index, {TRENDS}, least(coalesce(nt/nullif(weighted_score_30d,0),0),1) AS night_score_ratio, least(coalesce(ev/nullif(weighted_score_30d,0),0),1) AS evening_score_ratio,
 least(coalesce(wk/nullif(weighted_score_30d,0),0),1) AS weekend_score_ratio FROM c)"""


def _bucket_sums(t):
    return features.bucket_sums(incidents(t), as_of(t), CFG)


# -- the flagship: whole cell table ---------------------------------------------------------------


def _cells(t):
    return features.cell_features(incidents(t), as_of(t), CFG, lags_from_events=True)


RING_VALUES = ", ".join(f"({a},{b},{w}e0)" for a, b, w in [(dq, dr, {0: 1.0, 1: 0.5, 2: 0.2}[k]) for dq, dr, k in geo.ring_offsets(2)])
TOTAL_W = "6.4e0"


def _near(src, cols, name):
    sums = ", ".join(f"sum({c}*w)/{TOTAL_W} AS {o}" for o, c in cols.items())
    return f"""{name} AS (SELECT (split_part(h3_index,':',1)::int - dq) || ':' || (split_part(h3_index,':',2)::int - dr) AS h3_index, hour_bucket, {sums} FROM {src}, ring GROUP BY 1, 2)"""


FLAG_COLS = """weighted_score_3d weighted_score_10d weighted_score_30d weighted_score_90d incident_count_30d violent_score_30d gun_incident_count_30d night_score_ratio evening_score_ratio
weekend_score_ratio high_severity_ratio_30d neighbor_weighted_score_30d neighbor_trend_3v10 neighbor_gun_count_30d cell_score_yesterday cell_score_7d_ago neighbor_score_yesterday""".split()
_counts = ("incident_count_30d", "gun_incident_count_30d")
FLAG_SELECT = ", ".join(f"coalesce(f.{c},0) AS {c}" if c in _counts else f"round(coalesce(f.{c},0),6) AS {c}" for c in FLAG_COLS)
FLAGSHIP = f"""WITH {CELL_SQL}, y AS ({_sql_sums('h3_index, hour_bucket', shift=1)}), w7 AS ({_sql_sums('h3_index, hour_bucket', shift=7)}),
ring(dq,dr,w) AS (VALUES {RING_VALUES}),
f0 AS (SELECT b.*, ct.* EXCLUDE (h3_index), least(coalesce(violent_score_30d/nullif(b.weighted_score_30d,0),0),1) AS high_severity_ratio_30d FROM b JOIN ct USING (h3_index)),
{_near('f0', {'neighbor_weighted_score_30d': 'weighted_score_30d', 'neighbor_trend_3v10': 'trend_3v10', 'neighbor_gun_count_30d': 'gun_incident_count_30d'}, 'n1')},
f1 AS (SELECT f0.*, n1.* EXCLUDE (h3_index, hour_bucket), coalesce(y.weighted_score_30d,0) AS cell_score_yesterday, coalesce(w7.weighted_score_30d,0) AS cell_score_7d_ago
 FROM f0 LEFT JOIN n1 USING (h3_index, hour_bucket) LEFT JOIN y USING (h3_index, hour_bucket) LEFT JOIN w7 USING (h3_index, hour_bucket)),
{_near('f1', {'neighbor_score_yesterday': 'cell_score_yesterday'}, 'n2')},
f AS (SELECT f1.*, n2.neighbor_score_yesterday FROM f1 LEFT JOIN n2 USING (h3_index, hour_bucket)),
g AS (SELECT h3_index, bk::int AS hour_bucket FROM (SELECT DISTINCT h3_index FROM f), range(6) r(bk))
SELECT g.h3_index, g.hour_bucket, {FLAG_SELECT}, round(ct.trend_3v10,6) AS trend_3v10, round(ct.trend_10v30,6) AS trend_10v30, round(ct.trend_30v90,6) AS trend_30v90
 FROM g LEFT JOIN f USING (h3_index, hour_bucket) JOIN ct ON ct.h3_index=g.h3_index"""
reg("cell_features_flagship", lambda t: rounded(_cells(t)), FLAGSHIP)

# -- joins ---------------------------------------------------------------------------------------


def _day_split(t):
    inc = incidents(t)
    cut = as_of(t) - F.expr("INTERVAL 7 DAYS")
    return inc.where(F.col("occurred_on_date") < cut), inc.where(F.col("occurred_on_date") >= cut)


DANGER = """dr AS (SELECT h3_index, hour_bucket, sum(severity_weight) AS total_severity, count(DISTINCT occurred_on_date::date) AS days_active, count(incident_number) AS incident_count FROM {src} GROUP BY 1, 2)"""
reg(
    "joi1_features_labels",
    lambda t: rounded(
        joining.left_fill(
            _bucket_sums(t).select("h3_index", "hour_bucket", "weighted_score_30d"),
            features.danger_rate(_day_split(t)[1]).select("h3_index", "hour_bucket", "danger_rate", "incident_count"),
            ["h3_index", "hour_bucket"], {"danger_rate": 0.0, "incident_count": 0},
        )
    ),
    f"""WITH {BUCKET_SQL}, late AS (SELECT inc.* FROM inc, ref WHERE occurred_on_date >= ref - INTERVAL 7 DAY), {DANGER.format(src='late')}
SELECT h3_index, hour_bucket, weighted_score_30d, round(coalesce(total_severity/greatest(days_active,1),0),6) AS danger_rate, coalesce(incident_count,0) AS incident_count FROM b LEFT JOIN dr USING (h3_index, hour_bucket)""",
)
TYPES = ["click", "error", "purchase", "signup", "view"]


def _scores(t):
    return t.events.select(F.to_date("ts").alias("date"), F.col("event_type").alias("metric_name"), F.col("value").alias("day_score"), "ts", "event_id")


LAST = ", ".join(f"arg_max(value, (ts, event_id)) FILTER (WHERE event_type='{x}') AS {x}" for x in TYPES)
CITY = f"SELECT ts::date AS date, round(avg(value),6) AS avg_day_score, {LAST} FROM events GROUP BY 1"
reg("joi2_mean_with_pivot", lambda t: rounded(features.city_score_features(_scores(t), TYPES, ["ts", "event_id"])), CITY)
reg(
    "joi2_long_form",
    lambda t: rounded(features.city_score_rows(_scores(t), ["ts", "event_id"])),
    """WITH d AS (SELECT ts::date AS date, round(avg(value),6) AS avg_day_score FROM events GROUP BY 1)
SELECT date, metric_name, day_score, avg_day_score FROM (SELECT ts::date AS date, event_type AS metric_name, round(arg_max(value, (ts, event_id)),6) AS day_score FROM events GROUP BY 1, 2) JOIN d USING (date)""",
)
reg(
    "joi3_district_lookup",
    lambda t: joining.left_fill(
        _bucket_sums(t).select("h3_index", "hour_bucket"),
        agg.mode(incidents(t).where("severity_weight >= 2"), ["h3_index"], "district"), ["h3_index"], {"district": "UNKNOWN"},
    ),
    f"""WITH {BUCKET_SQL}, m AS (SELECT h3_index, district FROM (SELECT h3_index, district, count(*) AS n FROM inc WHERE severity_weight >= 2 GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY h3_index ORDER BY n DESC, district) = 1) SELECT h3_index, hour_bucket, coalesce(district,'UNKNOWN') AS district FROM b LEFT JOIN m USING (h3_index)""",
)


def _daily_cells(t):
    return incidents(t).groupBy("h3_index", "hour_bucket", F.to_date("occurred_on_date").alias("dt")).agg(F.sum("severity_weight").alias("score"))


DAILY = "d AS (SELECT h3_index, hour_bucket, occurred_on_date::date AS dt, sum(severity_weight) AS score FROM inc GROUP BY 1, 2, 3)"
reg(
    "joi4_date_lags",
    lambda t: joining.lag_by_date(_daily_cells(t), ["h3_index", "hour_bucket"], "dt", "score", {"yesterday": 1, "week_ago": 7}),
    f"""WITH {INC}, {DAILY} SELECT d.*, coalesce(a.score,0) AS yesterday, coalesce(b.score,0) AS week_ago FROM d
 LEFT JOIN d a ON a.h3_index=d.h3_index AND a.hour_bucket=d.hour_bucket AND a.dt=d.dt-1 LEFT JOIN d b ON b.h3_index=d.h3_index AND b.hour_bucket=d.hour_bucket AND b.dt=d.dt-7""",
)
reg(
    "joi5_neighbour_means",
    lambda t: rounded(features.neighbour_means(_bucket_sums(t).select("h3_index", "hour_bucket", "weighted_score_30d"), {"near": "weighted_score_30d"}, CFG)),
    f"""WITH {BUCKET_SQL}, ring(dq,dr,w) AS (VALUES {RING_VALUES}), {_near('b', {'near': 'weighted_score_30d'}, 'n')}
SELECT h3_index, hour_bucket, weighted_score_30d, round(coalesce(near,0),6) AS near FROM b LEFT JOIN n USING (h3_index, hour_bucket)""",
)


def _cell_trends(t):
    return features.trends(features.cell_sums(_bucket_sums(t), CFG), CFG).select("h3_index", *CFG.trend_caps)


reg(
    "joi6_cell_trend_to_buckets",
    lambda t: rounded(_bucket_sums(t).select("h3_index", "hour_bucket").join(_cell_trends(t), "h3_index")),
    f"WITH {CELL_SQL} SELECT h3_index, hour_bucket, round(trend_3v10,6) AS trend_3v10, round(trend_10v30,6) AS trend_10v30, round(trend_30v90,6) AS trend_30v90 FROM b JOIN ct USING (h3_index)",
)


def _errors_by_cell(t):
    return incidents(t).where("shooting").groupBy("h3_index", "hour_bucket").agg(F.count("*").alias("n"))


reg(
    "joi7_densify",
    lambda t: joining.densify(_errors_by_cell(t), "h3_index", "hour_bucket", range(6), {"n": 0}),
    f"""WITH {INC}, e AS (SELECT h3_index, hour_bucket, count(*) AS n FROM inc WHERE shooting GROUP BY 1, 2), g AS (SELECT h3_index, bk::int AS hour_bucket FROM (SELECT DISTINCT h3_index FROM e), range(6) r(bk))
SELECT h3_index, hour_bucket, coalesce(n,0) AS n FROM g LEFT JOIN e USING (h3_index, hour_bucket)""",
)


SCALED = """CASE WHEN max(danger) OVER w > min(danger) OVER w THEN (danger - min(danger) OVER w)/(max(danger) OVER w - min(danger) OVER w)*100e0 ELSE 50e0 END"""
TIER = "CASE WHEN risk_score>=66 THEN 'HIGH' WHEN risk_score>=33 THEN 'MEDIUM' ELSE 'LOW' END"
SCORE_SQL = f"""{INC}, sb AS (SELECT h3_index, hour_bucket, round(sum(value),6) AS danger FROM inc WHERE shooting GROUP BY 1, 2),
s0 AS (SELECT h3_index, hour_bucket, danger, round_even({SCALED}, 2) AS risk_score FROM sb WINDOW w AS (PARTITION BY hour_bucket)), s AS (SELECT *, {TIER} AS risk_tier FROM s0)"""


def score_table(t):
    """Scores from error incidents only, so that some lookups miss."""
    base = incidents(t).where("shooting").groupBy("h3_index", "hour_bucket").agg(F.round(F.sum("value"), 6).alias("danger"))
    return rolling.risk_scores(base, "danger").withColumn("risk_tier", numbers.risk_tier("risk_score"))


reg(
    "joi8_point_scores",
    lambda t: routes.lookup_scores(incidents(t).select("incident_number", "h3_index", "hour_bucket"), score_table(t)),
    f"""WITH {SCORE_SQL} SELECT incident_number, h3_index, hour_bucket, coalesce(risk_score,50) AS risk_score, coalesce(risk_tier,'MEDIUM') AS risk_tier, risk_score IS NOT NULL AS found
 FROM inc LEFT JOIN s USING (h3_index, hour_bucket)""",
)
reg(
    "joi12_semi_top_groups",
    lambda t: joining.semi_top(t.documents.drop("text"), "source", 5),
    "SELECT * EXCLUDE (text) FROM documents WHERE source IN (SELECT source FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 5)",
)
reg(
    "joi13_trailing_window",
    lambda t: incidents(t).groupBy("h3_index").agg(*agg.trailing_counts("occurred_on_date", as_of(t), {"n3": 3, "n10": 10, "n30": 30})),
    f"""WITH {INC}, {REF} SELECT h3_index, count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 3 DAY) AS n3, count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 10 DAY) AS n10,
 count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 30 DAY) AS n30 FROM inc, ref GROUP BY 1""",
)
reg(
    "joi14_other_label",
    lambda t: joining.other_label(t.part.select("p_partkey", "p_brand"), "p_brand", 8, "brand_group"),
    """WITH k AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 8) SELECT p_partkey, p_brand, CASE WHEN p_brand IN (FROM k) THEN p_brand ELSE 'Other' END AS brand_group FROM part""",
)

# -- aggregations --------------------------------------------------------------------------------


def _grid_crime(t):
    inc = incidents(t).withColumn("offense_category", F.when(F.col("offense_description") == "error", "ROBBERY").when(F.col("offense_description") == "view", "larceny").otherwise("other"))
    ref = agg.latest(t.events, "ts")
    return features.grid_features(inc, "occurred_on_date", {"crime_count_7d": 7, "crime_count_30d": 30, "crime_count_90d": 90}, features.crime_measures("occurred_on_date", ref), ref, ("district", "district"))


GRID_CRIME = f"""{INC}, g AS (SELECT *, {GRID} AS grid_cell, (SELECT max(ts) FROM events) AS ref FROM inc),
gm AS (SELECT grid_cell, district FROM (SELECT grid_cell, district, count(*) AS n FROM g GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY grid_cell ORDER BY n DESC, district)=1),
gf AS (SELECT grid_cell, any_value({GRID_LAT}) AS grid_lat, any_value({GRID_LON}) AS grid_long, count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 7 DAY) AS crime_count_7d,
 count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 30 DAY) AS crime_count_30d, count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 90 DAY) AS crime_count_90d,
 count(*) FILTER (WHERE shooting AND occurred_on_date >= ref - INTERVAL 30 DAY) AS shooting_count_30d,
 coalesce(count(*) FILTER (WHERE shooting AND occurred_on_date >= ref - INTERVAL 30 DAY)/nullif(count(*) FILTER (WHERE occurred_on_date >= ref - INTERVAL 30 DAY),0),0) AS shooting_ratio_30d,
 avg((offense_description='error')::int) AS violent_crime_ratio, avg((offense_description='view')::int) AS property_crime_ratio, avg((hour>=20 OR hour<6)::int) AS night_crime_ratio,
 avg(weekend::int) AS weekend_crime_ratio FROM g GROUP BY 1)"""
GRID_COLS = """grid_cell, grid_lat, grid_long, district, crime_count_7d, crime_count_30d, crime_count_90d, shooting_count_30d, round(shooting_ratio_30d,6) AS shooting_ratio_30d, round(violent_crime_ratio,6) AS violent_crime_ratio,
 round(property_crime_ratio,6) AS property_crime_ratio, round(night_crime_ratio,6) AS night_crime_ratio, round(weekend_crime_ratio,6) AS weekend_crime_ratio"""
for name, cols in {
    "agg1_grid_windows": ["crime_count_7d", "crime_count_30d", "crime_count_90d"],
    "agg2_flag_ratio": ["shooting_count_30d", "shooting_ratio_30d"],
    "agg3_category_ratios": ["violent_crime_ratio", "property_crime_ratio"],
    "agg4_time_ratios": ["night_crime_ratio", "weekend_crime_ratio"],
    "agg5_mode_per_group": ["district"],
}.items():
    reg(
        name,
        lambda t, cols=cols: rounded(_grid_crime(t).select("grid_cell", *cols)),
        f"WITH {GRID_CRIME} SELECT grid_cell, {', '.join(cols)} FROM (SELECT {GRID_COLS} FROM gf JOIN gm USING (grid_cell))",
    )
reg(
    "agg6_grid_risk_score",
    lambda t: rounded(features.crime_risk(_grid_crime(t))),
    f"""WITH {GRID_CRIME} SELECT {GRID_COLS}, round(greatest(0,least(1, crime_count_30d/(SELECT nullif(max(crime_count_30d),0) FROM gf)*0.5e0 + violent_crime_ratio*0.3e0 + CASE WHEN shooting_count_30d>0 THEN 0.2e0 ELSE 0 END)),6) AS crime_risk_score
 FROM gf JOIN gm USING (grid_cell)""",
)


def _grid_requests(t):
    r = requests(t)
    ref = agg.latest(t.orders, "o_orderdate")
    overdue = agg.mean_if(F.col("on_time") == "OVERDUE", agg.since("open_date", ref, 30)).alias("overdue_ratio_30d")
    return features.grid_features(r, "open_date", {"request_count_7d": 7, "request_count_30d": 30, "request_count_90d": 90}, [overdue], ref, ("neighborhood", "neighborhood"))


RREF = "(SELECT max(o_orderdate) FROM orders)"
reg(
    "agg7_request_windows",
    lambda t: rounded(_grid_requests(t)),
    f"""WITH {REQ}, g AS (SELECT *, {GRID} AS grid_cell FROM req), m AS (SELECT grid_cell, neighborhood FROM (SELECT grid_cell, neighborhood, count(*) AS n FROM g GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY grid_cell ORDER BY n DESC, neighborhood)=1),
a AS (SELECT grid_cell, any_value({GRID_LAT}) AS grid_lat, any_value({GRID_LON}) AS grid_long, count(*) FILTER (WHERE open_date >= {RREF} - INTERVAL 7 DAY) AS request_count_7d,
 count(*) FILTER (WHERE open_date >= {RREF} - INTERVAL 30 DAY) AS request_count_30d, count(*) FILTER (WHERE open_date >= {RREF} - INTERVAL 90 DAY) AS request_count_90d,
 round(coalesce(avg((on_time='OVERDUE')::int) FILTER (WHERE open_date >= {RREF} - INTERVAL 30 DAY),0),6) AS overdue_ratio_30d FROM g GROUP BY 1) SELECT * FROM a JOIN m USING (grid_cell)""",
)


def _inspections(t):
    lat, lon = point("l_suppkey")
    result = F.when(F.col("l_returnflag") == "R", "HE_Fail").when(F.col("l_returnflag") == "A", "HE_Pass").otherwise("Filed")
    df = t.lineitem.select(F.col("l_shipdate").alias("resultdttm"), result.alias("result"), lat.alias("lat"), lon.alias("long"))
    ref = agg.latest(t.lineitem, "l_shipdate")
    fail, recent = strings.contains_ci("result", "fail"), agg.since("resultdttm", ref, 180)
    measures = [F.count_if(fail & recent).alias("failure_count_180d"), agg.mean_if(fail, recent).alias("failure_ratio_180d")]
    windows = {f"inspection_count_{d}d": d for d in (90, 180, 365)}
    return features.grid_features(df, "resultdttm", windows, measures, ref).withColumn("neighborhood", F.lit("Unknown"))


LREF = "(SELECT max(l_shipdate) FROM lineitem)"
_SL, _SO = point_sql("l_suppkey")
reg(
    "agg8_inspection_windows",
    lambda t: rounded(_inspections(t)),
    f"""WITH p AS (SELECT l_shipdate AS d, l_returnflag='R' AS fail, {_SL} AS lat, {_SO} AS long FROM lineitem), g AS (SELECT *, {GRID} AS grid_cell, {LREF} AS ref FROM p)
SELECT grid_cell, any_value({GRID_LAT}) AS grid_lat, any_value({GRID_LON}) AS grid_long, 'Unknown' AS neighborhood, count(*) FILTER (WHERE d >= ref - INTERVAL 90 DAY) AS inspection_count_90d,
 count(*) FILTER (WHERE d >= ref - INTERVAL 180 DAY) AS inspection_count_180d, count(*) FILTER (WHERE d >= ref - INTERVAL 365 DAY) AS inspection_count_365d,
 count(*) FILTER (WHERE fail AND d >= ref - INTERVAL 180 DAY) AS failure_count_180d, round(coalesce(avg(fail::int) FILTER (WHERE d >= ref - INTERVAL 180 DAY),0),6) AS failure_ratio_180d FROM g GROUP BY 1""",
)
reg(
    "agg9_cell_bucket_windows",
    lambda t: _bucket_sums(t).drop("_weekend_30d", "violent_score_30d", "gun_incident_count_30d"),
    f"WITH {BUCKET_SQL} SELECT * EXCLUDE (weekend_30d, violent_score_30d, gun_incident_count_30d) FROM b",
)
reg("agg10_cell_trends", lambda t: rounded(_cell_trends(t)), f"WITH {CELL_SQL} SELECT h3_index, round(trend_3v10,6) AS trend_3v10, round(trend_10v30,6) AS trend_10v30, round(trend_30v90,6) AS trend_30v90 FROM ct")
reg(
    "agg11_high_severity",
    lambda t: rounded(
        _bucket_sums(t).select("h3_index", "hour_bucket", "violent_score_30d", "gun_incident_count_30d", numbers.capped(numbers.ratio("violent_score_30d", "weighted_score_30d", 0.0), 1.0).alias("high_severity_ratio_30d"))
    ),
    f"WITH {BUCKET_SQL} SELECT h3_index, hour_bucket, violent_score_30d, gun_incident_count_30d, round(least(coalesce(violent_score_30d/nullif(weighted_score_30d,0),0),1),6) AS high_severity_ratio_30d FROM b",
)
reg(
    "agg12_time_of_day_shares",
    lambda t: rounded(features.cell_sums(_bucket_sums(t), CFG).select("h3_index", "night_score_ratio", "evening_score_ratio", "weekend_score_ratio")),
    f"WITH {CELL_SQL} SELECT h3_index, round(night_score_ratio,6) AS night_score_ratio, round(evening_score_ratio,6) AS evening_score_ratio, round(weekend_score_ratio,6) AS weekend_score_ratio FROM ct",
)
reg("agg13_daily_counts", lambda t: rolling.daily(t.events, ["event_type"], "ts"), "SELECT event_type, ts::date AS day, count(*) AS n FROM events GROUP BY 1, 2")
reg(
    "agg14_category_ratio",
    lambda t: rounded(t.lineitem.groupBy("l_suppkey").agg(agg.mean_if(F.col("l_returnflag") == "R").alias("ratio"))),
    "SELECT l_suppkey, round(avg((l_returnflag='R')::int),6) AS ratio FROM lineitem GROUP BY 1",
)
reg("agg15_daily_pivot_last", lambda t: agg.pivot_last(_scores(t), "date", "metric_name", TYPES, "day_score", ["ts", "event_id"]), f"SELECT ts::date AS date, {LAST} FROM events GROUP BY 1")
reg(
    "agg16_danger_rate",
    lambda t: rounded(features.danger_rate(incidents(t))),
    f"WITH {INC}, {DANGER.format(src='inc')} SELECT *, round(total_severity/greatest(days_active,1),6) AS danger_rate FROM dr",
)


def _buildings(t):
    return t.part.select(
        F.col("p_partkey").alias("_id"), "p_type", F.when(F.col("p_size") % 10 != 0, F.col("p_size") * 1000.0).otherwise(0.0).alias("gross_floor_area"),
        F.col("p_retailprice").alias("total_ghg_emissions"), (F.col("p_retailprice") * F.col("p_size")).alias("site_energy_use_kbtu"),
        (F.col("p_size") * 3.41214).alias("electricity_use_grid_purchase"), F.when(F.col("p_type") != "PROMO", F.col("p_size") * 2).alias("energy_star_score"),
    )


BUILD = """bd AS (SELECT p_partkey AS _id, p_type, CASE WHEN p_size%10<>0 THEN p_size*1000e0 ELSE 0 END AS gross_floor_area, p_retailprice AS total_ghg_emissions, p_retailprice*p_size AS site_energy_use_kbtu,
 p_size*3.41214e0 AS electricity_use_grid_purchase, CASE WHEN p_type<>'PROMO' THEN p_size*2 END AS energy_star_score FROM part)"""
reg(
    "agg17_building_features",
    lambda t: rounded(features.building_features(_buildings(t)).select("_id", "emissions_per_sqft", "energy_per_sqft", "electricity_ratio", "high_emitter", "energy_star_category")),
    f"""WITH {BUILD} SELECT _id, round(total_ghg_emissions/nullif(gross_floor_area,0),6) AS emissions_per_sqft, round(site_energy_use_kbtu/nullif(gross_floor_area,0),6) AS energy_per_sqft,
 round(electricity_use_grid_purchase/nullif(site_energy_use_kbtu,0),6) AS electricity_ratio, (total_ghg_emissions >= (SELECT quantile_cont(total_ghg_emissions,0.75) FROM bd))::int AS high_emitter,
 CASE WHEN energy_star_score IS NULL THEN 'Unknown' WHEN energy_star_score>=75 THEN 'High' WHEN energy_star_score>=50 THEN 'Medium' ELSE 'Low' END AS energy_star_category FROM bd""",
)
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _stats_sql(cols, table, body):
    return " UNION ALL ".join(body.format(c=c, t=table) for c in cols)


reg(
    "agg18_column_stats",
    lambda t: rounded(profile.profile(t.lineitem.select(*NUM)).drop("zeros", "q1", "q3"), 4),
    _stats_sql(NUM, "lineitem", """SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present, count(*)-count({c}) AS missing, 0e0 AS missing_ratio, round(avg({c}),4) AS mean, round(stddev_samp({c}),4) AS std,
 min({c}) AS min, max({c}) AS max, round(median({c}),4) AS median, count(DISTINCT {c}) AS "distinct" FROM {t}"""),
)
reg(
    "agg19_value_counts",
    lambda t: rounded(agg.value_counts(t.documents, "source")),
    "SELECT source, count(*) AS n, round(count(*)/(SELECT count(source) FROM documents),6) AS share FROM documents GROUP BY 1",
)
PRIO = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
XT = ", ".join(f"""count(*) FILTER (WHERE o_orderpriority='{p}') AS "o_orderpriority_{p}" """ for p in PRIO)
reg("agg20_crosstab", lambda t: agg.crosstab(t.orders, "o_orderstatus", "o_orderpriority", PRIO), f"SELECT o_orderstatus, {XT} FROM orders GROUP BY 1")
XS = ", ".join(f"""round(count(*) FILTER (WHERE o_orderpriority='{p}')/count(*),6) AS "o_orderpriority_{p}" """ for p in PRIO)
reg("agg20_crosstab_shares", lambda t: rounded(agg.crosstab(t.orders, "o_orderstatus", "o_orderpriority", PRIO, shares=True)), f"SELECT o_orderstatus, {XS} FROM orders GROUP BY 1")
reg(
    "agg21_pivot_mean",
    lambda t: rounded(agg.pivot_mean(t.lineitem, "l_returnflag", "l_linestatus", ["O", "F"], "l_extendedprice")),
    """SELECT l_returnflag, round(avg(l_extendedprice) FILTER (WHERE l_linestatus='O'),6) AS "l_linestatus_O", round(avg(l_extendedprice) FILTER (WHERE l_linestatus='F'),6) AS "l_linestatus_F" FROM lineitem GROUP BY 1""",
)
reg(
    "agg22_group_table",
    lambda t: rounded(agg.group_table(t.lineitem, ["l_suppkey"], "l_extendedprice"), 4),
    "SELECT l_suppkey, count(*) AS n, round(sum(l_extendedprice),4) AS total, round(avg(l_extendedprice),4) AS mean, round(median(l_extendedprice),4) AS median FROM lineitem GROUP BY 1",
)
reg(
    "agg23_disparity",
    lambda t: rounded(agg.disparity(t.documents.groupBy("source").agg(F.avg("n_chars").alias("m")), "m")),
    "WITH g AS (SELECT avg(n_chars) AS m FROM documents GROUP BY source) SELECT round(max(m),6) AS highest, round(min(m),6) AS lowest, round(max(m)/min(m),6) AS ratio, round(max(m)-min(m),6) AS gap FROM g",
)
reg(
    "agg24_variation",
    lambda t: rounded(agg.variation(t.events.groupBy("event_type").agg(F.avg("value").alias("m")), "m")),
    """WITH g AS (SELECT avg(value) AS m FROM events GROUP BY event_type), c AS (SELECT stddev_samp(m)/avg(m) AS cv FROM g) SELECT round(cv,6) AS cv, CASE WHEN cv>0.3 THEN 'high' WHEN cv<0.15 THEN 'acceptable' ELSE 'moderate' END AS rating FROM c""",
)
reg(
    "agg25_empty_cross_slices",
    lambda t: agg.groups_without(t.orders, "o_custkey", "o_orderstatus", "F"),
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus='F')=0",
)
reg(
    "agg26_grid_coverage",
    lambda t: rounded(agg.grid_coverage(_bins(t), "row", "col", 29 * 29)),
    f"""WITH {INC}, b AS (SELECT {BIN_LAT} AS r, {BIN_LON} AS c FROM inc), n AS (SELECT r, c, count(*) AS n FROM b WHERE r IS NOT NULL AND c IS NOT NULL GROUP BY 1, 2)
SELECT count(*) AS populated, round(count(*)/841.0,6) AS coverage, round(avg(n),6) AS mean_count, max(n) AS max_count, 841-count(*) AS empty FROM n""",
)
reg(
    "agg27_describe",
    lambda t: rounded(agg.describe(t.lineitem, NUM, {"p05": 0.05, "p50": 0.5, "p95": 0.95}), 4),
    _stats_sql(NUM, "lineitem", """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}),4) AS mean, round(stddev_samp({c}),4) AS std, min({c}) AS min, max({c}) AS max, round(skewness({c}),4) AS skewness,
 round(kurtosis({c}),4) AS kurtosis, round(quantile_cont({c},0.05),4) AS p05, round(quantile_cont({c},0.5),4) AS p50, round(quantile_cont({c},0.95),4) AS p95 FROM {t}"""),
)
PAIRS = [(a, b) for i, a in enumerate(NUM) for b in NUM[i + 1 :]]
reg(
    "agg28_correlations",
    lambda t: rounded(agg.correlations(t.lineitem, NUM).orderBy(F.desc(F.abs("r"))).limit(10)),
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a},{b}),6) AS r FROM lineitem" for a, b in PAIRS),
)
reg(
    "agg29_wide_shares",
    lambda t: rounded(agg.wide_shares(t.lineitem, ["l_returnflag"], NUM[:3]), 4),
    " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS attribute, round(sum({c}),4) AS amount, round(sum({c})/(sum(l_quantity)+sum(l_extendedprice)+sum(l_discount)),4) AS share FROM lineitem GROUP BY 1" for c in NUM[:3]),
)
reg(
    "agg30_trend_percentiles",
    lambda t: rounded(ordering.quantiles(_cell_trends(t).where("trend_3v10 <> 1.0"), [], "trend_3v10", {f"p{p}": p / 100 for p in (75, 90, 95, 99)})),
    f"WITH {CELL_SQL} SELECT " + ", ".join(f"round(quantile_cont(trend_3v10,{p / 100}),6) AS p{p}" for p in (75, 90, 95, 99)) + " FROM ct WHERE trend_3v10 <> 1.0",
)
reg(
    "agg31_daily_summary",
    lambda t: rounded(agg.daily_summary(t.events, "ts")),
    "WITH d AS (SELECT ts::date AS d, count(*) AS n FROM events GROUP BY 1) SELECT count(*) AS days, round(avg(n),6) AS mean_per_day, min(n) AS min_per_day, max(n) AS max_per_day FROM d",
)
reg(
    "agg32_score_summary",
    lambda t: rounded(agg.score_summary(score_table(t))),
    f"""WITH {SCORE_SQL} SELECT count(*) AS rows, count(DISTINCT h3_index) AS cells, round(avg(risk_score),6) AS mean_score, count(*) FILTER (WHERE risk_tier='LOW') AS tier_low,
 count(*) FILTER (WHERE risk_tier='MEDIUM') AS tier_medium, count(*) FILTER (WHERE risk_tier='HIGH') AS tier_high, round(median(risk_score),6) AS median_score FROM s""",
)
reg(
    "agg33_weekend_gap",
    lambda t: rounded(agg.weekend_gap(t.events, "event_type", "ts", "value")),
    """WITH g AS (SELECT event_type, avg(value) FILTER (WHERE isodow(ts)<6) AS a, avg(value) FILTER (WHERE isodow(ts)>=6) AS b FROM events GROUP BY 1)
SELECT event_type, round(a,6) AS weekday_mean, round(b,6) AS weekend_mean, round(abs(b-a)*100/abs(a),6) AS gap_pct, abs(b-a)*100/abs(a) > 10 AS flagged FROM g""",
)
reg(
    "agg_schedule_features",
    lambda t: features.category_code(features.schedule_features(_flags(t), WEEKS, DAYS), "district", "district_code").select("p_partkey", "district", "is_every_week", "sweep_days_count", "tow_enforced", "season_start_month", "season_end_month", "active_months_count", "district_code"),
    f"""SELECT p_partkey, p_brand AS district, {EVERY} AS is_every_week, {DAYSUM} AS sweep_days_count, 1 AS tow_enforced, 4 AS season_start_month, 11 AS season_end_month, 8 AS active_months_count, (dense_rank() OVER (ORDER BY p_brand)-1)::int AS district_code FROM part""",
)

# -- windows -------------------------------------------------------------------------------------

DAYN = "d AS (SELECT event_type, ts::date AS day, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1, 2)"
reg(
    "win1_rolling_count_rows",
    lambda t: rolling.rolling_count(t.events, ["event_type"], "ts", 7, "n7"),
    f"WITH {DAYN} SELECT event_type, day, sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING)::bigint AS n7 FROM d",
)
reg(
    "win1_rolling_count_days",
    lambda t: rolling.rolling_count_days(t.orders, ["o_custkey"], "o_orderdate", 30, "n30"),
    """WITH d AS (SELECT o_custkey, o_orderdate::date AS day, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, day, sum(n) OVER (PARTITION BY o_custkey ORDER BY day RANGE INTERVAL 29 DAY PRECEDING)::bigint AS n30 FROM d""",
)
reg(
    "win2_rolling_mean",
    lambda t: rounded(rolling.rolling_mean(t.events, ["event_type"], "ts", "value", 7, "mean7")),
    f"WITH {DAYN} SELECT event_type, day, round(avg(mean) OVER (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING),6) AS mean7 FROM d",
)
reg(
    "win3_minmax",
    lambda t: rounded(rolling.minmax(t.events.select("event_id", "value"), "value", "scaled")),
    "SELECT event_id, value, round((value-(SELECT min(value) FROM events))/(SELECT max(value)-min(value) FROM events),6) AS scaled FROM events",
)
reg(
    "win4_zscore",
    lambda t: rounded(rolling.zscore(t.events.select("event_id", "value"), "value", "z")),
    "SELECT event_id, value, round((value-(SELECT avg(value) FROM events))/(SELECT stddev_samp(value) FROM events),6) AS z FROM events",
)


def _danger(t):
    return incidents(t).groupBy("h3_index", "hour_bucket").agg(F.round(F.sum("value"), 6).alias("danger"))


DNG = f"{INC}, dg AS (SELECT h3_index, hour_bucket, round(sum(value),6) AS danger FROM inc GROUP BY 1, 2)"
reg(
    "win5_scores_per_bucket",
    lambda t: rolling.risk_scores(_danger(t), "danger"),
    f"WITH {DNG} SELECT *, round_even({SCALED},2) AS risk_score FROM dg WINDOW w AS (PARTITION BY hour_bucket)",
)
reg(
    "win6_scores_global",
    lambda t: rolling.risk_scores(_danger(t), "danger", per_bucket=False),
    f"WITH {DNG}, m AS (SELECT min(danger) AS lo, max(danger) AS hi FROM dg) SELECT dg.*, round_even((danger-lo)/(hi-lo)*100e0,2) AS risk_score FROM dg, m",
)
reg(
    "win7_zscore_in_group",
    lambda t: rounded(rolling.zscore_by(t.part.select("p_partkey", "p_type", "p_retailprice"), ["p_type"], "p_retailprice", "z")),
    """WITH g AS (SELECT p_type, avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS s FROM part GROUP BY 1) SELECT p_partkey, p_type, p_retailprice, round((p_retailprice-m)/s,6) AS z FROM part JOIN g USING (p_type)""",
)
reg(
    "win9_last_turns",
    lambda t: routes.last_turns(t.conversations, "conv_id", "turn", 2),
    "SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4",
)
THIRDS = {"train": 0.7, "validation": 0.15, "test": 0.15}
reg(
    "win10_time_split",
    lambda t: sampling.time_split(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", THIRDS),
    """WITH r AS (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS i, (SELECT count(*) FROM orders) AS n FROM orders)
SELECT o_orderkey, o_orderdate, CASE WHEN i <= floor(0.7*n) THEN 'train' WHEN i <= floor(0.85*n) THEN 'validation' ELSE 'test' END AS split FROM r""",
)

# -- top-k, samples, splits ----------------------------------------------------------------------


def hash_sql(key: str) -> str:
    return f"((({key} % 2147483648) * 2654435761) % 4294967296)"


reg("top1_top_values", lambda t: agg.top_values(t.documents, "source", 5), "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 5")
reg(
    "smp1_capped_sample",
    lambda t: sampling.sample_rows(t.events, "event_id", 1000),
    f"SELECT * FROM events ORDER BY {hash_sql('event_id')}, event_id LIMIT 1000",
)
reg(
    "smp2_baseline_sample",
    lambda t: rounded(profile.training_baseline(sampling.sample_rows(t.lineitem.withColumn("k", F.col("l_orderkey") * 8 + F.col("l_linenumber")).dropDuplicates(["k"]).select("k", "l_linenumber"), "k", 10000), ["l_linenumber"])),
    f"""WITH s AS (SELECT k, l_linenumber FROM (SELECT DISTINCT l_orderkey*8+l_linenumber AS k, l_linenumber FROM lineitem) ORDER BY {hash_sql('k')}, k LIMIT 10000)
SELECT 'l_linenumber' AS "column", round(avg(l_linenumber),6) AS mean, round(stddev_samp(l_linenumber),6) AS std, min(l_linenumber)::double AS min, quantile_cont(l_linenumber,0.25) AS p25, median(l_linenumber) AS p50,
 quantile_cont(l_linenumber,0.75) AS p75, max(l_linenumber)::double AS max, 0e0 AS null_pct FROM s""",
)
reg(
    "smp3_hash_split",
    lambda t: sampling.hash_split(t.orders.select("o_orderkey"), "o_orderkey"),
    f"SELECT o_orderkey, CASE WHEN {hash_sql('o_orderkey')} % 100 < 80 THEN 'train' ELSE 'validation' END AS split FROM orders",
)
reg(
    "smp4_stratified_split",
    lambda t: sampling.stratified_split(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", {"train": 0.8, "test": 0.2}),
    f"""WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, o_orderpriority, CASE WHEN i <= floor(0.8*n) THEN 'train' ELSE 'test' END AS split FROM r""",
)
reg(
    "top4_newest_runs",
    lambda t: t.orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("run")).agg(F.count("*").alias("rows")).orderBy(F.desc("run")).limit(10),
    "SELECT date_trunc('month',o_orderdate)::date AS run, count(*) AS rows FROM orders GROUP BY 1 ORDER BY run DESC LIMIT 10",
)

# -- sets ----------------------------------------------------------------------------------------

reg(
    "set1_union_partitions",
    lambda t: sampling.union_samples([staged(t).partition("requests", "raw", d).select("o_orderkey", "dt") for d in ("1996-01-01", "1996-02-01")] + [staged(t).partition("requests", "raw", "1996-03-01").select("o_orderkey", "dt", "o_orderstatus")]),
    """SELECT o_orderkey, date_trunc('month',o_orderdate)::date AS dt, CASE WHEN month(o_orderdate)=3 THEN o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-04-01'""",
)
reg(
    "set5_duplicate_rows",
    lambda t: rounded(profile.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])),
    """WITH d AS (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT sum(c)::bigint AS rows, (sum(c)-count(*))::bigint AS duplicates, round((sum(c)-count(*))/sum(c),6) AS duplicate_ratio FROM d""",
)
reg(
    "clean_requests_daily",
    lambda t: clean.keep_existing(requests(t).withColumns({"day": F.to_date("open_date"), "period": dates.day_period(F.hour("open_date"))}), ["case_id", "day", "period", "neighborhood"]),
    f"WITH {REQ} SELECT case_id, open_date::date AS day, 'Night' AS period, neighborhood FROM req",
)
