"""Query registry and the binding of operators to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates, geo, strings
from tessera.session import prepare, scratch_dir
from tessera.sources.layers import LayerStore

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def reg(name: str, fn: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
    if sql is not None:
        ORACLES[name] = sql


def rounded(df: DataFrame, digits: int = 6, skip=()) -> DataFrame:
    """Round every double column, so that summation order cannot show."""
    doubles = {n: F.round(n, digits) for n, t in df.dtypes if t == "double" and n not in skip}
    return df.withColumns(doubles)


def lit_sql(x: float) -> str:
    return f"{x!r}e0" if "e" not in repr(x) else repr(x)


# -- incidents: events as located, weighted incidents ------------------------------------------

RULES = {"ERROR": 3.0, "PURCHASE": 2.0, "SIGNUP": 0.5}
LAT_SQL = "(42.2e0 + ((user_id*37)%200)/1000e0)"
LON_SQL = "(-71.2e0 + ((user_id*91)%300)/1000e0)"


def point(key: str):
    k = F.col(key)
    return F.lit(42.2) + F.pmod(k * 37, F.lit(200)) / 1000.0, F.lit(-71.2) + F.pmod(k * 91, F.lit(300)) / 1000.0


def point_sql(key: str) -> tuple[str, str]:
    return LAT_SQL.replace("user_id", key), LON_SQL.replace("user_id", key)


def hex_sql(lat: str, lon: str) -> str:
    """Subquery-free SQL text of the axial hexagon id."""
    x, y = f"({lon} - ({lit_sql(geo.ORIGIN_LON)}))", f"({lat} - {lit_sql(geo.ORIGIN_LAT)})"
    edge, root = geo.HEX_EDGE_KM, 3**0.5
    q = f"({x}*{lit_sql(geo.KM_PER_LON * root / 3 / edge)} - {y}*{lit_sql(geo.KM_PER_LAT / 3 / edge)})"
    r = f"({y}*{lit_sql(geo.KM_PER_LAT * 2 / 3 / edge)})"
    rq, rr = f"floor({q} + 0.5e0)", f"floor({r} + 0.5e0)"
    dq, dr = f"({q} - {rq})", f"({r} - {rr})"
    moves = f"abs({dq}) >= abs({dr})"
    qq = f"(CASE WHEN {moves} THEN {rq} + floor({dq} + {dr}/2e0 + 0.5e0) ELSE {rq} END)::int"
    rv = f"(CASE WHEN {moves} THEN {rr} ELSE {rr} + floor({dr} + {dq}/2e0 + 0.5e0) END)::int"
    return f"({qq} || ':' || {rv})"


def incidents(t: Tables) -> DataFrame:
    lat, lon = point("user_id")
    ev = t.events
    shooting = F.col("event_type") == "error"
    return ev.select(
        F.col("event_id").alias("incident_number"), F.col("ts").alias("occurred_on_date"),
        F.col("event_type").alias("offense_description"), "value", "user_id", lat.alias("lat"), lon.alias("long"),
        F.hour("ts").alias("hour"), dates.hour_bucket(F.hour("ts")).alias("hour_bucket"),
        dates.day_name("ts").alias("day_of_week"),
        F.concat(F.lit("D"), F.pmod("user_id", F.lit(12)).cast("string")).alias("district"),
        shooting.alias("shooting"), dates.is_weekend("ts").alias("weekend"),
        strings.keyword_weight("event_type", RULES, 1.0, shooting, 2.0).alias("severity_weight"),
        geo.hex_cell(lat, lon).alias("h3_index"),
    )


SEVERITY_SQL = """((CASE WHEN contains(upper(event_type),'ERROR') THEN 3.0e0 WHEN contains(upper(event_type),'PURCHASE') THEN 2.0e0
 WHEN contains(upper(event_type),'SIGNUP') THEN 0.5e0 ELSE 1.0e0 END) * (CASE WHEN event_type='error' THEN 2.0e0 ELSE 1.0e0 END))"""
INC = f"""loc AS (SELECT *, {LAT_SQL} AS lat, {LON_SQL} AS long FROM events),
inc AS (SELECT event_id AS incident_number, ts AS occurred_on_date, event_type AS offense_description, value, user_id, lat, long,
 hour(ts)::int AS hour, (hour(ts)//4)::int AS hour_bucket, dayname(ts) AS day_of_week, 'D' || (user_id%12) AS district,
 event_type='error' AS shooting, isodow(ts) >= 6 AS weekend, {SEVERITY_SQL} AS severity_weight, {hex_sql('lat', 'long')} AS h3_index FROM loc)"""


# -- service requests: orders of customers in nations -------------------------------------------


def requests(t: Tables) -> DataFrame:
    o = t.orders
    place = t.customer.join(F.broadcast(t.nation.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    place = place.select("c_custkey", F.col("n_name").alias("neighborhood"), F.col("c_mktsegment").alias("case_topic"))
    lat, lon = point("o_custkey")
    status = F.when(F.col("o_orderstatus") == "F", "OVERDUE").otherwise("ONTIME")
    return o.join(place, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("case_id"), F.col("o_orderdate").alias("open_date"), status.alias("on_time"),
        F.col("o_orderpriority").alias("reason"), F.col("o_totalprice").alias("amount"), "neighborhood", "case_topic",
        lat.alias("lat"), lon.alias("long"),
    )


_OLAT, _OLON = point_sql("o_custkey")
REQ = f"""req AS (SELECT o_orderkey AS case_id, o_orderdate AS open_date, CASE WHEN o_orderstatus='F' THEN 'OVERDUE' ELSE 'ONTIME' END AS on_time,
 o_orderpriority AS reason, o_totalprice AS amount, n_name AS neighborhood, c_mktsegment AS case_topic, {_OLAT} AS lat, {_OLON} AS long
 FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey)"""


# -- staged layer tables -------------------------------------------------------------------------

_STAGED: dict[tuple[str, str], LayerStore] = {}


def staged(t: Tables) -> LayerStore:
    """Orders as a dated raw layer (one partition per month), written once per application."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _STAGED:
        store = LayerStore(t.spark, scratch_dir(t.spark, "layers"))
        store.write(t.orders.withColumn("dt", F.trunc(F.col("o_orderdate").cast("date"), "MM")), "requests", "raw")
        _STAGED[key] = store
    return _STAGED[key]
