"""Queries of the contract, profile, anomaly and drift sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import dates
from tessera.operators import drift, profile, quality, stat_tests
from tessera.operators.profile_state import RANK_ERROR, frequent
from tessera.plans.q_tables import SCORE_SQL, score_table
from tessera.plans.registry import INC, LAT_SQL, LON_SQL, incidents, reg, rounded
from tessera.session import scratch_dir
from tessera.sources import state


def findings(df):
    return rounded(df.select(*quality.FINDING))


# -- dirty inputs derived from the tables --------------------------------------------------------


def dirty(t):
    """Events with sparse text, blanks, stray coordinates and misplaced times."""
    e = t.events
    lat, lon = (F.when(F.col("event_type") == "error", c + 1).otherwise(c) for c in _point())
    zero = F.col("value") < 0.5
    return e.select(
        "event_id", "user_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"),
        F.when(F.col("event_type") == "view", F.lit(" ")).when(F.col("event_type").isin("click", "error", "signup"), F.lit(None)).otherwise(F.col("props")).alias("note"),
        "value", F.when(zero, 0.0).otherwise(lat).alias("lat"), F.when(zero, 0.0).otherwise(lon).alias("long"), F.col("ts").alias("event_time"),
    )


def _point():
    from tessera.plans.registry import point

    return point("user_id")


DIRTY = f"""dt AS (SELECT event_id, user_id, CASE WHEN event_type<>'click' THEN event_type END AS kind,
 CASE WHEN event_type='view' THEN ' ' WHEN event_type IN ('click','error','signup') THEN NULL ELSE props END AS note, value,
 CASE WHEN value<0.5 THEN 0e0 WHEN event_type='error' THEN {LAT_SQL}+1 ELSE {LAT_SQL} END AS lat, CASE WHEN value<0.5 THEN 0e0 WHEN event_type='error' THEN {LON_SQL}+1 ELSE {LON_SQL} END AS long, ts AS event_time FROM events)"""
BADLAT, BADLON = "(lat < 42.2e0 OR lat > 42.4e0)", "(long < -71.2e0 OR long > -70.9e0)"
AS_OF = "2024-01-20"


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def finding_sql(rule, severity, feature, cond, src="dt", having="n > 0"):
    return f"SELECT '{rule}' AS rule, '{severity}' AS severity, '{feature}' AS feature, count(*) FILTER (WHERE {cond}) AS n, round(count(*) FILTER (WHERE {cond})/count(*),6) AS ratio FROM {src} HAVING {having.replace('n >', f'count(*) FILTER (WHERE {cond}) >')}"


CONTRACT = {
    "event_id": {"type": "integer", "nullable": False},
    "kind": {"type": "string", "nullable": False, "enum": ["error", "view", "signup"]},
    "value": {"type": "number", "minimum": 1.0, "maximum": 300.0},
    "event_time": {"type": "string"},
    "absent": {"type": "string"},
}
CONTRACT_SQL = " UNION ALL ".join(
    [
        "SELECT 'type_mismatch' AS rule, 'error' AS severity, 'event_time' AS feature, 0 AS n, 0e0 AS ratio",
        "SELECT 'missing_column', 'error', 'absent', 0, 0e0",
        finding_sql("null_in_required", "error", "kind", "kind IS NULL"),
        finding_sql("not_in_enum", "warning", "kind", "kind NOT IN ('error','view','signup')"),
        finding_sql("below_minimum", "warning", "value", "value < 1"),
        finding_sql("above_maximum", "warning", "value", "value > 300"),
    ]
)
reg("qua1_contract_findings", lambda t: findings(quality.contract_findings(dirty(t), CONTRACT)), f"WITH {DIRTY} {CONTRACT_SQL}")
reg(
    "qua2_raw_gate",
    lambda t: findings(quality.raw_gate(dirty(t).drop("event_id", "event_time", "user_id"), {"kind": {"type": "string"}}, 100, {"kind": 0.1}, 0.25, 0.0)),
    f"""WITH {DIRTY}, dd AS (SELECT count(*) AS c FROM dt GROUP BY kind, note, value, lat, long) SELECT 'null_ratio' AS rule, 'error' AS severity, 'kind' AS feature, count(*) FILTER (WHERE kind IS NULL) AS n, round(avg((kind IS NULL)::int),6) AS ratio FROM dt HAVING avg((kind IS NULL)::int) > 0.1
UNION ALL SELECT 'null_ratio', 'error', 'note', count(*) FILTER (WHERE note IS NULL), round(avg((note IS NULL)::int),6) FROM dt HAVING avg((note IS NULL)::int) > 0.25
UNION ALL SELECT 'duplicate_ratio', 'warning', '__all__', (sum(c)-count(*))::bigint, round((sum(c)-count(*))/sum(c),6) FROM dd HAVING sum(c) > count(*)""",
)
TIME_SQL = f"""{finding_sql('future_dates', 'warning', 'event_time', f"event_time > TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY")} UNION ALL {finding_sql('old_dates', 'info', 'event_time', f"event_time < TIMESTAMP '{AS_OF}' - INTERVAL 3650 DAY")}"""
GEO_SQL = f"{finding_sql('latitude_bounds', 'warning', 'lat', BADLAT)} UNION ALL {finding_sql('longitude_bounds', 'warning', 'long', BADLON)}"
reg(
    "qua3_processed_gate",
    lambda t: findings(quality.processed_gate(dirty(t), {"event_id": {"type": "integer"}}, _as_of(), 1_000_000_000)),
    f"WITH {DIRTY} SELECT 'min_rows' AS rule, 'error' AS severity, '__all__' AS feature, count(*) AS n, 0e0 AS ratio FROM dt HAVING count(*) < 1000000000 UNION ALL {GEO_SQL} UNION ALL {TIME_SQL}",
)
reg(
    "qua4_features_gate",
    lambda t: findings(quality.features_gate(t.lineitem.select("l_quantity", F.when(F.col("l_tax") == 0, float("inf")).otherwise(F.col("l_tax")).alias("rate"), F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("discount")), {"rate": {"type": "number"}})),
    f"""WITH dt AS (SELECT l_tax, CASE WHEN l_discount>0.02 THEN l_discount END AS discount FROM lineitem) {finding_sql('null_ratio', 'error', 'discount', 'discount IS NULL', having='count(*) FILTER (WHERE discount IS NULL)/count(*) > 0.25')} UNION ALL {finding_sql('infinite_values', 'error', 'rate', 'l_tax=0')}""",
)
reg("qua6_geo_bounds", lambda t: findings(quality.geo_bounds(dirty(t))), f"WITH {DIRTY} {GEO_SQL}")
reg("qua7_time_bounds", lambda t: findings(quality.time_bounds(dirty(t), _as_of())), f"WITH {DIRTY} {TIME_SQL}")
reg(
    "qua9_cell_raw_gate",
    lambda t: findings(quality.cell_raw_gate(dirty(t), ["event_id", "absent"], "user_id", skip=["kind"])),
    f"""WITH {DIRTY} SELECT 'missing_column' AS rule, 'error' AS severity, 'absent' AS feature, 0 AS n, 0e0 AS ratio
UNION ALL {finding_sql('null_or_blank', 'error', 'note', "(note IS NULL OR trim(note)='')", having="count(*) FILTER (WHERE note IS NULL OR trim(note)='')/count(*) > 0.25")}
UNION ALL SELECT 'duplicate_ratio', 'warning', '__all__', count(*)-count(DISTINCT user_id), round((count(*)-count(DISTINCT user_id))/count(*),6) FROM dt HAVING count(*) > count(DISTINCT user_id)""",
)
reg(
    "qua10_cell_processed_gate",
    lambda t: findings(
        quality.cell_processed_gate(incidents(t).select(F.lit(None).cast("string").alias("h3_index"), (F.col("hour_bucket") + F.when(F.col("shooting"), 3).otherwise(0)).alias("hour_bucket"), (F.col("severity_weight") - 1).alias("severity_weight")))
    ),
    f"""WITH {INC}, dt AS (SELECT hour_bucket + CASE WHEN shooting THEN 3 ELSE 0 END AS hour_bucket, severity_weight-1 AS severity_weight FROM inc)
SELECT 'all_cells_null' AS rule, 'error' AS severity, 'h3_index' AS feature, count(*) AS n, 1e0 AS ratio FROM dt UNION ALL {finding_sql('bucket_range', 'error', 'hour_bucket', 'hour_bucket NOT BETWEEN 0 AND 5')}
UNION ALL {finding_sql('severity_positive', 'error', 'severity_weight', 'severity_weight <= 0')}""",
)
reg(
    "qua11_cell_features_gate",
    lambda t: findings(quality.cell_features_gate(score_table(t).withColumn("risk_score", F.col("risk_score") * 1.5), 1_000_000)),
    f"""WITH {SCORE_SQL}, dt AS (SELECT h3_index, risk_score*1.5 AS risk_score FROM s) SELECT 'min_cells' AS rule, 'error' AS severity, 'h3_index' AS feature, count(DISTINCT h3_index) AS n, 0e0 AS ratio FROM dt
UNION ALL {finding_sql('score_bounds', 'error', 'risk_score', 'risk_score < 0 OR risk_score > 100')}""",
)
DEFS = [("l_quantity", 5.0, 45.0), ("l_discount", 0.0, 0.2), ("l_tax", None, 0.05)]
reg(
    "qua12_feature_ranges",
    lambda t: profile.feature_ranges(t.lineitem, DEFS),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*)-count({c}) AS missing, min({c}) AS min, max({c}) AS max, {f'min({c}) < {a}' if a is not None else 'false'} AS below_min, max({c}) > {b} AS above_max FROM lineitem"""
        for c, a, b in DEFS
    ),
)
reg(
    "qua13_contract_of_table",
    lambda t: quality.contract_of(dirty(t)),
    """SELECT * FROM (VALUES ('event_id','integer',false),('user_id','integer',false),('kind','string',true),('note','string',true),('value','number',false),('lat','number',false),('long','number',false),('event_time','datetime',false)) v("column", type, nullable)""",
)


def _registry(t):
    v1 = state.register_contract(None, quality.contract_of(t.events), "events", "raw", 1)
    return state.register_contract(v1, quality.contract_of(dirty(t)), "events", "raw", 2)


reg(
    "qua13_contract_versions",
    lambda t: state.contract_versions(_registry(t)).join(
        state.latest_contract(_registry(t), "events", "raw").select("version").distinct().withColumn("latest", F.lit(True)), "version", "left"
    ),
    "SELECT * FROM (VALUES (1,'events','raw',6,NULL),(2,'events','raw',8,true)) v(version, dataset, layer, columns, latest)",
)



#: Contracts as their files state them: by dataset and layer, for tables that orders and customers stand for.
SCHEMAS = {
    ("requests", "raw"): {
        "required": ["o_orderkey", "o_orderdate", "o_channel"],
        "properties": {
            "o_orderkey": {"type": "integer", "primary_key": True}, "o_orderdate": {"type": "string", "format": "date-time", "watermark_field": True},
            "o_orderstatus": {"type": "string", "enum": ["F", "O"]}, "o_totalprice": {"type": "number", "minimum": 1000, "maximum": 400000},
            "o_orderpriority": {"type": "string", "pattern": "^[1-4]-"}, "o_channel": {"type": "string"},
        },
    },
    ("requests", "processed"): {"required": ["o_custkey"], "properties": {"o_custkey": {"type": ["integer", "null"], "null_ratio_threshold": 0.2}}, "additionalProperties": False},
    ("people", "raw"): {"required": ["c_custkey"], "properties": {"c_custkey": {"type": "integer"}, "c_acctbal": {"type": ["number", "null"], "minimum": 0}}},
    ("people", "features"): {"required": ["c_custkey"], "properties": {"c_custkey": {"type": "integer"}}},
}


def _contract_files(t):
    """Contract files written, read and held against the tables of their layers."""
    import json

    from tessera.sources import contracts

    folder = scratch_dir(t.spark, "schemas")
    for (dataset, layer), schema in SCHEMAS.items():
        p = t.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{dataset}/{layer}_schema.json")
        file = p.getFileSystem(t.spark._jsc.hadoopConfiguration()).create(p, True)
        file.writeBytes(json.dumps(schema))
        file.close()
    o = t.orders
    late = o.where(F.col("o_orderstatus") == "F").select(F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    tables = {("requests", "raw"): o, ("requests", "processed"): late, ("people", "raw"): t.customer, ("places", "raw"): t.nation}
    return rounded(contracts.layer_findings(contracts.load(t.spark, folder), tables))


def _layer_sql(dataset, layer, sql):
    return f"SELECT '{dataset}' AS dataset, '{layer}' AS layer, * FROM ({sql})"


reg(
    "qua1_contract_files",
    _contract_files,
    "WITH lt AS (SELECT CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS o_custkey FROM orders WHERE o_orderstatus='F') "
    + " UNION ALL ".join([
        *[_layer_sql("requests", "raw", x) for x in (
            "SELECT 'missing_column' AS rule, 'error' AS severity, 'o_channel' AS feature, 0 AS n, 0e0 AS ratio",
            finding_sql("not_in_enum", "warning", "o_orderstatus", "o_orderstatus NOT IN ('F','O')", "orders"),
            finding_sql("below_minimum", "warning", "o_totalprice", "o_totalprice < 1000", "orders"),
            finding_sql("above_maximum", "warning", "o_totalprice", "o_totalprice > 400000", "orders"),
            finding_sql("pattern_mismatch", "warning", "o_orderpriority", "NOT regexp_matches(o_orderpriority, '^[1-4]-')", "orders"))],
        *[_layer_sql("requests", "processed", x) for x in (
            "SELECT 'extra_column' AS rule, 'error' AS severity, 'o_totalprice' AS feature, 0 AS n, 0e0 AS ratio",
            finding_sql("null_ratio", "warning", "o_custkey", "o_custkey IS NULL", "lt", "n > 0.2 * count(*)"))],
        _layer_sql("people", "raw", finding_sql("below_minimum", "warning", "c_acctbal", "c_acctbal < 0", "customer")),
        "SELECT 'people', 'features', 'missing_table', 'error', '__all__', 0, 0e0", "SELECT 'places', 'raw', 'no_contract', 'warning', '__all__', 0, 0e0"]),
)

# -- profiles ------------------------------------------------------------------------------------

NUM = ["l_quantity", "l_extendedprice", "l_discount"]


def profile_sql(table, cols, digits=4, where="true"):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present, count(*)-count({c}) AS missing, round((count(*)-count({c}))/count(*),{digits}) AS missing_ratio, round(avg({c}),{digits}) AS mean,
 round(stddev_samp({c}),{digits}) AS std, min({c})::double AS min, max({c})::double AS max, count(*) FILTER (WHERE {c}=0) AS zeros, count(DISTINCT {c}) AS "distinct", round(quantile_cont({c}::double,0.25),{digits}) AS q1,
 round(quantile_cont({c}::double,0.5),{digits}) AS median, round(quantile_cont({c}::double,0.75),{digits}) AS q3 FROM {table} WHERE {where}"""
        for c in cols
    )


def text_profile_sql(table, cols, digits=4, where="true"):
    nulls = ", ".join(f"NULL::double AS {m}" for m in ("mean", "std", "min", "max"))
    quart = ", ".join(f"NULL::double AS {m}" for m in ("q1", "median", "q3"))
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present, count(*)-count({c}) AS missing, round((count(*)-count({c}))/count(*),{digits}) AS missing_ratio, {nulls}, NULL::bigint AS zeros,
 count(DISTINCT {c}) AS "distinct", {quart} FROM {table} WHERE {where}"""
        for c in cols
    )


reg(
    "pro1_column_profile",
    lambda t: rounded(profile.profile(dirty(t).select("value", "user_id", "kind", "note")), 4),
    f"WITH {DIRTY} {profile_sql('dt', ['value', 'user_id'])} UNION ALL {text_profile_sql('dt', ['kind', 'note'])}",
)
reg(
    "pro1_top_values",
    lambda t: profile.top_values(dirty(t), 10, ["kind", "note", "user_id"]),
    f"""WITH {DIRTY}, v AS (SELECT 'kind' AS "column", kind AS value FROM dt UNION ALL SELECT 'note', note FROM dt UNION ALL SELECT 'user_id', user_id::varchar FROM dt),
c AS (SELECT "column", value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2) SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c QUALIFY rank <= 10""",
)


def _halves(t):
    cut = F.lit("1998-04-01").cast("timestamp_ntz")
    o = t.orders.select("o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate")
    cur, ref = o.where(F.col("o_orderdate") >= cut), o.where(F.col("o_orderdate") < cut)
    cur = cur.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 1.5).otherwise(F.col("o_totalprice")))
    return cur.drop("o_orderdate"), ref.drop("o_orderdate")


HALVES = """cur AS (SELECT CASE WHEN o_orderstatus='F' THEN o_totalprice*1.5e0 ELSE o_totalprice END AS o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-01'),
rf AS (SELECT o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-01')"""
_C, _R = (f"({profile_sql(x, ['o_totalprice'], 9)} UNION ALL {text_profile_sql(x, ['o_orderstatus', 'o_orderpriority'], 9)})" for x in ("cur", "rf"))
reg(
    "pro2_compare_profiles",
    lambda t: rounded(profile.compare(*[profile.profile(h) for h in _halves(t)]), 4),
    f"""WITH {HALVES}, c AS {_C}, r AS {_R} SELECT "column", true AS in_current, true AS in_reference, c.rows-r.rows AS rows_change, round((c.rows-r.rows)*100/r.rows,4) AS rows_change_pct, round(c.missing_ratio-r.missing_ratio,4) AS missing_ratio_change,
 round(c.mean-r.mean,4) AS mean_change, round(c.std-r.std,4) AS std_change, c."distinct"-r."distinct" AS distinct_change FROM c JOIN r USING ("column")""",
)


STORED = ["column", "rows", "missing", "missing_ratio", "mean", "std", "min", "max", "distinct", "q1", "median", "q3"]


def _stored_profile(t):
    from tessera.sources.layers import LayerStore

    store = LayerStore(t.spark, scratch_dir(t.spark, "profiles"))
    cur, ref = _halves(t)
    for date, df in (("2024-01-01", ref), ("2024-01-02", cur)):
        store.write(rounded(profile.profile(df), 4), "orders", "profiles", date)
    return store.latest("orders", "profiles").select(*STORED)


reg(
    "pro3_stored_profile",
    _stored_profile,
    f"WITH {HALVES}, c AS {_C} SELECT " + ", ".join(f'"{c}"' if c in ("column", "rows", "missing", "distinct") else f'round("{c}",4) AS "{c}"' for c in STORED) + " FROM c",
)


def _state_store(t):
    """Profile states of orders by month of ordering."""
    from tessera.operators.profile_state import ProfileStore
    from tessera.sources.layers import LayerStore

    states = ProfileStore(LayerStore(t.spark, scratch_dir(t.spark, "states")))
    states.save(t.orders, "orders", F.trunc(F.col("o_orderdate").cast("date"), "MM"), ["o_totalprice", "o_orderstatus", "o_orderpriority"])
    return states


RANGE = ("1994-03-01", "1996-02-01")
_SPAN = "o_orderdate >= TIMESTAMP '1994-03-01' AND o_orderdate < TIMESTAMP '1996-03-01'"


def _merged_profile(t):
    """Two years from the stored states; of the estimates, whether they are within the error that is promised."""
    p = _state_store(t).over("orders", *RANGE)
    exact = profile.profile(t.orders.where(_SPAN).select("o_totalprice", "o_orderstatus", "o_orderpriority")).select("column", F.col("distinct").alias("_d"))
    v = t.orders.where(_SPAN).select(F.col("o_totalprice").alias("v"))
    q = p.where("column = 'o_totalprice'").select("q1", "median", "q3")
    sides = [(F.count_if(F.col("v") < F.col(c)) / F.count("*") <= share + RANK_ERROR) & (F.count_if(F.col("v") <= F.col(c)) / F.count("*") >= share - RANK_ERROR) for c, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    near = v.join(F.broadcast(q)).agg((sides[0] & sides[1] & sides[2]).alias("_ok"))  # one row of quartiles
    out = p.join(exact, "column").withColumn("distinct_near", F.abs(F.col("distinct") - F.col("_d")) <= 0.08 * F.col("_d"))
    ok = F.when(F.col("q1").isNotNull(), near.scalar()).alias("quartiles_near")
    return rounded(out.select("column", "rows", "present", "missing", "missing_ratio", "mean", "std", "min", "max", "zeros", "distinct_near", ok), 4)


reg(
    "pro1_profile_of_states",
    _merged_profile,
    f"""WITH o AS (SELECT * FROM orders WHERE {_SPAN}) SELECT "column", rows, present, missing, missing_ratio, mean, std, round(min,4) AS min, round(max,4) AS max, zeros, true AS distinct_near, CASE WHEN mean IS NOT NULL THEN true END AS quartiles_near
FROM ({profile_sql('o', ['o_totalprice'])} UNION ALL {text_profile_sql('o', ['o_orderstatus', 'o_orderpriority'])})""",
)
reg(
    "pro3_profile_by_date",
    lambda t: rounded(_state_store(t).load("orders", "1995-05-01").where("column = 'o_totalprice'").select("column", "rows", "mean", "std", "min", "max"), 4),
    """SELECT 'o_totalprice' AS "column", count(*) AS rows, round(avg(o_totalprice),4) AS mean, round(stddev_samp(o_totalprice),4) AS std, round(min(o_totalprice),4) AS min, round(max(o_totalprice),4) AS max
FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1995-05-01'""",
)
reg(
    "pro3_top_values",
    lambda t: frequent(_state_store(t).between("orders", *RANGE), 10),
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM orders WHERE {_SPAN} GROUP BY 2" for c in ("o_orderstatus", "o_orderpriority")),
)
_NULL_COLS = ["event_id", "user_id", "kind", "note", "value", "lat", "long", "event_time"]
reg(
    "pro4_null_overview",
    lambda t: rounded(profile.null_overview(dirty(t))),
    f"WITH {DIRTY} " + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*)-count({c}) AS missing, round((count(*)-count({c}))*100/count(*),6) AS missing_pct FROM dt""" for c in _NULL_COLS),
)
reg(
    "pro5_training_baseline",
    lambda t: rounded(profile.training_baseline(t.lineitem, NUM), 4),
    f"""SELECT "column", mean, std, min, q1 AS p25, median AS p50, q3 AS p75, max, round(missing_ratio*100,4) AS null_pct FROM ({profile_sql('lineitem', NUM)})""",
)


def outlier_sql(c, table):
    return f"""SELECT '{c}' AS f, count(*) AS rows, count(*) FILTER (WHERE abs({c}-m)>3.5*s) AS z, count(*) FILTER (WHERE {c} < q1-1.5*(q3-q1) OR {c} > q3+1.5*(q3-q1)) AS i
 FROM {table}, (SELECT avg({c}) AS m, stddev_pop({c}) AS s, quantile_cont({c}::double,0.25) AS q1, quantile_cont({c}::double,0.75) AS q3 FROM {table})"""

_CATEGORIES = ["p_brand", "p_type", "p_name"]
reg(
    "pro5_categorical_baseline",
    lambda t: rounded(profile.categorical_baseline(t.part, _CATEGORIES)),
    "WITH c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY 2" for c in _CATEGORIES)
    + """), s AS (SELECT "column", sum(n) AS present, count(*) AS n_unique FROM c GROUP BY 1)
SELECT "column", value, n, round(n/present, 6) AS share, n_unique FROM c JOIN s USING ("column") QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) <= 20""",
)


def _findings_of(t):
    return quality.suppress_expected(quality.anomalies(dirty(t), _as_of()), "service_311")


ANOM = f"""mis AS (SELECT 'missing_values' AS rule, CASE WHEN r>0.5 THEN 'critical' ELSE 'warning' END AS severity, f AS feature, n, round(r,6) AS ratio FROM
 (SELECT 'kind' AS f, count(*)-count(kind) AS n, (count(*)-count(kind))/count(*) AS r FROM dt UNION ALL SELECT 'note', count(*)-count(note), (count(*)-count(note))/count(*) FROM dt) WHERE r > 0.2),
geoa AS ({GEO_SQL} UNION ALL {finding_sql('zero_coordinates', 'warning', 'lat/long', 'lat=0 AND long=0')}), tim AS ({TIME_SQL}),
catv AS (SELECT 'kind' AS f, kind AS v, count(*) AS n FROM dt WHERE kind IS NOT NULL GROUP BY 2 UNION ALL SELECT 'note', note, count(*) FROM dt WHERE note IS NOT NULL GROUP BY 2),
cats AS (SELECT f, sum(n)::bigint AS present, count(*) AS d, count(*) FILTER (WHERE n=1) AS s FROM catv GROUP BY 1),
cat AS (SELECT 'high_cardinality' AS rule, 'info' AS severity, f AS feature, d AS n, round(d/present,6) AS ratio FROM cats WHERE d/present > 0.9 AND d > 100
 UNION ALL SELECT 'singleton_values', 'info', f, s, round(s/d,6) FROM cats WHERE s/d > 0.5 AND d > 20)"""
ANOM += f""", outc AS ({" UNION ALL ".join(outlier_sql(c, "dt") for c in ("event_id", "user_id", "value", "lat", "long"))}),
outl AS (SELECT 'outlier' AS rule, 'warning' AS severity, f AS feature, greatest(z,i) AS n, round(greatest(z,i)/rows,6) AS ratio FROM outc WHERE greatest(z,i)/rows > 0.05 AND rows >= 10),
dupr AS (SELECT (sum(c)-count(*))::bigint AS n, (sum(c)-count(*))/sum(c) AS r FROM (SELECT count(*) AS c FROM dt GROUP BY event_id, user_id, kind, note, value, lat, long, event_time)),
dup AS (SELECT 'duplicate_rows' AS rule, CASE WHEN r>0.1 THEN 'critical' WHEN r>0.01 THEN 'warning' ELSE 'info' END AS severity, '__all__' AS feature, n, round(r,6) AS ratio FROM dupr WHERE n > 0)"""
ALL_ANOM = " UNION ALL ".join(f"SELECT * FROM {x}" for x in ("mis", "geoa", "tim", "cat", "outl", "dup"))
reg(
    "pro6_dataset_card",
    lambda t: quality.dataset_card(dirty(t), "event_time", _findings_of(t)),
    f"""WITH {DIRTY}, {ANOM}, a AS ({ALL_ANOM}) SELECT (SELECT count(*) FROM dt) AS rows, 8 AS columns, (SELECT min(event_time) FROM dt) AS first_event, (SELECT max(event_time) FROM dt) AS last_event,
 count(*) FILTER (WHERE severity='info') AS findings_info, count(*) FILTER (WHERE severity='warning') AS findings_warning, count(*) FILTER (WHERE severity='critical') AS findings_critical FROM a""",
)

# -- anomalies -----------------------------------------------------------------------------------

reg("ano1_missing", lambda t: findings(quality.missing_anomalies(dirty(t))), f"WITH {DIRTY}, {ANOM} SELECT * FROM mis")


def _long_tail(t):
    return t.events.select("value", (F.col("value") * F.col("value")).alias("squared"), "user_id")


TAIL = "tl AS (SELECT value, value*value AS squared, user_id::double AS user_id FROM events)"


OUT = "o AS (" + " UNION ALL ".join(outlier_sql(c, "tl") for c in ("value", "squared", "user_id")) + ")"
reg(
    "ano2_outliers",
    lambda t: findings(quality.outlier_anomalies(_long_tail(t), share=0.01)),
    f"WITH {TAIL}, {OUT} SELECT 'outlier' AS rule, 'warning' AS severity, f AS feature, greatest(z,i) AS n, round(greatest(z,i)/rows,6) AS ratio FROM o WHERE greatest(z,i)/rows > 0.01",
)
reg("ano3_geographic", lambda t: findings(quality.geo_anomalies(dirty(t))), f"WITH {DIRTY}, {ANOM} SELECT * FROM geoa")
reg("ano4_temporal", lambda t: findings(quality.time_bounds(dirty(t), _as_of(), 1, 10)), f"WITH {DIRTY}, {ANOM} SELECT * FROM tim")


def _texts(t):
    return t.documents.select("text", "lang", "source")


def _cat_sql(cols, table):
    v = " UNION ALL ".join(f"SELECT '{c}' AS f, {c} AS v, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 2" for c in cols)
    return f"""catv AS ({v}), cats AS (SELECT f, sum(n)::bigint AS present, count(*) AS d, count(*) FILTER (WHERE n=1) AS s FROM catv GROUP BY 1)"""


reg(
    "ano5_categorical",
    lambda t: findings(quality.category_anomalies(_texts(t))),
    f"""WITH {_cat_sql(['text', 'lang', 'source'], 'documents')} SELECT 'high_cardinality' AS rule, 'info' AS severity, f AS feature, d AS n, round(d/present,6) AS ratio FROM cats WHERE d/present > 0.9 AND d > 100
UNION ALL SELECT 'singleton_values', 'info', f, s, round(s/d,6) FROM cats WHERE s/d > 0.5 AND d > 20""",
)
reg(
    "ano6_duplicates",
    lambda t: findings(quality.duplicate_anomalies(t.lineitem.select("l_orderkey", "l_linenumber"))),
    """WITH d AS (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber), r AS (SELECT (sum(c)-count(*))::bigint AS n, (sum(c)-count(*))/sum(c) AS r FROM d)
SELECT 'duplicate_rows' AS rule, CASE WHEN r>0.1 THEN 'critical' WHEN r>0.01 THEN 'warning' ELSE 'info' END AS severity, '__all__' AS feature, n, round(r,6) AS ratio FROM r WHERE n > 0""",
)
reg(
    "ano7_combined",
    lambda t: findings(quality.anomalies(dirty(t), _as_of())),
    f"WITH {DIRTY}, {ANOM} {ALL_ANOM}",
)
reg(
    "ano8_suppression",
    lambda t: findings(quality.suppress_expected(quality.anomalies(dirty(t).withColumnRenamed("note", "close_date"), _as_of()), "service_311")),
    f"WITH {DIRTY}, {ANOM}, a AS ({ALL_ANOM}) SELECT * REPLACE (CASE WHEN feature='note' THEN 'close_date' ELSE feature END AS feature) FROM a WHERE NOT (rule='missing_values' AND feature='note')",
)

# -- drift ---------------------------------------------------------------------------------------

EPS = "1e-6"


def psi_sql(counts: str) -> str:
    """PSI per f from (f, part, c, r) counts."""
    return f"""(WITH k AS ({counts}), tt AS (SELECT f, sum(c) AS tc, sum(r) AS tr FROM k GROUP BY 1)
 SELECT k.f, sum((greatest(c/tc,{EPS})-greatest(r/tr,{EPS}))*ln(greatest(c/tc,{EPS})/greatest(r/tr,{EPS}))) AS psi FROM k JOIN tt USING (f) GROUP BY 1)"""


def num_counts(c, cur="cur", ref="rf"):
    edge = " + ".join(f"(v >= (hi-lo)/10*{i}+lo)::int" for i in range(1, 10))
    return f"""SELECT '{c}' AS f, (1+{edge})::varchar AS part, count(*) FILTER (WHERE isc) AS c, count(*) FILTER (WHERE NOT isc) AS r
 FROM (SELECT {c}::double AS v, true AS isc FROM {cur} UNION ALL SELECT {c}::double, false FROM {ref}),
 (SELECT min(v) AS lo, max(v) AS hi FROM (SELECT {c}::double AS v FROM {cur} UNION ALL SELECT {c}::double FROM {ref})) GROUP BY 2"""


def cat_counts(c, cur="cur", ref="rf"):
    return f"""SELECT '{c}' AS f, v::varchar AS part, count(*) FILTER (WHERE isc) AS c, count(*) FILTER (WHERE NOT isc) AS r
 FROM (SELECT {c} AS v, true AS isc FROM {cur} UNION ALL SELECT {c}, false FROM {ref}) WHERE v IS NOT NULL GROUP BY 2"""


SEV = "CASE WHEN psi>=0.25 THEN 'critical' WHEN psi>=0.1 THEN 'warning' ELSE 'none' END"
reg(
    "drf1_numeric_psi",
    lambda t: rounded(drift.psi_numeric(*_flags(t), ["l_quantity", "l_extendedprice", "l_discount"])),
    f"""WITH cur AS (SELECT l_quantity, l_extendedprice*1.3e0 AS l_extendedprice, l_discount FROM lineitem WHERE l_linestatus='O'), rf AS (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem WHERE l_linestatus='F')
SELECT f AS "column", round(psi,6) AS psi FROM {psi_sql(' UNION ALL '.join(num_counts(c) for c in NUM))}""",
)


def _flags(t):
    cur = t.lineitem.where("l_linestatus = 'O'").withColumn("l_extendedprice", F.col("l_extendedprice") * 1.3)
    return cur, t.lineitem.where("l_linestatus = 'F'")


reg(
    "drf2_categorical_psi",
    lambda t: rounded(drift.psi_categorical(*_langs(t), ["lang", "source"])),
    f"""WITH cur AS (SELECT lang, source FROM documents WHERE n_chars > 1500), rf AS (SELECT lang, source FROM documents WHERE n_chars <= 1500)
SELECT f AS "column", round(psi,6) AS psi FROM {psi_sql(cat_counts('lang') + ' UNION ALL ' + cat_counts('source'))}""",
)


def _langs(t):
    d = t.documents.select("lang", "source", "n_chars")
    return d.where("n_chars > 1500"), d.where("n_chars <= 1500")


DETECT = f"""SELECT f AS "column", 'numerical' AS kind, psi FROM {psi_sql(num_counts('o_totalprice'))} UNION ALL SELECT f, 'categorical', psi FROM {psi_sql(cat_counts('o_orderstatus') + ' UNION ALL ' + cat_counts('o_orderpriority'))}"""
reg("drf3_feature_drift", lambda t: rounded(drift.detect(*_halves(t))), f'WITH {HALVES} SELECT "column", kind, round(psi,6) AS psi, {SEV} AS severity FROM ({DETECT})')
reg(
    "drf3_side_statistics",
    lambda t: rounded(drift.numeric_stats(*_halves(t), ["o_totalprice"]), 4),
    f"WITH {HALVES} "
    + " UNION ALL ".join(
        f"""SELECT 'o_totalprice' AS "column", '{n}' AS side, round(avg(o_totalprice),4) AS mean, round(stddev_samp(o_totalprice),4) AS std, round(min(o_totalprice),4) AS min, round(max(o_totalprice),4) AS max, round(median(o_totalprice),4) AS median FROM {x}"""
        for n, x in (("current", "cur"), ("reference", "rf"))
    ),
)
reg(
    "drf4_drift_ignoring_columns",
    lambda t: rounded(drift.detect(*_halves(t), ignore=["o_orderstatus"])),
    f"WITH {HALVES} SELECT \"column\", kind, round(psi,6) AS psi, {SEV} AS severity FROM ({DETECT}) WHERE \"column\" <> 'o_orderstatus'",
)
reg(
    "drf5_psi_from_profiles",
    lambda t: rounded(profile.psi_from_profiles(*[profile.profile(h) for h in _halves(t)])),
    f"""WITH {HALVES}, c AS {_C}, r AS {_R} SELECT "column", round(CASE WHEN c.mean IS NOT NULL THEN least(abs(c.mean-r.mean)/r.std*0.1,1) ELSE least(abs(c."distinct"-r."distinct")/greatest(r."distinct",1),1) END,6) AS psi FROM c JOIN r USING ("column")""",
)
reg(
    "drf6_test_severity",
    lambda t: drift.detect(*_halves(t)).select("column", drift.severity_from_test("psi", "jensenshannon").alias("by_distance"), drift.severity_from_test("psi", "ks p_value").alias("by_p_value")),
    f"""WITH {HALVES} SELECT "column", CASE WHEN psi>0.25 THEN 'critical' WHEN psi>0.1 THEN 'warning' ELSE 'none' END AS by_distance, CASE WHEN psi<0.01 THEN 'critical' WHEN psi<0.05 THEN 'warning' ELSE 'none' END AS by_p_value FROM ({DETECT})""",
)


def ks_sql(src_a, src_b):
    return f"""(WITH u AS (SELECT v, count(*) FILTER (WHERE a) AS a, count(*) FILTER (WHERE NOT a) AS b FROM (SELECT v, true AS a FROM ({src_a}) UNION ALL SELECT v, false FROM ({src_b})) GROUP BY 1),
 w AS (SELECT sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM u) SELECT max(abs(ca/ta - cb/tb)) AS d, max(ta)::bigint AS n, max(tb)::bigint AS m FROM w)"""


def chi_sql(rows):
    """chi-square, dof and n of (a, b) rows, with Yates' correction at one degree of freedom."""
    return f"""(WITH o AS (SELECT a, b, count(*)::double AS o FROM ({rows}) GROUP BY 1, 2), ra AS (SELECT a, sum(o) AS r FROM o GROUP BY 1), rb AS (SELECT b, sum(o) AS c FROM o GROUP BY 1), nn AS (SELECT sum(o) AS n FROM o),
 g AS (SELECT coalesce(o.o,0) AS o, r*c/n AS e FROM ra CROSS JOIN rb CROSS JOIN nn LEFT JOIN o ON o.a=ra.a AND o.b=rb.b), k AS (SELECT ((SELECT count(*) FROM ra)-1)*((SELECT count(*) FROM rb)-1) AS dof)
 SELECT CASE WHEN dof=1 THEN sum(pow(greatest(abs(o-e)-0.5,0),2)/e) ELSE sum(pow(o-e,2)/e) END AS x2, dof, (SELECT n FROM nn)::bigint AS n FROM g, k GROUP BY dof)"""


CHI2 = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", 'chi2' AS test, round(x2,6) AS statistic, dof, NULL::bigint AS n_first, NULL::bigint AS n_second FROM {chi_sql(f"SELECT true AS a, {c} AS b FROM cur UNION ALL SELECT false, {c} FROM rf")}"""
    for c in ("o_orderstatus", "o_orderpriority")
)
reg(
    "drf7_test_drift",
    lambda t: rounded(drift.test_statistics(*_halves(t))),
    f"""WITH {HALVES} SELECT 'o_totalprice' AS "column", 'ks' AS test, round(d,6) AS statistic, NULL::bigint AS dof, n AS n_first, m AS n_second FROM {ks_sql('SELECT o_totalprice AS v FROM cur', 'SELECT o_totalprice AS v FROM rf')} UNION ALL {CHI2}""",
)

_KS_P = "CASE WHEN d*sqrt(n*m/(n+m)) < 1e-8 THEN 1e0 ELSE least(1e0, greatest(0e0, 2*list_sum(list_transform(range(1,101), lambda k: (CASE WHEN k%2=1 THEN 1e0 ELSE -1e0 END)*exp(-2*pow(k*d*sqrt(n*m/(n+m)),2)))))) END"
# for an even number of degrees of freedom the tail has a closed form
_CHI_P = "CASE WHEN x2 > 0 THEN exp(-x2/2)*list_sum(list_transform(range(0,(dof//2)::bigint), lambda k: pow(x2/2,k)/factorial(k::int)::double)) ELSE 1e0 END"
reg(
    "drf7_test_decisions",
    lambda t: rounded(drift.with_p_values(drift.test_statistics(*_halves(t))).select("column", "test", "statistic", "p_value", "severity", (F.col("severity") != "none").alias("drift"))),
    f"""WITH {HALVES}, p AS (SELECT 'o_totalprice' AS "column", 'ks' AS test, d AS statistic, {_KS_P} AS p_value FROM {ks_sql('SELECT o_totalprice AS v FROM cur', 'SELECT o_totalprice AS v FROM rf')} UNION ALL """
    + " UNION ALL ".join(f"""SELECT '{c}', 'chi2', x2, {_CHI_P} FROM {chi_sql(f"SELECT true AS a, {c} AS b FROM cur UNION ALL SELECT false, {c} FROM rf")}""" for c in ("o_orderstatus", "o_orderpriority"))
    + """) SELECT "column", test, round(statistic,6) AS statistic, round(p_value,6) AS p_value, CASE WHEN p_value<0.01 THEN 'critical' WHEN p_value<0.05 THEN 'warning' ELSE 'none' END AS severity, p_value<0.05 AS drift FROM p""",
)


def _week(t):
    """Last seven days of events against everything before."""
    from tessera.operators.joining import constant

    e = t.events.select("ts", "event_type", "value", F.hour("ts").alias("hour"))
    split = constant(t.events, F.max("ts")) - F.expr("INTERVAL 7 DAYS")
    return drift.window_vs_baseline(e, "ts", split)


WEEK = """cur AS (SELECT event_type, value, hour(ts) AS hour FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY), rf AS (SELECT event_type, value, hour(ts) AS hour FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 7 DAY)"""
WEEKP = f"""p AS (SELECT f, psi FROM {psi_sql(num_counts('value') + ' UNION ALL ' + num_counts('hour') + ' UNION ALL ' + cat_counts('event_type'))}),
ds AS (SELECT count(*) AS columns, count(*) FILTER (WHERE psi>=0.1) AS drifted, max(psi) AS max_score FROM p)"""
reg(
    "drf8_dataset_drift",
    lambda t: rounded(drift.dataset_drift(drift.detect(*_week(t)))),
    f"WITH {WEEK}, {WEEKP} SELECT columns, drifted, round(max_score,6) AS max_score, round(drifted/columns,6) AS drift_share, drifted/columns >= 0.5 AS dataset_drift FROM ds",
)
reg(
    "drf9_retrain_decision",
    lambda t: rounded(drift.retrain_decision(drift.dataset_drift(drift.detect(*_week(t))), limits={"score": 0.001})),
    f"""WITH {WEEK}, {WEEKP} SELECT columns, drifted, round(max_score,6) AS max_score, round(drifted/columns,6) AS drift_share, drifted/columns >= 0.5 AS dataset_drift,
 array_to_string(list_filter([CASE WHEN max_score>0.001 THEN 'feature score' END, CASE WHEN drifted/columns>0.3 THEN 'drift share' END, CASE WHEN drifted/columns>=0.5 THEN 'dataset drift' END], lambda x: x IS NOT NULL), ', ') AS reasons,
 (max_score>0.001 OR drifted/columns>0.3) AS retrain FROM ds""",
)

# -- statistical tests ---------------------------------------------------------------------------


def kw_sql(rows: str) -> str:
    return f"""WITH x AS ({rows}), rk AS (SELECT g, v, row_number() OVER (ORDER BY v) AS i FROM x), md AS (SELECT v, avg(i) AS r, count(*)::double AS t FROM rk GROUP BY 1),
rs AS (SELECT g, count(*)::double AS n, sum(r) AS s FROM x JOIN md USING (v) GROUP BY 1), tie AS (SELECT sum(t*t*t-t) AS t FROM md), tot AS (SELECT count(*) AS k, sum(n) AS n, sum(s*s/n) AS q FROM rs)"""


reg(
    "tst1_kruskal_wallis",
    lambda t: rounded(stat_tests.kruskal(t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), "c_nationkey", "o_totalprice", 10), 4),
    kw_sql("SELECT c_nationkey AS g, o_totalprice AS v FROM orders JOIN customer ON o_custkey=c_custkey QUALIFY count(*) OVER (PARTITION BY c_nationkey) >= 10")
    + " SELECT k AS groups, n::bigint AS rows, round((12/(n*(n+1))*q-3*(n+1))/(1-tie.t/(n*n*n-n)),4) AS statistic, k-1 AS dof FROM tot, tie",
)
reg(
    "tst2_kolmogorov_smirnov",
    lambda t: rounded(stat_tests.ks_two_sample(t.events.withColumn("w", dates.is_weekend("ts")), "value", "w")),
    f"SELECT round(d,6) AS statistic, n AS n_first, m AS n_second FROM {ks_sql('SELECT value AS v FROM events WHERE isodow(ts)>=6', 'SELECT value AS v FROM events WHERE isodow(ts)<6')}",
)
reg(
    "tst3_chi_square",
    lambda t: rounded(stat_tests.chi_square(t.orders, "o_orderstatus", "o_orderpriority")),
    f"SELECT round(x2,6) AS statistic, dof, n FROM {chi_sql('SELECT o_orderstatus AS a, o_orderpriority AS b FROM orders')}",
)
reg(
    "tst3_chi_square_two_by_two",
    lambda t: rounded(stat_tests.chi_square(t.labels, "quality", "toxic")),
    f"SELECT round(x2,6) AS statistic, dof, n FROM {chi_sql('SELECT quality AS a, toxic AS b FROM labels')}",
)
reg(
    "tst4_mann_whitney",
    lambda t: rounded(stat_tests.mann_whitney(t.lineitem, "l_linestatus", "l_quantity", "O", "F"), 4),
    kw_sql("SELECT l_linestatus AS g, l_quantity AS v FROM lineitem")
    + """, mw AS (SELECT max(n) FILTER (WHERE g='O') AS a, max(n) FILTER (WHERE g='F') AS b, max(s) FILTER (WHERE g='O') AS r FROM rs), u AS (SELECT a, b, r-a*(a+1)/2 AS u, a+b AS n FROM mw)
SELECT a::bigint AS n_first, b::bigint AS n_second, round(u,4) AS statistic, round((greatest(u,a*b-u)-a*b/2-0.5)/sqrt(a*b/12*((n+1)-tie.t/(n*(n-1)))),4) AS z FROM u, tie""",
)
reg(
    "tst5_levene",
    lambda t: rounded(stat_tests.levene(t.events, "event_type", "value"), 4),
    """WITH x AS (SELECT event_type AS g, abs(value - median(value) OVER (PARTITION BY event_type)) AS z FROM events), s AS (SELECT g, count(*)::double AS n, sum(z) AS s, sum(z*z) AS ss FROM x GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS n, sum(s) AS s, sum(ss) AS ss, sum(s*s/n) AS b FROM s) SELECT k AS groups, n::bigint AS rows, round((n-k)*(b-s*s/n)/((k-1)*(ss-b)),4) AS statistic FROM t""",
)
