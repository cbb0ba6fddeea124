"""Queries of the projection, filter, NULL-handling and scalar-function sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays, dates, geo, numbers, strings
from tessera.operators import areas, clean, features
from tessera.plans.registry import INC, REQ, incidents, point, point_sql, reg, requests, rounded
from tessera.session import scratch_dir

CLAT, CLON = point_sql("c_custkey")

# -- projection ----------------------------------------------------------------------------------

reg(
    "prj1_rename",
    lambda t: clean.rename(t.events, {"event_id": "incident_number", "ts": "occurred_on_date", "nope": "x"}),
    "SELECT event_id AS incident_number, ts AS occurred_on_date, user_id, event_type, value, props FROM events",
)
reg(
    "prj2_lenient_coercion",
    lambda t: clean.coerce(
        t.documents.select("doc_id", F.col("source").alias("as_int"), F.col("n_chars").cast("string").alias("as_float"),
                           F.col("lang").alias("as_bool"), F.col("text").alias("as_time")),
        {"as_int": "int", "as_float": "float", "as_bool": "bool", "as_time": "datetime"},
    ),
    """SELECT doc_id, try_cast(source AS bigint) AS as_int, try_cast(n_chars::varchar AS double) AS as_float, try_cast(lang AS boolean) AS as_bool,
 try_cast(text AS timestamp) AS as_time FROM documents""",
)
reg(
    "prj4_keep_existing",
    lambda t: clean.keep_existing(t.orders, ["o_orderdate", "missing", "o_orderkey"]),
    "SELECT o_orderdate, o_orderkey FROM orders",
)
reg(
    "prj5_drop_columns",
    lambda t: t.lineitem.drop("l_tax", "l_discount", "nope"),
    "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem",
)
reg(
    "prj6_header_normalise",
    lambda t: clean.normalise_headers(t.customer.toDF(" Cust Key", "Full Name ", "Nation-Key", "Acct Bal", "SEGMENT"), dash=True),
    "SELECT c_custkey AS cust_key, c_name AS full_name, c_nationkey AS nation_key, c_acctbal AS acct_bal, c_mktsegment AS segment FROM customer",
)
reg(
    "prj7_contract_reindex",
    lambda t: clean.reindex(t.supplier, {"s_suppkey": "bigint", "s_name": "string", "zip": "string", "s_acctbal": "double"}),
    "SELECT s_suppkey, s_name, NULL::varchar AS zip, s_acctbal FROM supplier",
)
reg(
    "prj8_empty_contract",
    lambda t: clean.empty_like(t.events, {"event_id": "bigint", "value": "double", "grid_cell": "string"}),
    "SELECT event_id, value, NULL::varchar AS grid_cell FROM events WHERE false",
)
reg(
    "prj9_auto_numeric",
    lambda t: clean.auto_numeric(t.documents.select("doc_id", F.col("n_chars").cast("string").alias("size"), "lang"), ["size", "lang"]),
    "SELECT doc_id, n_chars::double AS size, lang FROM documents",
)

# -- filters -------------------------------------------------------------------------------------


def _located(t):
    lat, lon = point("c_custkey")
    shift = F.when(F.col("c_acctbal") < 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return t.customer.select("c_custkey", (lat + shift).alias("lat"), F.when(F.col("c_mktsegment") != "MACHINERY", lon).alias("long"))


LOC = f"""c AS (SELECT c_custkey, {CLAT} + CASE WHEN c_acctbal < 0 THEN 1e0 ELSE 0e0 END AS lat,
 CASE WHEN c_mktsegment <> 'MACHINERY' THEN {CLON} END AS long FROM customer)"""
OKLAT, OKLON = "coalesce(lat BETWEEN 42.2e0 AND 42.4e0, false)", "coalesce(long BETWEEN -71.2e0 AND -70.9e0, false)"

reg(
    "flt1_drop_outside_box",
    lambda t: clean.kept(clean.tag_drops(_located(t), clean.location_reasons())),
    f"WITH {LOC} SELECT * FROM c WHERE {OKLAT} AND {OKLON}",
)
reg(
    "flt2_null_pair",
    lambda t: clean.null_pair_outside(_located(t)),
    f"WITH {LOC} SELECT c_custkey, CASE WHEN {OKLAT} AND {OKLON} THEN lat END AS lat, CASE WHEN {OKLAT} AND {OKLON} THEN long END AS long FROM c",
)
reg(
    "flt3_null_each",
    lambda t: clean.null_each_outside(_located(t)),
    f"WITH {LOC} SELECT c_custkey, CASE WHEN {OKLAT} THEN lat END AS lat, CASE WHEN {OKLON} THEN long END AS long FROM c",
)
reg(
    "flt4_null_pair_requests",
    lambda t: clean.null_pair_outside(
        requests(t).select("case_id", (F.col("lat") + F.when(F.col("on_time") == "OVERDUE", 0.15).otherwise(0.0)).alias("lat"), "long")
    ),
    f"""WITH {REQ}, r AS (SELECT case_id, lat + CASE WHEN on_time='OVERDUE' THEN 0.15e0 ELSE 0e0 END AS lat, long FROM req)
SELECT case_id, CASE WHEN {OKLAT} AND {OKLON} THEN lat END AS lat, CASE WHEN {OKLAT} AND {OKLON} THEN long END AS long FROM r""",
)
reg(
    "flt5_zero_to_null",
    lambda t: clean.null_zero_pair(t.lineitem.select("l_orderkey", F.col("l_tax").alias("lat"), F.col("l_discount").alias("long"))),
    """SELECT l_orderkey, CASE WHEN l_tax<>0 AND l_discount<>0 THEN l_tax END AS lat, CASE WHEN l_tax<>0 AND l_discount<>0 THEN l_discount END AS long FROM lineitem""",
)


def _timed(t):
    raw = F.when(F.col("event_type") == "click", F.lit("not a date")).otherwise(F.col("ts").cast("string"))
    return t.events.select("event_id", dates.parse_utc(raw).cast("timestamp_ntz").alias("ts"))


TIMED = "e AS (SELECT event_id, CASE WHEN event_type='click' THEN NULL ELSE ts END AS ts FROM events)"


def _dated(t):
    """Orders against a reference time inside the data, so that every reason occurs."""
    return clean.tag_drops(t.orders.select("o_orderkey", "o_orderdate"), _dated_reasons())


def _dated_reasons():
    return clean.time_reasons("o_orderdate", F.lit("2000-06-01").cast("timestamp_ntz"), 1, 3)


DATED = """d AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate > TIMESTAMP '2000-06-02' THEN 'future_date'
 WHEN o_orderdate < TIMESTAMP '2000-06-01' - INTERVAL 1095 DAY THEN 'old_date' END AS drop_reason FROM orders)"""

reg(
    "flt6_unparseable_time",
    lambda t: clean.kept(clean.tag_drops(_timed(t), {"invalid_date": F.col("ts").isNull()})),
    f"WITH {TIMED} SELECT * FROM e WHERE ts IS NOT NULL",
)
reg("flt7_time_bounds", lambda t: clean.kept(_dated(t)), f"WITH {DATED} SELECT o_orderkey, o_orderdate FROM d WHERE drop_reason IS NULL")
reg(
    "flt8_negative_to_null",
    lambda t: t.customer.select("c_custkey", numbers.non_negative("c_acctbal").alias("c_acctbal")),
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer",
)


def _closed(t):
    """Line items with their order: shipping closes the case."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", dates.hours_between("o_orderdate", "l_shipdate").alias("hours"))


CLOSED = """j AS (SELECT l_orderkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate)/3600.0 AS hours FROM lineitem JOIN orders ON l_orderkey=o_orderkey)"""
reg(
    "flt9_duration_filter",
    lambda t: _closed(t).where("hours > 0 and hours < 720"),
    f"WITH {CLOSED} SELECT * FROM j WHERE hours > 0 AND hours < 720",
)
reg(
    "flt10_cap_outliers",
    lambda t: t.lineitem.select("l_orderkey", numbers.capped("l_extendedprice", 50000).alias("price"), numbers.clip("l_quantity", 5, 40).alias("qty")),
    "SELECT l_orderkey, least(l_extendedprice, 50000e0) AS price, greatest(5e0, least(40e0, l_quantity)) AS qty FROM lineitem",
)
reg(
    "flt11_groups_with_both_classes",
    lambda t: clean.groups_with_both_classes(t.documents.drop("text").join(t.labels, "doc_id"), "source", "toxic", 10),
    """WITH j AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id))
SELECT * FROM j WHERE source IN (SELECT source FROM j GROUP BY source HAVING count(*) >= 10 AND count(DISTINCT toxic) = 2)""",
)


def _counted(t, rows, reasons):
    """Write the rows that stay, and give the reasons of the others as that write has counted them."""
    with clean.DropCounts() as counts:
        stay = clean.drop_rows(rows, reasons)
    stay.write.parquet(scratch_dir(t.spark, "kept"))
    return counts.ledger(t.spark)


reg(
    "flt1_drop_counts",
    lambda t: _counted(t, _located(t), clean.location_reasons()),
    f"""WITH {LOC} SELECT CASE WHEN lat IS NULL OR long IS NULL THEN 'missing_coordinates' ELSE 'outside_box' END AS drop_reason, count(*) AS rows
FROM c WHERE NOT ({OKLAT} AND {OKLON}) GROUP BY 1""",
)
reg(
    "flt6_drop_counts",
    lambda t: _counted(t, _timed(t), {"invalid_date": F.col("ts").isNull()}),
    f"WITH {TIMED} SELECT 'invalid_date' AS drop_reason, count(*) AS rows FROM e WHERE ts IS NULL HAVING count(*) > 0",
)
reg(
    "flt12_drop_ledger",
    lambda t: _counted(t, t.orders.select("o_orderkey", "o_orderdate"), _dated_reasons()),
    f"WITH {DATED} SELECT drop_reason, count(*) AS rows FROM d WHERE drop_reason IS NOT NULL GROUP BY 1",
)

# -- NULL handling -------------------------------------------------------------------------------


def _sparse(t):
    return t.documents.drop("text").join(t.labels, "doc_id", "left")


reg(
    "nul1_fill_constants",
    lambda t: clean.fill(_sparse(t), {"quality": -1, "toxic": 0, "absent": 1}),
    "SELECT doc_id, lang, source, n_chars, coalesce(quality,-1) AS quality, coalesce(toxic,0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
reg(
    "nul2_scores_to_zero",
    lambda t: t.documents.select("doc_id", F.coalesce(F.col("lang").try_cast("double"), F.lit(0.0)).alias("lang_score"),
                                 F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("double"), F.lit(0.0)).alias("source_score")),
    """SELECT doc_id, coalesce(try_cast(lang AS double),0) AS lang_score, coalesce(try_cast(regexp_extract(source,'(\\d+)$',1) AS double),0) AS source_score FROM documents""",
)
reg(
    "nul3_null_tokens",
    lambda t: t.orders.select("o_orderkey", strings.null_tokens(F.regexp_replace("o_orderpriority", "^4-NOT SPECIFIED$", " n/a ")).alias("priority")),
    "SELECT o_orderkey, CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN NULL ELSE trim(o_orderpriority) END AS priority FROM orders",
)
reg(
    "nul4_missing_flags",
    lambda t: clean.with_missing_flags(_sparse(t).select("doc_id", F.col("quality").cast("double").alias("quality")), ["quality"]),
    "SELECT doc_id, coalesce(quality::double,0) AS quality, (quality IS NULL)::int AS quality_missing FROM documents LEFT JOIN labels USING (doc_id)",
)


def _two_sources(t):
    lat, lon = point("c_custkey")
    text = F.concat(F.lit("("), lat.cast("string"), F.lit(", "), lon.cast("string"), F.lit(")"))
    plat, plon = strings.extract_pair("location")
    first = _located(t).withColumn("location", text)
    return first.select("c_custkey", F.coalesce("lat", plat).alias("lat"), F.coalesce("long", plon).alias("long"))


reg(
    "nul5_coalesce_sources",
    _two_sources,
    f"WITH {LOC} SELECT c_custkey, lat, coalesce(long, {CLON}) AS long FROM c",
)

# -- duplicates ----------------------------------------------------------------------------------

reg(
    "dup1_keep_last",
    lambda t: clean.dedup(t.events, ["user_id"], ["ts", "event_id"], "last"),
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
reg(
    "dup1_keep_first",
    lambda t: clean.dedup(t.events, ["user_id", "event_type"], ["ts", "event_id"], "first"),
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
)
reg(
    "dup3_latest_per_cell",
    lambda t: features.newest_per_key(
        incidents(t).groupBy("h3_index", "hour_bucket", F.to_date("occurred_on_date").alias("computed_date")).agg(F.sum("severity_weight").alias("score")),
        ["h3_index", "hour_bucket"], "computed_date",
    ),
    f"""WITH {INC}, d AS (SELECT h3_index, hour_bucket, occurred_on_date::date AS computed_date, sum(severity_weight) AS score FROM inc GROUP BY 1,2,3)
SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY h3_index, hour_bucket ORDER BY computed_date DESC) = 1""",
)

# -- strings -------------------------------------------------------------------------------------

reg(
    "str1_upper_or_unknown",
    lambda t: t.orders.select("o_orderkey", strings.upper_or(F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.concat(F.lit(" "), F.lower("o_orderstatus"))), "UNKNOWN").alias("district")),
    "SELECT o_orderkey, CASE WHEN o_orderstatus='P' THEN 'UNKNOWN' ELSE o_orderstatus END AS district FROM orders",
)
TITLE = """array_to_string(list_transform(string_split(lower(p_type || ' ' || p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"""
reg(
    "str2_title_case",
    lambda t: t.part.select("p_partkey", strings.title_or(F.when(F.col("p_type") != "PROMO", F.concat_ws(" ", "p_type", "p_name")), "Other").alias("category")),
    f"SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN {TITLE} ELSE 'Other' END AS category FROM part",
)
reg(
    "str3_flag_parse",
    lambda t: t.lineitem.select("l_orderkey", strings.truthy(F.when(F.col("l_returnflag") == "R", "yes").when(F.col("l_returnflag") == "A", "0")).alias("shooting")),
    "SELECT l_orderkey, l_returnflag='R' AS shooting FROM lineitem",
)
reg(
    "str4_flag_is_one",
    lambda t: t.labels.select("doc_id", strings.is_one(F.concat(F.lit(" "), F.col("toxic").cast("string"), F.lit(" "))).alias("flag")),
    "SELECT doc_id, toxic=1 AS flag FROM labels",
)
reg(
    "str5_contains_ci",
    lambda t: t.documents.select("doc_id", strings.contains_ci("text", "LICENSE").alias("hit")),
    "SELECT doc_id, contains(lower(text),'license') AS hit FROM documents",
)
RULES = {"SMALL": 3.0, "RED": 2.0, "WIDGET": 0.5, "RING": 0.1}
CASES = " ".join(f"WHEN contains(upper(p_type||' '||p_name),'{k}') THEN {v}e0" for k, v in RULES.items())
reg(
    "str6_keyword_weights",
    lambda t: t.part.select("p_partkey", strings.keyword_weight(F.concat_ws(" ", "p_type", "p_name"), RULES, 1.0, F.col("p_size") > 40, 2.0).alias("severity_weight")),
    f"SELECT p_partkey, (CASE {CASES} ELSE 1e0 END) * CASE WHEN p_size > 40 THEN 2e0 ELSE 1e0 END AS severity_weight FROM part",
)


def _pairs(t):
    lat, lon = point("c_custkey")
    text = F.when(F.col("c_acctbal") >= 0, F.format_string("(%.3f, %.3f)", lat, lon)).otherwise(F.lit("n/a"))
    a, b = strings.extract_pair(text)
    return t.customer.select("c_custkey", a.alias("lat"), b.alias("long"))


reg(
    "str7_extract_pair",
    _pairs,
    f"SELECT c_custkey, CASE WHEN c_acctbal>=0 THEN printf('%.3f',{CLAT})::double END AS lat, CASE WHEN c_acctbal>=0 THEN printf('%.3f',{CLON})::double END AS long FROM customer",
)
reg(
    "str8_drop_decimal_tail",
    lambda t: t.lineitem.select("l_orderkey", strings.drop_decimal_tail(F.format_string("%.2f", "l_quantity")).alias("id")),
    "SELECT l_orderkey, l_quantity::bigint::varchar AS id FROM lineitem",
)
reg(
    "str9_money",
    lambda t: t.orders.select("o_orderkey", strings.money(F.concat(F.lit("$ "), F.format_number("o_totalprice", 2))).alias("loss")),
    "SELECT o_orderkey, round(o_totalprice,2) AS loss FROM orders",
)
reg(
    "str10_zip",
    lambda t: t.orders.select("o_orderkey", strings.zip5(F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_custkey") > 9999, "-1234").otherwise(""))).alias("zip")),
    "SELECT o_orderkey, lpad(substr(o_custkey::varchar || CASE WHEN o_custkey>9999 THEN '-1234' ELSE '' END,1,5),5,'0') AS zip FROM orders",
)
reg(
    "str11_street_type",
    lambda t: t.part.select("p_partkey", strings.street_type(F.concat_ws(" ", "p_name", F.when(F.col("p_type") == "SMALL", "st").when(F.col("p_type") == "LARGE", "Blvd"))).alias("street_type")),
    "SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'Street' WHEN 'LARGE' THEN 'Boulevard' ELSE 'Other' END AS street_type FROM part",
)
reg(
    "str12_clean_kind",
    lambda t: t.events.select("event_id", strings.clean_kind(F.when(F.col("event_type") == "view", " Lights").when(F.col("event_type") == "click", "LIGHT`").when(F.col("event_type") == "error", "none").when(F.col("event_type") == "signup", "lamp"), "light").alias("kind")),
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'LIGHT' WHEN 'click' THEN 'LIGHT' WHEN 'signup' THEN '(dirty)' ELSE '(missing)' END AS kind FROM events",
)
reg(
    "str13_value_map",
    lambda t: t.lineitem.select("l_orderkey", strings.lookup("l_returnflag", {"R": 1, "A": 2}, 0).alias("level")),
    "SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 0 END AS level FROM lineitem",
)
reg(
    "str14_three_way_label",
    lambda t: t.documents.select("doc_id", strings.three_way("text", ("license", "Licensed"), ("http", "Linked"), "Other").alias("label")),
    "SELECT doc_id, CASE WHEN contains(lower(text),'license') THEN 'Licensed' WHEN contains(lower(text),'http') THEN 'Linked' ELSE 'Other' END AS label FROM documents",
)
reg(
    "str15_other_text",
    lambda t: t.documents.select("doc_id", strings.other_text(F.when(F.col("lang") == "en", "Other").when(F.col("lang") != "fr", F.col("lang")), F.when(F.col("source") != "src1", F.upper("source"))).alias("mode")),
    """SELECT doc_id, CASE WHEN lang IN ('en','fr') AND source <> 'src1' THEN 'other: ' || lower(source) WHEN lang='en' THEN 'other' WHEN lang='fr' THEN NULL ELSE lang END AS mode FROM documents""",
)


def _sentence(t):
    text = strings.render(
        "City 311 service request. Topic: ", F.col("case_topic"), ". Status: ", F.when(F.col("reason") != "5-LOW", F.col("reason")),
        ". Neighborhood: ", F.col("neighborhood"), ". Opened: ", F.date_format("open_date", "yyyy-MM-dd"), ". On time: ", F.col("on_time"), ".",
    )
    return requests(t).select("case_id", text.alias("text"))


SENTENCE = """'City 311 service request. Topic: ' || case_topic || '. Status: ' || CASE WHEN reason='5-LOW' THEN 'Unknown' ELSE reason END || '. Neighborhood: ' || neighborhood
 || '. Opened: ' || strftime(open_date,'%Y-%m-%d') || '. On time: ' || on_time || '.'"""
reg("str16_render_sentence", _sentence, f"WITH {REQ} SELECT case_id, {SENTENCE} AS text FROM req")


def records(t):
    """A table with (some of) the columns of each described dataset: (frame, key)."""
    crime = incidents(t).select("incident_number", "offense_description", "district", "hour", "shooting")
    service = requests(t).select("case_id", "case_topic", F.col("reason").alias("case_status"), "neighborhood", "on_time")
    food = t.orders.select("o_orderkey", F.col("o_custkey").alias("businessname"), F.col("o_orderpriority").alias("address"), F.col("o_orderstatus").alias("result"))
    score = t.events.select("event_id", F.col("event_type").alias("metric_name"), F.col("user_id").alias("day_score"), F.date_format("ts", "yyyy-MM-dd").alias("timestamp"))
    berdo = t.part.select("p_partkey", F.col("p_name").alias("property_name"), F.col("p_type").alias("property_type"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("energy_star_score"))
    street = t.supplier.select("s_suppkey", F.col("s_name").alias("full_street_name"), F.col("s_nationkey").alias("district"))
    return {
        "crime": (crime, "incident_number"), "service_311": (service, "case_id"), "food_inspections": (food, "o_orderkey"),
        "cityscore": (score, "event_id"), "berdo": (berdo, "p_partkey"), "street_sweeping": (street, "s_suppkey"),
    }


def described(t):
    """(dataset, source_key, text) of all six datasets, every row."""
    from tessera.operators import retrieval

    return retrieval.render_all({name: (df, strings.record(name, df.columns), key) for name, (df, key) in records(t).items()})


_RECORD_SQL = {
    "crime": ("inc", "incident_number", {"offense_description": "offense_description", "district": "district", "hour": "hour", "shooting": "shooting"}),
    "service_311": ("req", "case_id", {"case_topic": "case_topic", "case_status": "reason", "neighborhood": "neighborhood", "on_time": "on_time"}),
    "food_inspections": ("orders", "o_orderkey", {"businessname": "o_custkey", "address": "o_orderpriority", "result": "o_orderstatus"}),
    "cityscore": ("events", "event_id", {"metric_name": "event_type", "day_score": "user_id", "date|timestamp": "strftime(ts,'%Y-%m-%d')"}),
    "berdo": ("part", "p_partkey", {"property_name": "p_name", "property_type": "p_type", "energy_star_score": "CASE WHEN p_size>10 THEN p_size END"}),
    "street_sweeping": ("supplier", "s_suppkey", {"full_street_name": "s_name", "district": "s_nationkey"}),
}


def _described_sql(name):
    import re

    table, key, columns = _RECORD_SQL[name]
    text = re.sub(r"\{([^}]*)\}", lambda m: f"'||coalesce(({columns[m[1]]})::varchar,'Unknown')||'" if m[1] in columns else "Unknown", strings.RECORDS[name])
    return f"SELECT '{name}' AS dataset, {key}::bigint AS source_key, '{text}' AS text FROM {table}"


DESCRIBED_SQL = " UNION ALL ".join(map(_described_sql, _RECORD_SQL))
reg("str16_all_records", lambda t: described(t).withColumn("source_key", F.col("source_key").cast("bigint")), f"WITH {INC}, {REQ} {DESCRIBED_SQL}")
KW = ["license", "http", "The", "email"]
reg(
    "str17_keyword_coverage",
    lambda t: t.documents.withColumn("kw", F.array(*[F.lit(k) for k in KW])).select(
        "doc_id", F.array_join(strings.keyword_hits("text", "kw"), ",").alias("hits"), strings.keyword_coverage("text", "kw").alias("coverage")
    ),
    f"""WITH k AS (SELECT doc_id, list_filter({KW}, lambda k: contains(lower(text), lower(k))) AS h FROM documents)
SELECT doc_id, array_to_string(h, ',') AS hits, len(h)/4.0 AS coverage FROM k""",
)

# -- dates ---------------------------------------------------------------------------------------

reg(
    "dat1_parse_utc",
    lambda t: t.events.select("event_id", dates.parse_utc(F.when(F.col("event_type") == "error", "bad").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))).cast("timestamp_ntz").alias("ts")),
    "SELECT event_id, CASE WHEN event_type='error' THEN NULL ELSE date_trunc('second', ts) - INTERVAL 2 HOUR END AS ts FROM events",
)
reg(
    "dat2_date_parts",
    lambda t: t.events.select("event_id", *[c.cast("bigint").alias(n) for n, c in dates.date_parts("ts").items()]),
    "SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, isodow(ts)-1 AS dayofweek FROM events",
)
reg(
    "dat3_day_name_and_date",
    lambda t: t.events.select("event_id", dates.day_name("ts").alias("day_of_week"), F.to_date("ts").alias("date")),
    "SELECT event_id, dayname(ts) AS day_of_week, ts::date AS date FROM events",
)
reg(
    "dat4_weekend_and_night",
    lambda t: t.events.select("event_id", dates.is_weekend("ts").alias("is_weekend"), dates.is_night(F.hour("ts")).alias("is_night")),
    "SELECT event_id, isodow(ts)>=6 AS is_weekend, hour(ts)>=20 OR hour(ts)<6 AS is_night FROM events",
)
reg(
    "dat5_hour_bucket",
    lambda t: t.events.select("event_id", dates.hour_bucket(F.hour("ts")).alias("hour_bucket")),
    "SELECT event_id, (hour(ts)//4)::int AS hour_bucket FROM events",
)
reg(
    "dat6_day_period",
    lambda t: t.events.select("event_id", dates.day_period(F.hour("ts")).alias("period")),
    "SELECT event_id, CASE WHEN hour(ts)<6 THEN 'Night' WHEN hour(ts)<12 THEN 'Morning' WHEN hour(ts)<18 THEN 'Afternoon' ELSE 'Evening' END AS period FROM events",
)
reg(
    "dat7_clock_slot",
    lambda t: t.events.select("event_id", dates.clock_slot(F.when(F.col("event_type") != "error", F.date_format("ts", "HH:mm")).otherwise("noon")).alias("slot")),
    "SELECT event_id, CASE WHEN event_type='error' THEN 'Unknown' WHEN hour(ts)<6 THEN 'Overnight' WHEN hour(ts)<12 THEN 'Morning' ELSE 'Afternoon' END AS slot FROM events",
)
reg("dat8_duration_hours", _closed, f"WITH {CLOSED} SELECT * FROM j")
reg(
    "dat9_month_label",
    lambda t: t.orders.groupBy(dates.month_label("o_orderdate").alias("month")).agg(F.count("*").alias("n")),
    "SELECT strftime(o_orderdate,'%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1",
)

# -- math ----------------------------------------------------------------------------------------

reg(
    "mth1_safe_ratio",
    lambda t: rounded(t.lineitem.select("l_orderkey", numbers.ratio("l_extendedprice", "l_tax").alias("ratio"), numbers.ratio("l_quantity", "l_discount", 0.0).alias("or_zero"))),
    "SELECT l_orderkey, round(l_extendedprice/nullif(l_tax,0),6) AS ratio, round(coalesce(l_quantity/nullif(l_discount,0),0),6) AS or_zero FROM lineitem",
)
reg(
    "mth2_unit_conversion",
    lambda t: rounded(t.part.select("p_partkey", numbers.kwh_to_kbtu("p_retailprice").alias("kbtu"))),
    "SELECT p_partkey, round(p_retailprice*3.41214e0,6) AS kbtu FROM part",
)
reg(
    "mth3_rating",
    lambda t: t.part.select("p_partkey", numbers.rating(F.when(F.col("p_type") != "PROMO", F.col("p_size") * 2)).alias("rating")),
    "SELECT p_partkey, CASE WHEN p_type='PROMO' THEN 'Unknown' WHEN p_size*2>=75 THEN 'High' WHEN p_size*2>=50 THEN 'Medium' ELSE 'Low' END AS rating FROM part",
)
reg(
    "mth4_cap",
    lambda t: t.events.select("event_id", numbers.capped("value", 3.4).alias("trend")),
    "SELECT event_id, least(value, 3.4e0) AS trend FROM events",
)
reg(
    "mth5_clip_unit",
    lambda t: t.lineitem.select("l_orderkey", numbers.clip(F.col("l_discount") * 20 - 0.5, 0, 1).alias("score")),
    "SELECT l_orderkey, greatest(0e0, least(1e0, l_discount*20 - 0.5e0)) AS score FROM lineitem",
)


def _flags(t):
    """Schedule flags from part sizes: four week flags and five day flags as mixed text."""
    def flag(n, yes):
        return F.when(F.pmod(F.col("p_size"), F.lit(n)) == 0, yes).otherwise("N")

    return t.part.select(
        "p_partkey", F.col("p_brand").alias("district"), *[flag(1 if i < 3 else 2, "yes").alias(f"week_{i}") for i in (1, 2, 3, 4)],
        *[flag(i + 2, y).alias(d) for i, (d, y) in enumerate(zip(("monday", "tuesday", "wednesday", "thursday", "friday"), ("Y", "1", "True", "1.0", "y")))],
    )


WEEKS = ["week_1", "week_2", "week_3", "week_4"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday"]
DAYSUM = " + ".join(f"(p_size%{i + 2}=0)::int" for i in range(5))
EVERY = "(p_size%2=0)::int"
reg(
    "mth6_count_flags",
    lambda t: _flags(t).select("p_partkey", numbers.all_truthy(WEEKS).cast("int").alias("every_week"), numbers.count_truthy(DAYS, (*strings.TRUE_FLAGS, "1.0")).alias("days")),
    f"SELECT p_partkey, {EVERY} AS every_week, {DAYSUM} AS days FROM part",
)
reg(
    "mth7_category_code",
    lambda t: features.category_code(t.part.select("p_partkey", "p_brand"), "p_brand", "code"),
    "SELECT p_partkey, p_brand, (dense_rank() OVER (ORDER BY p_brand) - 1)::int AS code FROM part",
)


def _label_encode(t):
    from pyspark.ml.feature import StringIndexer

    df = t.orders.select("o_orderkey", "o_orderpriority")
    model = StringIndexer(inputCol="o_orderpriority", outputCol="code", stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).select("o_orderkey", F.col("code").cast("int").alias("code"))


reg("mth8_label_encoding", _label_encode, "SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::int AS code FROM orders")

# -- geometry ------------------------------------------------------------------------------------

GRID = "printf('%.3f_%.3f', round_even(lat/0.001e0,0)*0.001e0, round_even(long/0.001e0,0)*0.001e0)"
GRID_LAT = f"split_part({GRID},'_',1)::double"
GRID_LON = f"split_part({GRID},'_',2)::double"


def _grid(t):
    df = features.with_grid(incidents(t)).select("incident_number", "grid_cell")
    lat, lon = geo.grid_centre("grid_cell")
    return df.withColumns({"grid_lat": lat, "grid_long": lon})


reg("geo1_grid_cell", _grid, f"WITH {INC} SELECT incident_number, {GRID} AS grid_cell, {GRID_LAT} AS grid_lat, {GRID_LON} AS grid_long FROM inc")
reg(
    "geo2_hex_cell",
    lambda t: incidents(t).select("incident_number", "h3_index"),
    f"WITH {INC} SELECT incident_number, h3_index FROM inc",
)
RINGS = ", ".join(f"({a},{b},{k})" for a, b, k in geo.ring_offsets(2))


def _rings(t):
    q, r = geo.cell_axes("h3_index")
    cells = incidents(t).select("h3_index").distinct().select("h3_index", q.alias("q"), r.alias("r"), F.explode(geo.ring_array()).alias("o"))
    return cells.select("h3_index", geo.hex_id(F.col("q") + F.col("o.dq"), F.col("r") + F.col("o.dr")).alias("neighbour"), F.col("o.ring").alias("ring"))


reg(
    "geo3_neighbour_rings",
    _rings,
    f"""WITH {INC}, c AS (SELECT DISTINCT h3_index FROM inc), o(dq,dr,ring) AS (VALUES {RINGS})
SELECT h3_index, (split_part(h3_index,':',1)::int + dq) || ':' || (split_part(h3_index,':',2)::int + dr) AS neighbour, ring FROM c, o""",
)


def _lines(t):
    """A two-vertex WKT line per item, from its supplier's point to its part's point."""
    (lat, lon), (lat2, lon2) = point("l_suppkey"), point("l_partkey")
    wkt = F.format_string("LINESTRING (%.3f %.3f, %.3f %.3f)", lon, lat, lon2, lat2)
    a, b = geo.wkt_centroid(wkt)
    return rounded(t.lineitem.select("l_orderkey", a.alias("lat"), b.alias("lon")))


(SLAT, SLON), (PLAT, PLON) = point_sql("l_suppkey"), point_sql("l_partkey")
reg(
    "geo4_wkt_centroid",
    _lines,
    f"""SELECT l_orderkey, round((printf('%.3f',{SLAT})::double + printf('%.3f',{PLAT})::double)/2,6) AS lat,
 round((printf('%.3f',{SLON})::double + printf('%.3f',{PLON})::double)/2,6) AS lon FROM lineitem""",
)
BOXES = " ".join(f"WHEN long BETWEEN {x0}e0 AND {x1}e0 AND lat BETWEEN {y0}e0 AND {y1}e0 THEN '{n}'" for n, (x0, x1, y0, y1) in geo.DISTRICT_BOXES.items())
reg(
    "geo5_named_boxes",
    lambda t: incidents(t).select("incident_number", geo.first_box("lat", "long").alias("district")),
    f"WITH {INC} SELECT incident_number, CASE WHEN lat IS NULL OR long IS NULL THEN 'Unknown' {BOXES} ELSE 'Other' END AS district FROM inc",
)


def _areas(t):
    """Incidents in boxes around the places of customers, of 20 to 200 metres by account balance; the smallest key comes first."""
    lat, lon = point("c_custkey")
    half = F.lit(0.0001) + F.abs("c_acctbal") / 10000 * 0.002
    edges = {"min_lat": lat - half, "max_lat": lat + half, "min_lon": lon - half, "max_lon": lon + half}
    boxes = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("name"), F.col("c_custkey").alias("priority"), *[c.alias(n) for n, c in edges.items()])
    return areas.tag_areas(incidents(t).select("incident_number", "lat", "long"), boxes, ["incident_number"])


HALF = "(0.0001e0 + abs(c_acctbal) / 10000e0 * 0.002e0)"
reg(
    "geo5_areas_of_points",
    _areas,
    f"""WITH {INC}, b AS (SELECT c_custkey, {CLAT} - {HALF} AS y0, {CLAT} + {HALF} AS y1, {CLON} - {HALF} AS x0, {CLON} + {HALF} AS x1 FROM customer),
f AS (SELECT incident_number, min(c_custkey) AS c FROM inc JOIN b ON lat BETWEEN y0 AND y1 AND long BETWEEN x0 AND x1 GROUP BY 1)
SELECT incident_number, lat, long, CASE WHEN c IS NULL THEN 'Other' ELSE 'c' || c END AS area FROM inc LEFT JOIN f USING (incident_number)""",
)


def _bins(t):
    return incidents(t).select(
        "incident_number", geo.axis_bin("lat", 42.2, 42.4, 29).cast("int").alias("row"), geo.axis_bin("long", -71.2, -70.9, 29).cast("int").alias("col")
    )


def _bin_sql(c, lo, hi, n=29):
    return f"CASE WHEN {c} BETWEEN {lo}e0 AND {hi}e0 THEN least(floor({n}*({c}-({lo}e0))/({hi}e0-({lo}e0)))+1, {n})::int END"


BIN_LAT, BIN_LON = _bin_sql("lat", 42.2, 42.4), _bin_sql("long", -71.2, -70.9)
reg("geo6_two_axis_bins", _bins, f"WITH {INC} SELECT incident_number, {BIN_LAT} AS row, {BIN_LON} AS col FROM inc")

# -- arrays --------------------------------------------------------------------------------------

reg(
    "arr1_split_explode",
    lambda t: t.documents.select("doc_id", F.explode(arrays.split_trim("text", ",")).alias("piece")).groupBy("piece").agg(F.count("*").alias("n")),
    """WITH p AS (SELECT regexp_replace(unnest(string_split(text, ',')), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS piece FROM documents) SELECT piece, count(*) AS n FROM p WHERE piece <> '' GROUP BY 1""",
)


def _cosine(t):
    from tessera.operators.retrieval import mean_vectors

    c = mean_vectors(t.embeddings, "label").withColumnRenamed("embedding", "centre")
    j = t.embeddings.join(c, "label")
    return rounded(j.select("vec_id", arrays.cosine("embedding", "centre").alias("similarity")))


CENTRES = """d AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(x) AS x FROM d GROUP BY 1, 2), cen AS (SELECT label, list(x ORDER BY i) AS centre FROM m GROUP BY 1)"""
reg(
    "arr2_cosine",
    _cosine,
    f"WITH {CENTRES} SELECT vec_id, round(list_cosine_similarity(embedding::double[], centre), 6) AS similarity FROM embeddings JOIN cen USING (label)",
)


reg(
    "arr3_even_sample",
    lambda t: t.embeddings.select("vec_id", F.posexplode(arrays.even_sample("embedding", 50)).alias("position", "x")),
    """WITH s AS (SELECT vec_id, CASE WHEN len(embedding) > 50 THEN list_transform(range(50), lambda i: embedding[least(floor(i*((len(embedding)-1)/49e0))::int, len(embedding)-1)+1])
 ELSE embedding END AS path FROM embeddings) SELECT vec_id, (generate_subscripts(path,1)-1)::int AS position, unnest(path) AS x FROM s""",
)
