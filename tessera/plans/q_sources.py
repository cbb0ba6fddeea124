"""Queries of the sources, sinks and incremental-state sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.operators.joining import scalar, settle
from tessera.plans.registry import INC, incidents, reg, staged
from tessera.session import scratch_dir
from tessera.sources import layers, state, versions
from tessera.sources.scores import ScoreTable

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
DT = "date_trunc('month', o_orderdate)::date"
COLS = ORDER_COLS.split(", ")

reg(
    "src1_dated_partition",
    lambda t: staged(t).partition("requests", "raw", "1997-03-01").select(*COLS),
    f"SELECT {ORDER_COLS} FROM orders WHERE {DT} = DATE '1997-03-01'",
)
reg(
    "src2_partitions_between",
    lambda t: staged(t).between("requests", "raw", "1996-01-01", "1998-12-01", ["o_orderkey", "o_totalprice"]),
    f"""SELECT o_orderkey, o_totalprice, {DT} AS date FROM orders WHERE {DT} BETWEEN DATE '1996-01-01' AND DATE '1998-12-01'""",
)
reg(
    "src3_partition_dates",
    lambda t: staged(t).dates("requests", "raw", "1996-01-01", "1999-12-01"),
    f"SELECT DISTINCT {DT} AS dt FROM orders WHERE {DT} BETWEEN DATE '1996-01-01' AND DATE '1999-12-01'",
)
reg(
    "src5_latest_snapshot",
    lambda t: staged(t).latest("requests", "raw").select(*COLS),
    f"SELECT {ORDER_COLS} FROM orders WHERE {DT} = (SELECT max({DT}) FROM orders)",
)
reg(
    "src6_latest_for_serving",
    lambda t: staged(t).latest("requests", "raw").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("newest")),
    f"""SELECT o_orderstatus, count(*) AS n, max(o_orderdate) AS newest FROM orders WHERE {DT} = (SELECT max({DT}) FROM orders) GROUP BY 1""",
)
reg(
    "src7_trailing_history",
    lambda t: staged(t).trailing("requests", "raw", "2000-06-01", 90).select(*COLS),
    f"SELECT {ORDER_COLS} FROM orders WHERE {DT} > DATE '2000-06-01' - 90 AND {DT} <= DATE '2000-06-01'",
)


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


reg(
    "src8_incremental_range",
    lambda t: layers.incremental(t.orders, "o_orderdate", _ts("1996-05-10"), _ts("1999-08-20")),
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-05-10' AND o_orderdate <= TIMESTAMP '1999-08-20'",
)
reg(
    "src9_monthly_slices",
    lambda t: layers.by_month(t.lineitem, "l_shipdate", _ts("1996-02-15"), _ts("2000-02-15"))
    .groupBy("month_start")
    .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")),
    """SELECT date_trunc('month', l_shipdate)::date AS month_start, count(*) AS n, round(sum(l_quantity),2) AS qty, min(l_shipdate) AS first, max(l_shipdate) AS last
 FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-02-15' AND l_shipdate < TIMESTAMP '2000-02-15' GROUP BY 1""",
)


def _schedule_csv(t):
    path = scratch_dir(t.spark, "csv")
    layers.write_csv(
        t.part.select(F.col("p_partkey").alias("Main ID"), F.col("p_name").alias("ST NAME"), F.col("p_brand").alias("Dist"), F.col("p_type").alias("Side")),
        path,
    )
    contract = {
        "_id": "bigint", "sam_street_id": "bigint", "full_street_name": "string", "from_street": "string", "district": "string",
        "side_of_street": "string", "season_start": "string", "season_end": "string", "week_type": "string", "tow_zone": "string", "lat": "double",
    }
    mapping = {"main_id": "sam_street_id", "st_name": "full_street_name", "dist": "district", "side": "side_of_street"}
    defaults = {"season_start": "April", "season_end": "November", "week_type": "Every Week", "tow_zone": "YES"}
    return layers.schedule_csv(t.spark, path, mapping, defaults, contract, "sam_street_id")


reg(
    "src13_csv_schedule",
    _schedule_csv,
    """SELECT row_number() OVER (ORDER BY p_partkey) AS _id, p_partkey AS sam_street_id, p_name AS full_street_name, NULL::varchar AS from_street,
 p_brand AS district, p_type AS side_of_street, 'April' AS season_start, 'November' AS season_end, 'Every Week' AS week_type, 'YES' AS tow_zone, NULL::double AS lat FROM part""",
)


def _spreadsheet(t):
    path = scratch_dir(t.spark, "sheet")
    doc = t.documents.select(
        F.when(F.col("n_chars") > 2000, F.concat(F.lit("Note: footer text of the sheet, ignore this line "), F.col("doc_id").cast("string")))
        .otherwise(F.col("doc_id").cast("string"))
        .alias("BERDO ID"),
        F.when(F.col("lang") == "en", "Not Available").otherwise(F.col("lang")).alias("Property Name"),
        F.col("source").alias("Address"), F.col("n_chars").cast("string").alias("Gross Floor Area"),
    )
    layers.write_csv(doc, path)
    contract = {"berdo_id": "bigint", "property_name": "string", "address": "string", "gross_floor_area": "double", "zip": "string"}
    return layers.spreadsheet_csv(t.spark, path, {}, contract, "berdo_id")


reg(
    "src14_spreadsheet_extract",
    _spreadsheet,
    """SELECT doc_id AS berdo_id, CASE WHEN lang='en' THEN NULL ELSE lang END AS property_name, source AS address, n_chars::double AS gross_floor_area, NULL::varchar AS zip
 FROM documents WHERE n_chars <= 2000""",
)
reg(
    "src15_newest_sample",
    lambda t: sampling.newest(t.events, "ts", 100, "event_id"),
    "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100",
)
reg("src17_full_extract", lambda t: t.events, "SELECT * FROM events")


def _side_file(t):
    path = scratch_dir(t.spark, "report")
    report = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.max("o_orderdate").alias("newest"))
    layers.write_report(report.withColumn("newest", F.col("newest").cast("string")), path)
    return layers.read_report(t.spark, path, "o_orderstatus string, rows bigint, newest string")


reg(
    "src18_json_side_file",
    _side_file,
    "SELECT o_orderstatus, count(*) AS rows, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS newest FROM orders GROUP BY 1",
)


def _write_read(t):
    store = layers.LayerStore(t.spark, scratch_dir(t.spark, "snk1"))
    base = t.orders.withColumn("dt", F.trunc(F.col("o_orderdate").cast("date"), "YEAR"))
    store.write(base, "requests", "processed")
    # a second write replaces only the newest year
    newest = base.where(F.col("dt") == scalar(base, F.max("dt"))).withColumn("o_orderstatus", F.lower("o_orderstatus"))
    store.write(newest, "requests", "processed")
    return store.scan("requests", "processed").groupBy("dt", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


reg(
    "snk1_partition_overwrite",
    _write_read,
    """WITH b AS (SELECT *, date_trunc('year', o_orderdate)::date AS dt FROM orders)
SELECT dt, CASE WHEN dt = (SELECT max(dt) FROM b) THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus, count(*) AS n, round(sum(o_totalprice),2) AS total FROM b GROUP BY 1, 2""",
)


def _dated_scores(t):
    store = layers.LayerStore(t.spark, scratch_dir(t.spark, "snk2"))
    daily = incidents(t).groupBy("h3_index", F.to_date("occurred_on_date").alias("dt")).agg(F.sum("severity_weight").alias("score"))
    store.write(daily, "cells", "scores")
    return store.scan("cells", "scores").select("h3_index", "score", "dt")


reg(
    "snk2_dated_scores",
    _dated_scores,
    f"WITH {INC} SELECT h3_index, sum(severity_weight) AS score, occurred_on_date::date AS dt FROM inc GROUP BY h3_index, occurred_on_date::date",
)


def _scores(t):
    return incidents(t).groupBy("h3_index", "hour_bucket").agg(F.sum("severity_weight").alias("s"), F.count("*").alias("n"))


def _versions(t):
    """Stored scores of version 1 and newer scores of version 2 for the cells seen in the last ten days."""
    inc = incidents(t)
    old = _scores(t).select("h3_index", "hour_bucket", "s", F.lit("v1").alias("model_version"))
    recent = inc.where(F.col("occurred_on_date") >= scalar(inc, F.max("occurred_on_date")) - F.expr("INTERVAL 10 DAYS"))
    new = recent.groupBy("h3_index", "hour_bucket").agg(F.sum("severity_weight").alias("s")).withColumn("model_version", F.lit("v2"))
    return old, new


VERSIONS_SQL = f"""{INC}, old AS (SELECT h3_index, hour_bucket, sum(severity_weight) AS s, 'v1' AS model_version FROM inc GROUP BY 1, 2),
new AS (SELECT h3_index, hour_bucket, sum(severity_weight) AS s, 'v2' AS model_version FROM inc
 WHERE occurred_on_date >= (SELECT max(occurred_on_date) FROM inc) - INTERVAL 10 DAY GROUP BY 1, 2),
st AS (SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.h3_index=old.h3_index AND new.hour_bucket=old.hour_bucket) UNION ALL SELECT * FROM new)"""


def _stored(t):
    return state.upsert(*_versions(t), ["h3_index", "hour_bucket"])


def _published(t):
    """The stored table after both versions have been published to it."""
    table = ScoreTable(t.spark, scratch_dir(t.spark, "scores"), ["h3_index", "hour_bucket"], 16)
    for scores in _versions(t):
        table.upsert(scores)
    return table


def _after_drop(t):
    table = _published(t)
    table.drop_stale("v2")
    return table.read()


reg(
    "snk3_score_upsert",
    lambda t: _published(t).read().withColumn("doc_id", state.score_key()),
    f"WITH {VERSIONS_SQL} SELECT *, h3_index || '_' || hour_bucket AS doc_id FROM st",
)
reg("snk4_drop_stale", _after_drop, f"WITH {VERSIONS_SQL} SELECT * FROM st WHERE model_version >= 'v2'")
reg(
    "snk5_verify_publish",
    lambda t: state.verify_publish(_stored(t), "v2", scalar(_versions(t)[1], F.count("*"))),
    f"""WITH {VERSIONS_SQL} SELECT count(*) FILTER (WHERE model_version='v2') AS published, (SELECT count(*) FROM new) AS expected,
 count(*) FILTER (WHERE model_version='v2') >= 0.99 * (SELECT count(*) FROM new) AS ok FROM st""",
)
reg(
    "snk6_table_stats",
    lambda t: state.table_stats(_stored(t)),
    f"WITH {VERSIONS_SQL} SELECT model_version, count(*) AS rows FROM st GROUP BY ROLLUP (model_version)",
)


def _csv_export(t):
    path = scratch_dir(t.spark, "metrics")
    m = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("rate"))
    layers.write_csv(m, path)
    return layers.read_csv(t.spark, path).select("l_returnflag", F.col("n").try_cast("bigint").alias("n"), F.col("rate").try_cast("double").alias("rate"))


reg(
    "snk7_csv_metrics",
    _csv_export,
    "SELECT l_returnflag, count(*) AS n, round(avg(l_discount),6) AS rate FROM lineitem GROUP BY 1",
)

# -- watermarks and lineage ----------------------------------------------------------------------


def _marks(t):
    """Watermark history: one run per month and order status, as monthly batches would leave it."""
    return t.orders.groupBy(F.col("o_orderstatus").alias("dataset"), F.last_day(F.col("o_orderdate").cast("date")).alias("run_date")).agg(
        F.max("o_orderdate").alias("value")
    ).select("dataset", "value", "run_date")


MARKS = "m AS (SELECT o_orderstatus AS dataset, max(o_orderdate) AS value, last_day(o_orderdate::date) AS run_date FROM orders GROUP BY 1, 3)"


def _effective(t):
    cold = t.spark.createDataFrame([("cold",)], "dataset string")
    names = t.orders.select(F.col("o_orderstatus").alias("dataset")).distinct().unionByName(cold)
    return state.effective_watermarks(names, state.set_watermarks(_marks(t), _marks(t).limit(0)), scalar(t.orders, F.max("o_orderdate")), 30)


reg(
    "inc1_effective_watermarks",
    _effective,
    f"""WITH {MARKS}, d AS (SELECT DISTINCT o_orderstatus AS dataset FROM orders UNION ALL SELECT 'cold'),
c AS (SELECT dataset, arg_max(value, run_date) AS value FROM m GROUP BY 1)
SELECT d.dataset, coalesce(c.value, (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY) AS value FROM d LEFT JOIN c USING (dataset)""",
)
reg(
    "inc1_watermark_history",
    lambda t: state.set_watermarks(_marks(t), state.batch_watermark(t.lineitem, "L", "l_shipdate")),
    f"""WITH {MARKS}, a AS (SELECT * FROM m UNION ALL SELECT 'L', max(l_shipdate), max(l_shipdate)::date FROM lineitem)
SELECT dataset, value, run_date FROM a QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY run_date DESC, value DESC) <= 10""",
)
reg(
    "inc5_advance_watermark",
    lambda t: state.batch_watermark(t.events, "events", "ts"),
    "SELECT 'events' AS dataset, max(ts) AS value, max(ts)::date AS run_date FROM events",
)


def _ingest_stats(t):
    """What the write of a raw layer says of its rows."""
    store = layers.LayerStore(t.spark, scratch_dir(t.spark, "inc6"))
    seen = store.write_counted(t.events, "events", "raw", "2024-01-01", watermark_end=F.max("ts"))
    return t.spark.createDataFrame([(seen["rows"], seen["watermark_end"], len(t.events.columns))], "rows bigint, watermark_end timestamp_ntz, columns int")


reg(
    "inc6_ingest_stats",
    _ingest_stats,
    "SELECT count(*) AS rows, max(ts) AS watermark_end, 6 AS columns FROM events",
)


def _row_hash():
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"))), 1, 15), 16, 10)


def _manifest(t):
    """Manifest of monthly runs over two layers; the rows' hash is 60 bits of a digest that SQL has too."""
    raw = t.orders.select("*", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("run"))
    out = None
    for layer, df, col in (("raw", raw, F.lit("s1")), ("processed", raw.where("o_orderstatus <> 'P'"), F.lit("s2"))):
        m = state.lineage_rows(df, "requests", layer, "run", col, _row_hash())
        out = m if out is None else out.unionByName(m)
    return out


VERSION = "sum(('0x'||substr(md5(o_orderkey::varchar||'|'||o_custkey::varchar||'|'||o_orderstatus), 1, 15))::bigint)::varchar||'-'||count(*)::varchar"
MANIFEST = f"""mf AS (SELECT date_trunc('month', o_orderdate)::date AS run_date, 'requests' AS dataset, 'raw' AS layer, count(*) AS rows, 's1' AS schema_version, {VERSION} AS version FROM orders GROUP BY 1
UNION ALL SELECT date_trunc('month', o_orderdate)::date, 'requests', 'processed', count(*), 's2', {VERSION} FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)"""
reg("lin1_record_runs", _manifest, f"WITH {MANIFEST} SELECT * FROM mf")
reg(
    "lin2_recent_runs",
    lambda t: state.history(_manifest(t), "requests", 10),
    f"WITH {MANIFEST} SELECT * FROM mf WHERE dataset='requests' ORDER BY run_date DESC, layer LIMIT 10",
)
reg(
    "lin3_runs_with_schema",
    lambda t: state.runs_with_schema(_manifest(t), "processed", "s2"),
    f"WITH {MANIFEST} SELECT * FROM mf WHERE layer='processed' AND schema_version='s2'",
)


def _run_diff(t):
    m = _manifest(t)
    last = scalar(m, F.max("run_date"))
    return state.compare_runs(m, "requests", F.add_months(last, -1), last)


reg(
    "lin4_compare_runs",
    _run_diff,
    f"""WITH {MANIFEST}, l AS (SELECT max(run_date) AS b, (max(run_date) - INTERVAL 1 MONTH)::date AS a FROM mf),
x AS (SELECT layer, max(version) FILTER (WHERE run_date=l.a) AS va, max(version) FILTER (WHERE run_date=l.b) AS vb,
 max(rows) FILTER (WHERE run_date=l.a) AS rows_from, max(rows) FILTER (WHERE run_date=l.b) AS rows_to FROM mf, l WHERE run_date IN (l.a, l.b) GROUP BY layer)
SELECT layer, CASE WHEN va IS NULL THEN 'added' WHEN vb IS NULL THEN 'removed' WHEN va <> vb THEN 'changed' ELSE 'same' END AS status, rows_from, rows_to FROM x""",
)


def _file_digests(t):
    """A text file of order keys for each month, and what the files' digests are."""
    path = scratch_dir(t.spark, "lin5")
    lines = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("value"), "o_orderkey")
    lines.repartition("month").sortWithinPartitions("month", "o_orderkey").drop("o_orderkey").write.partitionBy("month").text(path)
    return versions.file_digests(t.spark, path, {"month": "string"}, "*.txt").select("month", "size", "digest")


reg(
    "lin5_file_digests",
    _file_digests,
    """WITH f AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, string_agg(o_orderkey || ',' || o_orderstatus || chr(10), '' ORDER BY o_orderkey) AS content FROM orders GROUP BY 1)
SELECT month, strlen(content)::bigint AS size, md5(content) AS digest FROM f""",
)


def _file_versions(t):
    """Three recordings: all dates, the newest one overwritten, and once more without a change."""
    store = layers.LayerStore(t.spark, scratch_dir(t.spark, "lin5"))
    store.write(t.orders.withColumn("dt", F.trunc(F.col("o_orderdate").cast("date"), "MM")), "requests", "raw")
    log = versions.VersionLog(store)
    log.record("requests", "raw")
    last = store.stored_dates("requests", "raw")[-1]
    store.write(settle(store.partition("requests", "raw", last).withColumn("o_orderstatus", F.lower("o_orderstatus"))).drop("dt"), "requests", "raw", last)
    log.record("requests", "raw")
    log.record("requests", "raw")
    rows = store.files("requests", "raw").groupBy("dt").agg(F.count("*").alias("stored"), F.sum("rows").alias("rows"))
    seen = log.versions("requests", "raw").join(rows, "dt")
    return seen.select("dt", "generation", "is_live", F.when(F.col("is_live"), F.col("files") == F.col("stored")).alias("complete"), "rows")


reg(
    "lin5_file_versions",
    _file_versions,
    f"""WITH d AS (SELECT {DT} AS dt, count(*) AS rows FROM orders GROUP BY 1), m AS (SELECT max(dt) AS dt FROM d)
SELECT dt, 1::bigint AS generation, dt <> (SELECT dt FROM m) AS is_live, CASE WHEN dt <> (SELECT dt FROM m) THEN true END AS complete, rows FROM d
UNION ALL SELECT dt, 2, true, true, rows FROM d WHERE dt = (SELECT dt FROM m)""",
)
