"""Queries of the streaming and user-extension sections. Streams replay the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import routes
from tessera.operators.joining import constant
from tessera.plans import datasets
from tessera.plans.q_tables import SCORE_SQL, score_table
from tessera.plans.registry import incidents, reg, rounded
from tessera.sources import state
from tessera.session import scratch_dir
from tessera.streaming import alerts, metrics

CODE_SQL = "CASE WHEN event_type='error' THEN 500 WHEN event_type='signup' AND value>20 THEN 404 ELSE 200 END"
EV = f"ev AS (SELECT *, {CODE_SQL} AS status_code, {CODE_SQL}::varchar AS status FROM events)"


def shaped(df):
    is_missing = (F.col("event_type") == "signup") & (F.col("value") > 20)
    code = F.when(F.col("event_type") == "error", 500).when(is_missing, 404).otherwise(200)
    return df.withColumns({"ts": F.col("ts").cast("timestamp"), "status_code": code, "status": code.cast("string")})


def event_stream(t):
    """Events as a file stream, with a status code."""
    return shaped(metrics.table_stream(t.spark, t.folder, "events", t.events.schema))


def plain(df):
    """Back to zone-less times in the output."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, k in df.dtypes if k == "timestamp"})


#: Event time for which partials of a stream stay open; older rows are counted all the same.
RETENTION = "2 days"


def sliced(t, n=4, closes: int | None = None):
    """Events as a stream of several triggers, and what writes its files, one stretch of time after the other. A stretch may be
    many files and is one trigger: were it several, the first would close windows that the others have rows of.

    With ``closes``, the seconds of a window and its grace, a last row without values comes so much after the newest event:
    it moves the watermark past the windows that are still open, so that they count too. Its own window stays open."""
    folder = scratch_dir(t.spark, "slices")
    first, last = t.events.agg(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))

    def part(k):
        low, high = (first + (last + 1 - first) * i // n for i in (k, k + 1))
        return lambda: t.events.where((at >= low) & (at < high)).write.mode("append").parquet(folder)

    t.events.limit(0).write.parquet(folder)  # the stream needs the folder

    def end():
        after = F.timestamp_micros(F.lit(last + closes * 1_000_000 + 1000))  # the watermark is in milliseconds
        row = [(after if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in t.events.schema]
        t.spark.range(1).select(*row).write.mode("append").parquet(folder)

    parts = [part(k) for k in range(n)] if first is not None else []
    if parts and closes is not None:
        parts.append(end)
    return shaped(metrics.file_stream(t.spark, folder, t.events.schema, "*.parquet", files_per_trigger=None)), parts


def replay(stream, spec, name):
    return rounded(plain(metrics.replayed(stream, spec, name, RETENTION)))


def batch(df, spec):
    return rounded(plain(metrics.at_once(df, spec)))


WIN = "time_bucket(INTERVAL {w}, ts) AS window_start"
MINUTE = WIN.format(w="60 seconds")
LAT = f"SELECT {MINUTE}, round(avg(value),6) AS mean_latency, max(value) AS max_latency FROM ev GROUP BY 1"
reg("stm1_latency_windows", lambda t: replay(event_stream(t), metrics.latency(), "stm1"), f"WITH {EV} {LAT}")
reg("stm1_latency_windows_batch", lambda t: batch(shaped(t.events), metrics.latency()), f"WITH {EV} {LAT}")
SUMS = f"SELECT {MINUTE}, status, count(*) AS requests, count(*) FILTER (WHERE status_code>=400) AS errors, count(*) FILTER (WHERE status_code=404) AS not_found FROM ev GROUP BY 1, 2"
reg("stm2_request_sums", lambda t: replay(event_stream(t), metrics.request_sums(), "stm2"), f"WITH {EV} {SUMS}")
reg("stm2_request_sums_batch", lambda t: batch(shaped(t.events), metrics.request_sums()), f"WITH {EV} {SUMS}")


def tiered(df):
    return df.withColumn("tier", numbers.risk_tier(F.least(F.col("value") * 5, F.lit(100.0))))


TIERS = f"""SELECT {WIN.format(w='300 seconds')}, CASE WHEN value*5>=66 THEN 'HIGH' WHEN value*5>=33 THEN 'MEDIUM' ELSE 'LOW' END AS tier, count(*) AS served, round(avg(value),6) AS mean_value FROM ev GROUP BY 1, 2"""
reg("stm3_tier_counts", lambda t: replay(tiered(event_stream(t)), metrics.tier_counts(), "stm3"), f"WITH {EV} {TIERS}")
reg("stm3_tier_counts_batch", lambda t: batch(tiered(shaped(t.events)), metrics.tier_counts()), f"WITH {EV} {TIERS}")
SERIES = f"SELECT {WIN.format(w='1 day')}, event_type AS feature, round(avg(value),6) AS mean_drift, max(value) AS max_drift FROM ev GROUP BY 1, 2"
reg("stm4_drift_series", lambda t: replay(event_stream(t).withColumnRenamed("event_type", "feature"), metrics.drift_series(), "stm4"), f"WITH {EV} {SERIES}")
reg("stm4_drift_series_batch", lambda t: batch(shaped(t.events).withColumnRenamed("event_type", "feature"), metrics.drift_series()), f"WITH {EV} {SERIES}")


#: Alerts wait this long for late rows before a window counts.
GRACE = "10 minutes"
GRACE_S = 600


def _breaches(t):
    """Peak value above a limit for three hours in a row, as alerts of a stream of several triggers."""
    events, parts = sliced(t, closes=3600 + GRACE_S)
    fired = alerts.sustained(events, "ts", "value", 20.0, run=3, seconds=3600, late=GRACE)
    return plain(metrics.run_available(fired, "stm5", None, mode="append", parts=parts))


reg(
    "stm5_sustained_breach",
    _breaches,
    """WITH h AS (SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, max(value) AS peak FROM events GROUP BY 1 HAVING max(value) > 20)
SELECT window_start, peak FROM (SELECT *, count(*) OVER (ORDER BY window_start RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS n FROM h) WHERE n = 3""",
)


def _typed_breaches(t):
    """The same for each type of event, two windows of ten minutes in a row."""
    events, parts = sliced(t)
    fired = alerts.sustained(events, "ts", "value", 15.0, run=2, seconds=600, late=GRACE, keys=["event_type"])
    return plain(metrics.run_available(fired, "stm5_typed", None, mode="append", parts=parts))


# a stream alerts once a window is closed: when the newest row is GRACE past its end
reg(
    "stm5_breach_by_type",
    _typed_breaches,
    """WITH h AS (SELECT event_type, time_bucket(INTERVAL 10 minute, ts) AS window_start, max(value) AS peak FROM events GROUP BY 1, 2 HAVING max(value) > 15
 AND window_start + INTERVAL 10 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE)
SELECT event_type, window_start, peak FROM (SELECT *, count(*) OVER (PARTITION BY event_type ORDER BY window_start RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS n FROM h) WHERE n = 2""",
)


def _rules(t):
    """Threshold rules over the windowed sums of a stream, which fire when a window is closed or the replay ends."""
    sums = [F.count_if(F.col("status_code") >= 400).alias("errors"), F.avg("value").alias("mean_value")]
    events, parts = sliced(t, closes=86_400 + GRACE_S)
    w = metrics.windowed(events, "ts", "1 day", [], sums, late=GRACE)
    fired = metrics.threshold_alerts(w, [("error_count", "errors", 60), ("mean_value", "mean_value", 11)])
    return rounded(plain(metrics.run_available(fired, "stm5_rules", None, mode="append", parts=parts)))


reg(
    "stm5_threshold_alerts",
    _rules,
    f"""WITH {EV}, w AS (SELECT {WIN.format(w='1 day')}, count(*) FILTER (WHERE status_code>=400)::double AS errors, avg(value) AS m FROM ev GROUP BY 1)
SELECT window_start, 'error_count' AS alert, errors AS observed, 60e0 AS "limit" FROM w WHERE errors>60 UNION ALL SELECT window_start, 'mean_value', round(m,6), 11e0 FROM w WHERE m>11""",
)


def _alerts(t):
    e = event_stream(t)
    return e.select(F.concat_ws(":", F.lit("warning"), "event_type", F.lit("events")).alias("alert_key"), F.col("event_id").alias("alert_id"), "ts")


reg(
    "stm6_alert_suppression",
    lambda t: plain(metrics.run_available(alerts.suppress(_alerts(t), 30, 3), "stm6", None, mode="append")),
    """WITH RECURSIVE al AS (SELECT 'warning:'||event_type||':events' AS alert_key, event_id AS alert_id, ts FROM events),
f AS (SELECT alert_key, arg_min(alert_id, (ts, alert_id)) AS alert_id, min(ts) AS ts, 1 AS c FROM al GROUP BY 1
 UNION ALL SELECT alert_key, alert_id, ts, c FROM (SELECT f.alert_key, al.alert_id, al.ts, CASE WHEN al.ts > f.ts + INTERVAL 1 HOUR THEN 1 ELSE f.c+1 END AS c, row_number() OVER (PARTITION BY f.alert_key ORDER BY al.ts, al.alert_id) AS i
 FROM f JOIN al ON al.alert_key=f.alert_key AND al.ts >= f.ts + CASE WHEN f.c>=3 THEN INTERVAL 60 MINUTE ELSE INTERVAL 30 MINUTE END) WHERE i=1) SELECT alert_key, alert_id, ts FROM f""",
)


def _sessions(t):
    s = metrics.table_stream(t.spark, t.folder, "conversations", t.conversations.schema)
    return metrics.session_rows(metrics.run_available(alerts.session_history(s, 2), "stm7", ["conv_id"]))


reg(
    "stm7_session_history",
    _sessions,
    "SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4",
)


def _points(t):
    m = metrics.request_metrics(event_stream(t), ["event_id"])
    return metrics.run_available(m, "stm8", None, mode="append").select("event_id", "metric", "point", F.col("labels")["status"].alias("status"))


reg(
    "stm8_request_metrics",
    _points,
    f"""WITH {EV} SELECT event_id, 'request_latency' AS metric, value AS point, status FROM ev UNION ALL SELECT event_id, 'request_count', 1e0, status FROM ev UNION ALL SELECT event_id, 'request_error', (status_code>=400)::int::double, status FROM ev""",
)
reg(
    "stm9_score_metrics",
    lambda t: metrics.score_metrics(routes.lookup_scores(incidents(t).select("incident_number", "h3_index", "hour_bucket"), score_table(t)), ["incident_number"]),
    f"""WITH {SCORE_SQL} SELECT incident_number, CASE WHEN risk_score IS NOT NULL THEN 'score_served' ELSE 'score_not_found' END AS metric, coalesce(risk_score,1e0) AS point, coalesce(risk_tier,'MEDIUM') AS tier FROM inc LEFT JOIN s USING (h3_index, hour_bucket)""",
)


def _ingest(t):
    since = constant(t.events, F.max("ts")).cast("timestamp") - F.expr("INTERVAL 20 DAYS")
    new = event_stream(t).drop("status", "status_code").where(F.col("ts") >= since)
    return plain(metrics.replayed(new, metrics.new_rows(["event_id"], "ts"), "stm10", RETENTION))


reg("stm10_incremental_ingest", _ingest, "SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 20 DAY")
reg(
    "stm11_severity_routing",
    lambda t: state.route(t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "critical").when(F.col("o_orderpriority") == "2-HIGH", "warning").otherwise("info").alias("severity"))),
    """WITH a AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'warning' ELSE 'info' END AS severity FROM orders)
SELECT *, unnest(CASE WHEN severity='critical' THEN ['log','slack','email'] ELSE ['log'] END) AS channel FROM a""",
)

# -- user extensions -----------------------------------------------------------------------------


def _user_plan():
    """A user-defined dataset: its own reader, cleaner and feature builder."""
    return datasets.DatasetPlan(
        name="orders_by_user",
        reader=lambda t: t.orders,
        mappings={"o_orderkey": "id", "o_custkey": "customer", "o_orderdate": "at", "o_totalprice": "amount"},
        types={"amount": "float", "id": "int"},
        keys=["id"],
        order=["at"],
        time="at",
        transform=lambda df, as_of: df.where(F.col("amount") > 1000).withColumn("month", F.date_format("at", "yyyy-MM")),
        output=["id", "customer", "at", "month", "amount"],
        features=lambda df, as_of: df.groupBy("customer").agg(F.count("*").alias("orders"), F.round(F.sum("amount"), 2).alias("amount"), F.max("month").alias("last_month")),
        definitions=[("orders", 1.0, None), ("amount", 0.0, None)],
    )


UCLEAN = "u AS (SELECT o_orderkey AS id, o_custkey AS customer, o_orderdate AS at, strftime(o_orderdate,'%Y-%m') AS month, o_totalprice AS amount FROM orders WHERE o_totalprice > 1000)"
reg("udf1_custom_cleaner", lambda t: datasets.clean(_user_plan(), _user_plan().reader(t)), f"WITH {UCLEAN} SELECT * FROM u")
reg(
    "udf2_custom_features",
    lambda t: datasets.build(_user_plan(), datasets.clean(_user_plan(), _user_plan().reader(t))),
    f"WITH {UCLEAN} SELECT customer, count(*) AS orders, round(sum(amount),2) AS amount, max(month) AS last_month FROM u GROUP BY 1",
)
reg(
    "udf3_custom_reader",
    lambda t: datasets.ingest(_user_plan(), _user_plan().reader(t), F.lit("1999-01-01").cast("timestamp_ntz"), time="o_orderdate"),
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'",
)
