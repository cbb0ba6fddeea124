"""Queries of the slicing, fairness and mitigation sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import dates
from tessera.operators import fairness, mitigation, slices
from tessera.operators.joining import settle
from tessera.plans.q_tables import hash_sql
from tessera.plans.registry import INC, REQ, incidents, reg, requests, rounded
from tessera.session import scratch_dir
from tessera.sources.layers import LayerStore

# -- slices --------------------------------------------------------------------------------------

reg(
    "sli1_by_category",
    lambda t: rounded(slices.by_category(t.documents, "source", 45)),
    "SELECT 'source' AS dimension, source AS value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM documents),6) AS pct FROM documents GROUP BY source HAVING count(*) >= 45",
)
QE = "e AS (SELECT quantile_cont(o_totalprice,0.0) AS e0, quantile_cont(o_totalprice,0.25) AS e1, quantile_cont(o_totalprice,0.5) AS e2, quantile_cont(o_totalprice,0.75) AS e3 FROM orders)"
QL = "CASE WHEN o_totalprice<=e1 THEN 'Q1' WHEN o_totalprice<=e2 THEN 'Q2' WHEN o_totalprice<=e3 THEN 'Q3' ELSE 'Q4' END"
reg(
    "sli2_by_quantiles",
    lambda t: rounded(slices.by_quantiles(t.orders, "o_totalprice")),
    f"WITH {QE} SELECT 'o_totalprice_quantile' AS dimension, {QL} AS value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM orders),6) AS pct FROM orders, e GROUP BY 2",
)
RANGES = [(0, 10, "small"), (10, 30, "mid"), (30, 45, "large")]
reg(
    "sli3_by_ranges",
    lambda t: rounded(slices.by_ranges(t.part, "p_size", RANGES)),
    """SELECT 'p_size_range' AS dimension, CASE WHEN p_size<10 THEN 'small' WHEN p_size<30 THEN 'mid' ELSE 'large' END AS value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM part),6) AS pct FROM part WHERE p_size>=0 AND p_size<45 GROUP BY 2""",
)
TOD = "CASE WHEN hour<6 THEN 'night' WHEN hour<12 THEN 'morning' WHEN hour<18 THEN 'afternoon' ELSE 'evening' END"
reg(
    "sli4_by_time_of_day",
    lambda t: rounded(slices.by_time_of_day(incidents(t), "hour")),
    f"WITH {INC} SELECT 'hour_range' AS dimension, {TOD} AS value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM inc),6) AS pct FROM inc GROUP BY 2",
)
reg(
    "sli6_cross_slices",
    lambda t: rounded(slices.cross(t.documents, ["lang", "source"], 20)),
    "SELECT 'lang_x_source' AS dimension, lang||'_x_'||source AS value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM documents),6) AS pct FROM documents GROUP BY lang, source HAVING count(*) >= 20",
)


def _default_dims(t):
    return requests(t).select("neighborhood", F.hour("open_date").alias("hour_of_day"), dates.day_name("open_date").alias("day_of_week"), F.col("amount"))


reg(
    "sli7_slice_summary",
    lambda t: rounded(slices.summary(_default_dims(t), ["neighborhood", "hour_of_day", "day_of_week", "amount", "absent"])),
    f"""WITH {REQ}, e AS (SELECT quantile_cont(amount,0.25) AS e1, quantile_cont(amount,0.5) AS e2, quantile_cont(amount,0.75) AS e3 FROM req),
s AS (SELECT 'neighborhood' AS dimension, neighborhood AS value FROM req UNION ALL SELECT 'hour_of_day_range', 'night' FROM req UNION ALL SELECT 'day_of_week', dayname(open_date) FROM req
 UNION ALL SELECT 'amount_quantile', CASE WHEN amount<=e1 THEN 'Q1' WHEN amount<=e2 THEN 'Q2' WHEN amount<=e3 THEN 'Q3' ELSE 'Q4' END FROM req, e)
SELECT dimension, value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM req),6) AS pct FROM s GROUP BY 1, 2""",
)
reg(
    "top3_slices_by_size",
    lambda t: rounded(slices.by_category(t.documents, "source").orderBy(F.desc("size"), "value")),
    "SELECT 'source' AS dimension, source AS value, count(*) AS size, round(count(*)*100/(SELECT count(*) FROM documents),6) AS pct FROM documents GROUP BY source",
)


def _sparse(t):
    return t.documents.select("doc_id", "lang", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("size")).join(t.labels, "doc_id", "left")


SPARSE = "sp AS (SELECT doc_id, lang, CASE WHEN n_chars>500 THEN n_chars END AS size, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"
reg(
    "sli8_slices_with_missing",
    lambda t: rounded(slices.with_missing(_sparse(t).withColumnRenamed("size", "chars"), "lang"), 4),
    f"""WITH {SPARSE} SELECT lang, count(*) AS size, round((avg((doc_id IS NULL)::int)+avg((size IS NULL)::int)+avg((quality IS NULL)::int)+avg((toxic IS NULL)::int))/4*100,4) AS mean_missing_pct,
 round(count(*)*100/(SELECT count(*) FROM sp),4) AS pct FROM sp GROUP BY 1""",
)
reg(
    "sli9_null_percentages",
    lambda t: rounded(slices.null_percentages(_sparse(t), "lang", ["size", "quality"]), 4),
    f"WITH {SPARSE} SELECT lang, round(avg((size IS NULL)::int)*100,4) AS size_null_pct, round(avg((quality IS NULL)::int)*100,4) AS quality_null_pct FROM sp GROUP BY 1",
)
reg(
    "sli10_unusual_rates",
    lambda t: rounded(slices.unusual_rates(t.documents, "source", "n_chars", 0.1)),
    """WITH o AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS s FROM documents), g AS (SELECT source, avg(n_chars) AS rate, count(n_chars) AS n FROM documents GROUP BY 1)
SELECT source, round(rate,6) AS rate, n, round((rate-m)/s,6) AS z_score, abs((rate-m)/s) > 0.1 AS flagged, round((rate-m)*100/m,6) AS deviation_pct FROM g, o""",
)
reg(
    "sli11_unusual_sizes",
    lambda t: rounded(slices.unusual_sizes(t.documents, "lang")),
    """WITH g AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), o AS (SELECT avg(n) AS m, stddev_samp(n) AS s FROM g), z AS (SELECT lang, n, m, CASE WHEN s>0 THEN (n-m)/s ELSE 0 END AS z FROM g, o)
SELECT lang, n, round(z,6) AS z_score, abs(z) > 1 AS flagged, round((n-m)*100/m,6) AS deviation_pct FROM z""",
)
reg(
    "sli12_representation_bands",
    lambda t: rounded(slices.representation_bands(t.documents, "lang", 15.0)),
    """WITH g AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), o AS (SELECT sum(n) AS t, sum(n)/count(*) AS e FROM g)
SELECT lang, n, round(n*100/t,6) AS pct, n*100/t < 15 AS under_represented, CASE WHEN n<e*0.7 THEN 'low' WHEN n<e*0.9 THEN 'mid' ELSE 'ok' END AS band FROM g, o""",
)
reg(
    "sli13_high_medians",
    lambda t: rounded(slices.high_medians(t.lineitem.withColumn("loss", F.col("l_extendedprice") * F.when(F.col("l_returnflag") == "R", 4.0).otherwise(1.0)), "l_returnflag", "loss"), 4),
    """WITH x AS (SELECT l_returnflag, l_extendedprice*CASE WHEN l_returnflag='R' THEN 4e0 ELSE 1e0 END AS loss FROM lineitem), g AS (SELECT l_returnflag, median(loss) AS m FROM x GROUP BY 1)
SELECT l_returnflag, round(m,4) AS median, m >= 2*(SELECT median(loss) FROM x) AS flagged FROM g""",
)
reg(
    "sli13_small_groups",
    lambda t: slices.small_groups(t.documents.withColumn("slice", F.concat_ws("/", "lang", "source")), "slice", 0.5),
    """WITH g AS (SELECT lang||'/'||source AS slice, count(*) AS n FROM documents GROUP BY 1) SELECT slice, n FROM g WHERE n <= 0.5*(SELECT avg(n) FROM g)""",
)

# -- fairness ------------------------------------------------------------------------------------


def labelled(t):
    return t.documents.drop("text").join(t.labels, "doc_id")


LAB = "lb AS (SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id))"
SHARES = {"EN": 0.5, "fr": 30.0}
EXPECT = "CASE lang WHEN 'en' THEN 50e0 WHEN 'fr' THEN 30e0 ELSE 100e0/(SELECT count(*) FROM g) END"


def sev(x, a, b):
    return f"CASE WHEN {x}>={b} THEN 'critical' WHEN {x}>={a} THEN 'warning' ELSE 'none' END"


REP = f"""g AS (SELECT lang, count(*) AS n FROM lb GROUP BY 1), rep AS (SELECT 'representation' AS metric, 'lang' AS dimension, lang AS value, n AS size, {EXPECT} AS expected, n*100/(SELECT count(*) FROM lb) AS actual FROM g),
repd AS (SELECT *, abs(actual-expected)/expected AS disparity FROM rep)"""
REPF = f"SELECT metric, dimension, value, size, round(expected,6) AS expected, round(actual,6) AS actual, round(disparity,6) AS disparity, {sev('disparity', 0.6, 1.5)} AS severity FROM repd"


def outs(dim, out):
    return f"""(WITH h AS (SELECT {dim} AS value, count(*) AS size, avg({out}) AS rate FROM lb GROUP BY 1), a AS (SELECT sum(rate*size)/sum(size) AS o FROM h)
 SELECT 'outcome_disparity' AS metric, '{dim}' AS dimension, value, size, round(o,6) AS expected, round(rate,6) AS actual, round(abs(rate-o)/o,6) AS disparity, {sev('abs(rate-o)/o', 0.25, 0.5)} AS severity FROM h, a)"""


reg("fai1_representation", lambda t: rounded(fairness.representation(labelled(t), "lang", SHARES)), f"WITH {LAB}, {REP} {REPF}")
reg("fai2_outcome_disparity", lambda t: rounded(fairness.outcome_disparity(labelled(t), "source", "toxic")), f"WITH {LAB} SELECT * FROM {outs('source', 'toxic')}")
MISSING_DIM = "SELECT 'dimension_missing' AS metric, 'absent' AS dimension, NULL::varchar AS value, 0 AS size, 0e0 AS expected, 0e0 AS actual, 0e0 AS disparity, 'warning' AS severity"
EVAL = f"{REPF} UNION ALL SELECT * FROM {outs('lang', 'toxic')} UNION ALL {MISSING_DIM}"


def _evaluate(t, **kw):
    return fairness.evaluate(labelled(t), ["lang", "absent"], "toxic", {"lang": SHARES}, **kw)


reg("fai3_evaluate", lambda t: rounded(_evaluate(t)), f"WITH {LAB}, {REP} SELECT * FROM ({EVAL}) WHERE severity <> 'none'")
reg(
    "fai3_report",
    lambda t: fairness.report(_evaluate(t)),
    f"""WITH {LAB}, {REP} SELECT count(*) AS violations, count(*) FILTER (WHERE severity='warning') AS warnings, count(*) FILTER (WHERE severity='critical') AS criticals, count(*) FILTER (WHERE severity='critical')=0 AS passed
 FROM ({EVAL}) WHERE severity <> 'none'""",
)


def predicted(t):
    """Labels with a rule-based prediction and a score, so that groups differ."""
    d = labelled(t)
    score = F.pmod(F.col("doc_id") * 37 + F.col("n_chars"), F.lit(100)) / 100.0
    return d.withColumns({"score": score, "pred": (score > F.when(F.col("lang") == "en", 0.2).otherwise(0.4)).cast("int")})


PRED = f"""{LAB}, s0 AS (SELECT *, ((doc_id*37+n_chars)%100)/100e0 AS score FROM lb), pr AS (SELECT *, (score > CASE WHEN lang='en' THEN 0.2e0 ELSE 0.4e0 END)::int AS pred FROM s0)"""
reg(
    "fai4_prediction_fairness",
    lambda t: rounded(fairness.evaluate(predicted(t), ["lang"], "pred", ignore=["representation"])),
    f"WITH {PRED.replace('lb AS', 'lb0 AS').replace('FROM lb)', 'FROM lb0)')}, lb AS (SELECT * FROM pr) SELECT * FROM {outs('lang', 'pred')} WHERE severity <> 'none'",
)
reg(
    "fai5_metric_filter",
    lambda t: rounded(_evaluate(t, ignore=["representation"])),
    f"WITH {LAB} SELECT * FROM (SELECT * FROM {outs('lang', 'toxic')} UNION ALL {MISSING_DIM}) WHERE severity <> 'none'",
)
CONF = """count(*) AS n, count(*) FILTER (WHERE quality=1 AND pred=1) AS tp, count(*) FILTER (WHERE quality=0 AND pred=1) AS fp, count(*) FILTER (WHERE quality=1 AND pred=0) AS fn, count(*) FILTER (WHERE quality=0 AND pred=0) AS tn"""
METR = """(tp+tn)/n AS accuracy, coalesce(tp/nullif(tp+fp,0),0) AS precision, coalesce(tp/nullif(tp+fn,0),0) AS recall, coalesce(2*tp/nullif(2*tp+fp+fn,0),0) AS f1, (tp+fp)/n AS selection_rate,
 coalesce(fp/nullif(fp+tn,0),0) AS fpr, coalesce(fn/nullif(fn+tp,0),0) AS fnr"""
GM = f"cf AS (SELECT lang AS value, {CONF} FROM pr GROUP BY ROLLUP (lang)), gm AS (SELECT value, n, {METR} FROM cf)"
MS = ("accuracy", "precision", "recall", "f1", "selection_rate", "fpr", "fnr")
reg(
    "fai9_group_metrics",
    lambda t: rounded(fairness.group_metrics(predicted(t), "lang", "quality", "pred")),
    f"WITH {PRED}, {GM} SELECT value, n, {', '.join(f'round({m},6) AS {m}' for m in MS)} FROM gm",
)
reg(
    "fai9_metric_spread",
    lambda t: rounded(fairness.metric_spread(fairness.group_metrics(predicted(t), "lang", "quality", "pred"))),
    f"WITH {PRED}, {GM} "
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, round(max({m})-min({m}),6) AS difference, round(min({m})/nullif(max({m}),0),6) AS ratio FROM gm WHERE value IS NOT NULL" for m in MS),
)
reg(
    "fai10_disparate_impact",
    lambda t: rounded(fairness.disparate_impact(labelled(t), "lang", "quality")),
    f"WITH {LAB}, g AS (SELECT avg(quality) AS r FROM lb GROUP BY lang) SELECT round(min(r)/max(r),6) AS impact_ratio, min(r)/max(r) >= 0.8 AS passes FROM g",
)
reg(
    "fai11_equalized_odds",
    lambda t: rounded(fairness.equalized_odds(fairness.group_metrics(predicted(t), "lang", "quality", "pred"))),
    f"WITH {PRED}, {GM} SELECT round(max(recall)-min(recall),6) AS tpr_gap, round(max(fpr)-min(fpr),6) AS fpr_gap, round(greatest(max(recall)-min(recall),max(fpr)-min(fpr)),6) AS equalized_odds_difference FROM gm WHERE value IS NOT NULL",
)


def _errors(t):
    """Item prices against a flat guess per quantity."""
    return t.lineitem.select("l_returnflag", "l_linenumber", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.when(F.col("l_linenumber") == 7, 4500.0).otherwise(2000.0)).alias("p"))


ERR = "er AS (SELECT l_returnflag, l_linenumber, pow(l_extendedprice - l_quantity*CASE WHEN l_linenumber=7 THEN 4500e0 ELSE 2000e0 END, 2) AS e FROM lineitem)"
GATE = f"""{ERR}, ov AS (SELECT sqrt(avg(e)) AS o FROM er), sl AS (SELECT 'l_returnflag' AS dimension, l_returnflag AS value, count(*) AS "count", sqrt(avg(e)) AS rmse FROM er GROUP BY 2
 UNION ALL SELECT 'l_linenumber', l_linenumber::varchar, count(*), sqrt(avg(e)) FROM er GROUP BY 2),
gt AS (SELECT dimension, value, round(rmse,4) AS rmse, round(abs(rmse-o)/o*100,2) AS deviation_pct, "count", "count" < 30 AS is_small, NOT (abs(rmse-o)/o > 0.5 OR rmse > o*3) AS passed FROM sl, ov)"""
DIMS = ["l_returnflag", "l_linenumber"]
reg("fai12_slice_gate", lambda t: fairness.slice_gate(_errors(t), DIMS, "y", "p"), f"WITH {GATE} SELECT * FROM gt")
reg(
    "fai12_gate_summary",
    lambda t: fairness.gate_summary(fairness.slice_gate(_errors(t), DIMS, "y", "p")),
    f"""WITH {GATE} SELECT count(*) AS slices, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed AND NOT is_small) AS failed,
 arg_max(dimension||'='||value, deviation_pct) AS worst_slice, max(deviation_pct) AS worst_deviation_pct FROM gt""",
)
reg(
    "fai13_slice_analysis",
    lambda t: fairness.gate_summary(fairness.slice_gate(_errors(t), ["l_linenumber"], "y", "p", 0.2, 50, 2.0, small_fail=True), count_small=True),
    f"""WITH {GATE} SELECT count(*) AS slices, count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok AND "count" >= 50) AS failed, arg_max(dimension||'='||value, deviation_pct) AS worst_slice, max(deviation_pct) AS worst_deviation_pct
 FROM (SELECT sl.*, abs(rmse-o)/o <= 0.2 AND rmse <= o*2 AS ok, round(abs(rmse-o)/o*100,2) AS deviation_pct FROM sl, ov WHERE dimension='l_linenumber')""",
)
reg(
    "udf5_custom_slice_metrics",
    lambda t: rounded(fairness.slice_errors(_errors(t), ["l_returnflag"], "y", "p", {"mae": F.avg(F.abs(F.col("y") - F.col("p"))), "bias": F.avg(F.col("p") - F.col("y"))}).select("dimension", "value", "count", "mae", "bias"), 4),
    """WITH x AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity*CASE WHEN l_linenumber=7 THEN 4500e0 ELSE 2000e0 END AS p FROM lineitem) SELECT 'l_returnflag' AS dimension, l_returnflag AS value, count(*) AS "count", round(avg(abs(y-p)),4) AS mae, round(avg(p-y),4) AS bias FROM x GROUP BY 2""",
)

# -- mitigation ----------------------------------------------------------------------------------


def docs(t):
    return t.documents.select("doc_id", "lang", "source")


WT = "g AS (SELECT lang, count(*) AS c FROM documents GROUP BY 1), o AS (SELECT sum(c) AS n, count(*) AS k FROM g)"
reg(
    "mit1_sample_weights",
    lambda t: rounded(mitigation.reweight(docs(t), "lang")),
    f"WITH {WT} SELECT doc_id, lang, source, round(n/(k*c),6) AS sample_weight FROM documents JOIN g USING (lang), o",
)
reg(
    "mit1_inverse_share",
    lambda t: rounded(mitigation.reweight(docs(t), "lang", inverse_share=True)),
    f"WITH {WT} SELECT doc_id, lang, source, round(n/c,6) AS sample_weight FROM documents JOIN g USING (lang), o",
)
reg(
    "mit2_reweight_actions",
    lambda t: rounded(mitigation.reweight_actions(docs(t), "lang")),
    f"""WITH {WT} SELECT lang AS value, c AS "count", round(n/(k*c),4) AS weight, round(c*100/n,2) AS original_pct, round(100/k,2) AS expected_pct, round(abs(c*100/n-100/k)/(100/k),6) AS before_disparity, 0e0 AS after_disparity FROM g, o""",
)


def resample_sql(dim: str, target: str) -> str:
    """Copies of each row: target over size, the remainder in hash order."""
    return f"""WITH r AS (SELECT doc_id, lang, source, count(*) OVER (PARTITION BY {dim}) AS n, row_number() OVER (PARTITION BY {dim} ORDER BY {hash_sql('doc_id')}, doc_id) AS i FROM documents),
s AS (SELECT {dim}, count(*) AS c FROM documents GROUP BY 1), tg AS (SELECT {dim} AS k, ({target})::bigint AS t FROM s), x AS (SELECT r.*, t//n + (i <= t%n)::int AS copies FROM r JOIN tg ON tg.k=r.{dim})
SELECT doc_id, lang, source, unnest(range(1, copies+1))::int AS copy FROM x"""


MEDIAN = "(SELECT floor(median(c)) FROM s)"
reg("mit3_stratified_resample", lambda t: mitigation.stratified(docs(t), "lang", "doc_id"), resample_sql("lang", MEDIAN))
reg("set3_union_resampled", lambda t: mitigation.stratified(docs(t), "source", "doc_id").groupBy("source").agg(F.count("*").alias("n")), f"WITH q AS ({resample_sql('source', MEDIAN)}) SELECT source, count(*) AS n FROM q GROUP BY 1")
TH = "o AS (SELECT avg(quality) AS a FROM lb), g AS (SELECT lang, avg(quality) AS r FROM lb GROUP BY 1), th AS (SELECT lang, r, greatest(0.1, least(0.9, 0.5-(a-r)*0.5)) AS t, abs(r-a)/a AS d FROM g, o)"
reg(
    "mit4_adjusted_thresholds",
    lambda t: rounded(mitigation.with_thresholds(labelled(t).select("doc_id", "lang", "quality"), "lang", "quality")),
    f"WITH {LAB}, {TH} SELECT doc_id, lang, quality, round(t,6) AS adjusted_threshold FROM lb JOIN th USING (lang)",
)


def _mitigated(t):
    """When representation is violated, write the weighted table to its own layer."""
    d = docs(t)
    bad = fairness.representation(d, "lang", None, warning=0.2).where("severity <> 'none'")
    out = mitigation.mitigate(d, "lang") if bad.limit(1).count() else d.withColumn("sample_weight", F.lit(1.0))
    store = LayerStore(t.spark, scratch_dir(t.spark, "mitigated"))
    store.write(out, "documents", "mitigated", "2024-01-31")
    return rounded(store.latest("documents", "mitigated").drop("dt"))


reg("mit13_mitigated_layer", _mitigated, f"WITH {WT} SELECT doc_id, lang, source, round(n/(k*c),6) AS sample_weight FROM documents JOIN g USING (lang), o")
reg("mit6_oversample_to_share", lambda t: mitigation.oversample_to_share(docs(t), "lang", "doc_id", 15.0), resample_sql("lang", "greatest(c, floor((SELECT count(*) FROM documents)*15/100.0))"))
reg("mit7_oversample_to_half", lambda t: mitigation.oversample_to_largest(docs(t), "lang", "doc_id", 0.5), resample_sql("lang", "greatest(c, floor((SELECT max(c) FROM s)*0.5))"))
reg("mit7_oversample_to_largest", lambda t: mitigation.oversample_to_largest(docs(t), "lang", "doc_id", 1.0), resample_sql("lang", "(SELECT max(c) FROM s)"))
reg("mit8_undersample_to_second", lambda t: mitigation.undersample_to_second(docs(t), "lang", "doc_id"), resample_sql("lang", "least(c, (SELECT min(c) FROM (SELECT c FROM s ORDER BY c DESC LIMIT 2)))"))
GRID_ROWS = ", ".join(f"({x}e0)" for x in mitigation.THRESHOLD_GRID)
THR = f"""{PRED}, tg(t) AS (VALUES {GRID_ROWS}), f AS (SELECT lang, t, any_value(n) AS n, count(*) FILTER (WHERE quality=0 AND score>t)/greatest(count(*) FILTER (WHERE quality=0),1) AS fpr
 FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM pr), tg GROUP BY 1, 2),
bt AS (SELECT lang, n, t AS threshold, fpr, round(abs(fpr-0.2),9) AS gap FROM f QUALIFY row_number() OVER (PARTITION BY lang ORDER BY round(abs(fpr-0.2),9), t)=1)"""
reg(
    "mit10_threshold_search",
    lambda t: rounded(mitigation.thresholds_for_fpr(predicted(t), "lang", "quality", "score")),
    f"WITH {THR} SELECT lang, n, threshold, round(fpr,6) AS fpr, round(gap,6) AS gap FROM bt",
)
reg(
    "mit11_service_rate",
    lambda t: rounded(mitigation.service_rate(t.documents, "source", "n_chars")),
    "SELECT source, count(*) AS units, sum(n_chars)::bigint AS total, round(sum(n_chars)/count(*),6) AS per_unit FROM documents GROUP BY 1",
)


def _comparison(t):
    base = predicted(t)
    best = settle(mitigation.thresholds_for_fpr(base, "lang", "quality", "score")).select("lang", "threshold")
    tuned = base.join(best, "lang").withColumn("pred", (F.col("score") > F.col("threshold")).cast("int"))
    return rounded(mitigation.comparison({"original": base, "thresholds": tuned}, "lang", "quality", "pred"))


def _cmp_sql(name, src):
    return f"""SELECT '{name}' AS method, round(max(accuracy) FILTER (WHERE value IS NULL),6) AS accuracy, round(max(accuracy) FILTER (WHERE value IS NOT NULL)-min(accuracy) FILTER (WHERE value IS NOT NULL),6) AS accuracy_gap,
 round(max(fpr) FILTER (WHERE value IS NOT NULL)-min(fpr) FILTER (WHERE value IS NOT NULL),6) AS fpr_gap, round(max(fnr) FILTER (WHERE value IS NOT NULL)-min(fnr) FILTER (WHERE value IS NOT NULL),6) AS fnr_gap
 FROM (SELECT value, {METR} FROM (SELECT lang AS value, {CONF} FROM {src} GROUP BY ROLLUP (lang)))"""


reg(
    "mit12_comparison",
    _comparison,
    f"WITH {THR}, tn AS (SELECT pr.* EXCLUDE (pred), (score>threshold)::int AS pred FROM pr JOIN bt USING (lang)) {_cmp_sql('original', 'pr')} UNION ALL {_cmp_sql('thresholds', 'tn')}",
)
