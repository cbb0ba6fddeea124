"""Queries of the model, route, retrieval and evaluation sections."""

from __future__ import annotations

from pyspark.sql import functions as F


from tessera.operators import features, model, profile, retrieval, routes
from tessera.operators.joining import constant, scalar, settle, together
from tessera.plans.q_clean import CENTRES, DESCRIBED_SQL, described
from tessera.plans.q_quality import profile_sql
from tessera.plans.q_tables import BUCKET_SQL, CFG, DANGER, SCORE_SQL, TIER, _cells, as_of, score_table
from tessera.plans.registry import INC, REQ, hex_sql, incidents, point, point_sql, reg, rounded
from tessera.session import scratch_dir
from tessera.sources.layers import LayerStore

# -- model ---------------------------------------------------------------------------------------


LOOK_BACK = 30


def _dated_features(t):
    """Two dated feature snapshots of the cells, written and read back as a layer."""
    store = LayerStore(t.spark, scratch_dir(t.spark, "features"))
    ref = as_of(t)
    inc = incidents(t)
    for shift in (7, 0):
        r = ref - F.expr(f"INTERVAL {shift} DAYS")
        snap = features.bucket_sums(inc.where(F.col("occurred_on_date") <= r), r, CFG).drop("_weekend_30d")
        store.write(snap.withColumns({"computed_date": r.cast("date"), "dt": r.cast("date")}), "cells", "features")
    newest = scalar(store.dates("cells", "features"), F.max("dt"))
    rows = store.scan("cells", "features").where((F.col("dt") > F.date_sub(newest, LOOK_BACK)) & (F.col("dt") <= newest))
    missing = {"h3_index", "hour_bucket", "computed_date", "weighted_score_30d"} - set(rows.columns)
    if missing:
        raise ValueError(f"features lack {sorted(missing)}")
    return rows.drop("dt")


SNAP = """SELECT h3_index, hour_bucket, r::date AS computed_date, coalesce(sum(severity_weight) FILTER (WHERE occurred_on_date >= r - INTERVAL 30 DAY),0) AS weighted_score_30d, count(*) FILTER (WHERE occurred_on_date >= r - INTERVAL 30 DAY) AS incident_count_30d
 FROM (SELECT inc.*, ref - INTERVAL {d} DAY AS r FROM inc, ref) WHERE occurred_on_date <= r AND occurred_on_date >= r - INTERVAL 90 DAY GROUP BY 1, 2, 3"""
reg(
    "mod1_load_features",
    lambda t: features.newest_per_key(_dated_features(t), ["h3_index", "hour_bucket"], "computed_date").select("h3_index", "hour_bucket", "computed_date", "weighted_score_30d", "incident_count_30d"),
    f"""WITH {BUCKET_SQL}, s AS ({SNAP.format(d=7)} UNION ALL {SNAP.format(d=0)}) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY h3_index, hour_bucket ORDER BY computed_date DESC) = 1""",
)


def _loaded(t):
    """Four stored snapshots of the features, of which the last two lie within the look-back."""
    store = LayerStore(t.spark, scratch_dir(t.spark, "mod1"))
    days = [constant(t.events, F.date_format(F.max("ts") - F.make_interval(days=F.lit(d)), "yyyy-MM-dd")) for d in (60, 30, 7, 0)]
    dates_ = t.spark.range(1).select(*days).first()
    for d, date in zip((60, 30, 7, 0), dates_):
        ref = as_of(t) - F.expr(f"INTERVAL {d} DAYS")
        store.write(features.bucket_sums(incidents(t).where(F.col("occurred_on_date") <= ref), ref, CFG), "cells", "features", date)
    return features.load_features(store, "cells", dates_[-1], 14, ["weighted_score_30d", "incident_count_30d"]).drop("date")


reg(
    "mod1_lookback",
    _loaded,
    f"""WITH {BUCKET_SQL}, s AS ({SNAP.format(d=7)} UNION ALL {SNAP.format(d=0)})
SELECT h3_index, hour_bucket, weighted_score_30d, incident_count_30d FROM s QUALIFY row_number() OVER (PARTITION BY h3_index, hour_bucket ORDER BY computed_date DESC) = 1""",
)


def _base(t):
    return features.bucket_sums(incidents(t), as_of(t), CFG).select("h3_index", "hour_bucket", "weighted_score_30d")


def _labels(t):
    """Labels come from error incidents only, so that some keys have none."""
    return incidents(t).where("shooting")


MATRIX = f"""{BUCKET_SQL}, er AS (SELECT * FROM inc WHERE shooting), {DANGER.format(src='er')},
dm AS (SELECT h3_index, district FROM (SELECT h3_index, district, count(*) AS n FROM er GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY h3_index ORDER BY n DESC, district)=1),
mx AS (SELECT h3_index, hour_bucket, weighted_score_30d, coalesce(total_severity/greatest(days_active,1),0) AS danger_rate, coalesce(incident_count,0) AS incident_count, coalesce(district,'UNKNOWN') AS district
 FROM b LEFT JOIN dr USING (h3_index, hour_bucket) LEFT JOIN dm USING (h3_index))"""
reg(
    "mod2_training_matrix",
    lambda t: rounded(features.training_matrix(_base(t), _labels(t))),
    f"WITH {MATRIX} SELECT * REPLACE (round(danger_rate,6) AS danger_rate) FROM mx",
)
#: The library's own settings and limits, but for the RMSE limit, the slice limits and the cell count, which are set to the scale of these tables.
SMALL = model.ModelConfig(ratio="both", rmse_gate=3.0, min_cells=50, max_slice_deviation=2.0)


def _matrix(t):
    return settle(features.training_matrix(_cells(t), _labels(t)))


def _fitted(t):
    m = _matrix(t)
    train, val = model.random_split(m)
    return m, train, val, model.fit(train, SMALL)


def _mod3(t):
    _, _, val, fitted = _fitted(t)
    return model.predict(fitted, val).select("h3_index", "hour_bucket", "danger_rate", "predicted_danger")


reg("mod3_fit_boosted_trees", _mod3)


def _mod4(t):
    train, _ = model.random_split(_matrix(t))
    best = model.search(train, SMALL)
    return t.spark.createDataFrame([(k, float(v)) for k, v in best.items()], "parameter string, value double")


reg("mod4_grid_search", _mod4)


def _mod5(t):
    m, _, _, fitted = _fitted(t)
    return model.predict(fitted, m).select("h3_index", "hour_bucket", "predicted_danger")


reg("mod5_predict_floor", _mod5)


def _rule(df):
    """A fixed prediction rule, so that gates and scores can be restated in SQL."""
    return df.withColumn("predicted_danger", F.greatest(F.col("weighted_score_30d") / 10.0 - 0.2, F.lit(0.0)))


RULE = "greatest(weighted_score_30d/10e0-0.2e0,0)"


def _gate(t):
    m = _rule(features.training_matrix(_base(t), _labels(t)))
    return rounded(model.error_gate(m.where("hour_bucket <> 3"), m.where("hour_bucket = 3"), "danger_rate", "predicted_danger", SMALL))


reg(
    "mod6_error_gate",
    _gate,
    f"""WITH {MATRIX}, e AS (SELECT h3_index, hour_bucket, pow(danger_rate-{RULE},2) AS e FROM mx), v AS (SELECT sqrt(avg(e)) FILTER (WHERE true) AS rv, count(DISTINCT h3_index) AS cells FROM e WHERE hour_bucket=3), tr AS (SELECT sqrt(avg(e)) AS rt FROM e WHERE hour_bucket<>3)
SELECT round(rv,6) AS rmse_val, cells, round(rt,6) AS rmse_train, round(rt/rv,6) AS train_over_val, round(rv/rt,6) AS val_over_train, rv<=3 AND greatest(rt/rv, rv/rt)<=2 AND cells>=50 AS passed FROM v, tr""".replace(" FILTER (WHERE true)", ""),
)


def _mod7(t):
    *_, fitted = _fitted(t)
    return model.importance(t.spark, fitted, SMALL)


reg("mod7_feature_importance", _mod7)


def _model_contract(t):
    """What any right model fulfils: a prediction for every key, none below zero, less error than the mean, importances of all inputs that sum to one."""
    m, train, _, fitted = _fitted(t)
    p = model.predict(fitted, m).withColumn("_mean", constant(train, F.avg("danger_rate")))
    error = F.avg(F.abs(F.col("danger_rate") - F.col("predicted_danger"))) < F.avg(F.abs(F.col("danger_rate") - F.col("_mean")))
    told = p.agg(F.count_distinct("h3_index", "hour_bucket").alias("keys"), F.count_if(F.col("predicted_danger") < 0).alias("below_zero"), error.alias("better_than_mean"))
    weights = model.importance(t.spark, fitted, SMALL)
    return told.withColumns({"inputs": scalar(weights, F.count("*")), "importance": scalar(weights, F.round(F.sum("importance"), 6)), "scored": scalar(model.score_table(p, "v", "d"), F.count_if(F.col("risk_score").between(0, 100)))})


reg(
    "mod5_model_contract",
    _model_contract,
    f"WITH {MATRIX}, n AS (SELECT count(DISTINCT h3_index) * 6 AS n FROM b) SELECT n AS keys, 0 AS below_zero, true AS better_than_mean, {len(model.INPUTS)} AS inputs, 1e0 AS importance, n AS scored FROM n",
)
reg(
    "mod8_score_table",
    lambda t: model.score_table(rounded(_rule(_base(t))), "v1", "2024-01-31"),
    f"""WITH {BUCKET_SQL}, p AS (SELECT h3_index, hour_bucket, round({RULE},6) AS danger FROM b),
s AS (SELECT h3_index, hour_bucket, danger AS predicted_danger, round_even(CASE WHEN max(danger) OVER w > min(danger) OVER w THEN (danger-min(danger) OVER w)/(max(danger) OVER w-min(danger) OVER w)*100e0 ELSE 50e0 END,2) AS risk_score FROM p WINDOW w AS (PARTITION BY hour_bucket))
SELECT *, {TIER} AS risk_tier, 'v1' AS model_version, '2024-01-31' AS scored_at FROM s""",
)


def _version_table(t):
    """One version per month: the spread of order totals plays the validation error."""
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("version")).agg(F.round(F.stddev_samp("o_totalprice"), 4).alias("val_rmse"))
    last = scalar(m, F.max("version"))
    return m.withColumn("stage", F.when(F.col("version") == F.lit("2000-06"), "production").when(F.col("version") == last, "staging").otherwise("archived"))


VERS = """vt0 AS (SELECT strftime(o_orderdate,'%Y-%m') AS version, round(stddev_samp(o_totalprice),4) AS val_rmse FROM orders GROUP BY 1), vt AS (SELECT *, CASE WHEN version='2000-06' THEN 'production' WHEN version=(SELECT max(version) FROM vt0) THEN 'staging' ELSE 'archived' END AS stage FROM vt0)"""


def _promotion(t):
    v = settle(_version_table(t))
    cand = v.where("stage <> 'production'").select(F.col("version").alias("candidate"), "val_rmse")
    return rounded(model.compare_to_production(cand, v, 0.02), 4)


reg(
    "mod9_promotion",
    _promotion,
    f"""WITH {VERS}, p AS (SELECT version AS production_version, val_rmse AS production_rmse FROM vt WHERE stage='production') SELECT version AS candidate, val_rmse, production_version, production_rmse,
 round((val_rmse-production_rmse)/production_rmse*100,4) AS delta_pct, val_rmse <= production_rmse*1.02e0 AS should_promote FROM vt, p WHERE stage<>'production'""",
)
reg(
    "mod9_rollback",
    lambda t: model.rollback(_version_table(t), "1999-01"),
    f"WITH {VERS} SELECT version, val_rmse, CASE WHEN version='1999-01' THEN 'production' WHEN stage='production' THEN 'archived' ELSE stage END AS stage FROM vt",
)


def _mod11(t):
    run = model.train_run(settle(_cells(t)), _labels(t), SMALL, "v2", "2024-01-31")
    if run.scores is None:
        raise RuntimeError(f"training stopped at {run.stopped_at}: {run.metrics}")
    return run.scores


reg("mod11_training_run", _mod11)


def _mod12(t):
    from tessera.operators import fairness

    d = t.documents.drop("text").join(t.labels, "doc_id")
    fitted = model.classifier(d, ["lang", "source"], ["n_chars"], "quality")
    out = fitted.transform(d).withColumn("pred", F.col("prediction").cast("int"))
    return rounded(fairness.group_metrics(out, "lang", "quality", "pred"))


reg("mod12_classifier_audit", _mod12)
reg(
    "mod13_backfill_baseline",
    lambda t: rounded(profile.training_baseline(features.training_matrix(_base(t), _labels(t)), ["weighted_score_30d", "danger_rate"]), 4),
    f"""WITH {MATRIX} SELECT "column", mean, std, round(min,4) AS min, q1 AS p25, median AS p50, q3 AS p75, round(max,4) AS max, 0e0 AS null_pct FROM ({profile_sql('mx', ['weighted_score_30d', 'danger_rate'])})""",
)

_MATRIX_TEXTS = ["h3_index", "district"]
reg(
    "mod13_categorical_baseline",
    lambda t: rounded(profile.categorical_baseline(features.training_matrix(_base(t), _labels(t)), _MATRIX_TEXTS)),
    f"""WITH {MATRIX}, c AS ({' UNION ALL '.join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM mx WHERE {c} IS NOT NULL GROUP BY 2" for c in _MATRIX_TEXTS)}),
s AS (SELECT "column", sum(n) AS present, count(*) AS n_unique FROM c GROUP BY 1)
SELECT "column", value, n, round(n/present, 6) AS share, n_unique FROM c JOIN s USING ("column") QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) <= 20""",
)

# -- routes --------------------------------------------------------------------------------------


def route_table(t):
    """Each order is a request, each of its lines a route from the supplier over a midpoint to the
    part. The lines of an order are in one task from here on, for routes, their scores and their ranks."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity")
    r = together(lines, ["l_orderkey"]).groupBy(F.col("l_orderkey").alias("request_id"), F.col("l_linenumber").cast("bigint").alias("route_id")).agg(
        F.min("l_suppkey").alias("a"), F.min("l_partkey").alias("b"), F.round(F.sum("l_extendedprice"), 2).alias("distance_m"), F.sum("l_quantity").alias("duration_s")
    )
    (lat, lon), (lat2, lon2) = point("a"), point("b")
    mid = F.struct(((lat + lat2) / 2).alias("lat"), ((lon + lon2) / 2).alias("lon"))
    path = F.array(F.struct(lat.alias("lat"), lon.alias("lon")), mid, F.struct(lat2.alias("lat"), lon2.alias("lon")))
    return r.select("request_id", "route_id", "distance_m", "duration_s", F.pmod(F.col("route_id") * 5, F.lit(24)).alias("hour"), path.alias("geometry"))


(_AL, _AO), (_BL, _BO) = point_sql("a"), point_sql("b")
ROUTES = f"""rt0 AS (SELECT l_orderkey AS request_id, l_linenumber::bigint AS route_id, min(l_suppkey) AS a, min(l_partkey) AS b, round(sum(l_extendedprice),2) AS distance_m, sum(l_quantity) AS duration_s FROM lineitem GROUP BY 1, 2),
rt AS (SELECT *, (route_id*5)%24 AS hour FROM rt0),
pt AS (SELECT request_id, route_id, (hour//4)::int AS hour_bucket, {_AL} AS lat, {_AO} AS long FROM rt UNION ALL SELECT request_id, route_id, (hour//4)::int, ({_AL}+{_BL})/2, ({_AO}+{_BO})/2 FROM rt
 UNION ALL SELECT request_id, route_id, (hour//4)::int, {_BL}, {_BO} FROM rt),
ph AS (SELECT request_id, route_id, hour_bucket, {hex_sql('lat', 'long')} AS h3_index FROM pt),
rs AS (SELECT request_id, route_id, round(avg(coalesce(risk_score,50)),2) AS route_score FROM ph LEFT JOIN s USING (h3_index, hour_bucket) GROUP BY 1, 2)"""


def _route_scores(t):
    return routes.score_routes(route_table(t), score_table(t), ["request_id", "route_id"], ["duration_s"])


reg(
    "joi9_path_scores",
    lambda t: routes.lookup_scores(routes.path_points(route_table(t), ["request_id", "route_id"], routes.ROUTE_POINTS), score_table(t)).groupBy("h3_index", "hour_bucket").agg(F.count("*").alias("points"), F.count_if("found").alias("found")),
    f"""WITH {SCORE_SQL}, {ROUTES} SELECT h3_index, hour_bucket, count(*) AS points, count(*) FILTER (WHERE risk_score IS NOT NULL) AS found FROM ph LEFT JOIN s USING (h3_index, hour_bucket) GROUP BY 1, 2""",
)
reg(
    "rte1_route_scores",
    lambda t: _route_scores(t).select("request_id", "route_id", "route_score"),
    f"WITH {SCORE_SQL}, {ROUTES} SELECT * FROM rs",
)


def rank_sql(safe: str) -> str:
    comp = f"({safe})/100*0.6e0 + (1-duration_s/max(duration_s) OVER (PARTITION BY rt.request_id))*0.4e0"
    return f"""k0 AS (SELECT rt.request_id, rt.route_id, duration_s, route_score, {safe} AS safe, {comp} AS composite, count(*) OVER (PARTITION BY rt.request_id) AS n, row_number() OVER (PARTITION BY rt.request_id ORDER BY duration_s, rt.route_id)=1 AS fast FROM rt JOIN rs ON rs.request_id=rt.request_id AND rs.route_id=rt.route_id),
k1 AS (SELECT *, NOT fast AND row_number() OVER (PARTITION BY request_id, fast ORDER BY safe DESC, route_id)=1 AS safest FROM k0),
k2 AS (SELECT *, NOT fast AND NOT safest AND row_number() OVER (PARTITION BY request_id, fast, safest ORDER BY composite DESC, route_id)=1 AS bal FROM k1)
SELECT request_id, route_id, route_score, round(composite,6) AS composite, CASE WHEN n=1 THEN 'safest / fastest / balanced' WHEN fast THEN 'fastest' WHEN safest THEN 'safest' WHEN bal THEN 'balanced' ELSE 'alternative' END AS rank_label,
 CASE WHEN safest OR n=1 THEN 0 WHEN bal THEN 1 WHEN fast THEN 2 ELSE 3 END AS place FROM k2"""


for _name, _high, _safe in (("rte2_rank_routes", True, "route_score"), ("rte2_rank_routes_low_is_safe", False, "100e0 - route_score")):
    reg(
        _name,
        lambda t, high=_high: rounded(routes.rank_routes(_route_scores(t), "request_id", "route_id", high).select("request_id", "route_id", "route_score", "composite", "rank_label", "place")),
        f"WITH {SCORE_SQL}, {ROUTES}, {rank_sql(_safe)}",
    )

# -- retrieval -----------------------------------------------------------------------------------


def queries_of(t):
    """One query vector per label: the mean of all its vectors."""
    return retrieval.mean_vectors(t.embeddings, "label").select(F.col("label").cast("bigint").alias("query_id"), "embedding")


def found(t, k=5):
    return retrieval.top_k(queries_of(t), t.embeddings.select("vec_id", "embedding"), k)


def found_sql(k=5, where="true"):
    return f"""sim AS (SELECT cen.label::bigint AS query_id, vec_id, list_cosine_similarity(embedding::double[], centre) AS similarity, embeddings.label AS lab FROM cen, embeddings WHERE {where}),
fd AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM sim QUALIFY rank <= {k})"""


reg(
    "top2_nearest_vectors",
    lambda t: retrieval.scored(found(t)).select("query_id", "vec_id", "score", "rank"),
    f"WITH {CENTRES}, {found_sql()} SELECT query_id, vec_id, round(similarity,4) AS score, rank FROM fd",
)


def _append(t):
    """Documents appended to a store that already holds the benchmark items."""
    first = retrieval.append_chunks(None, t.benchmark.select("item_id", "text"), "item_id").select("chunk_id", "head", "text")
    more = retrieval.append_chunks(first, t.documents.select("doc_id", "text"), "doc_id").select("chunk_id", "head", "text")
    return first.unionByName(more)


reg(
    "vec1_append_chunks",
    _append,
    """WITH b AS (SELECT row_number() OVER (ORDER BY item_id)-1 AS chunk_id, substr(text,1,500) AS head, text FROM benchmark) SELECT * FROM b
UNION ALL SELECT row_number() OVER (ORDER BY doc_id)+(SELECT max(chunk_id) FROM b), substr(text,1,500), text FROM documents""",
)


def _chunk_table(t):
    """Chunks of all six datasets with the vector of their key, where there is one. Texts are sorted for the join: their number
    in a task is bounded, because they take many times the memory of what is shuffled."""
    vectors = t.embeddings.select(F.col("vec_id").alias("source_key"), F.size("embedding").cast("bigint").alias("dimensions"), F.col("embedding").cast("array<double>").alias("embedding"))
    chunks = together(described(t).withColumn("source_key", F.col("source_key").cast("bigint")), ["source_key"])
    table = chunks.join(vectors, "source_key", "left")
    # all components in millionths, as text: arrays of floats print differently elsewhere
    whole = F.array_join(F.transform("embedding", lambda x: F.floor(x * 1000000).cast("bigint").cast("string")), ",")
    return table.withColumn("embedding", whole)


reg(
    "vec2_chunk_table",
    _chunk_table,
    f"""WITH {INC}, {REQ}, d AS ({DESCRIBED_SQL}) SELECT d.*, len(embedding) AS dimensions, array_to_string(list_transform(embedding, lambda x: floor(x::double * 1000000)::bigint::varchar), ',') AS embedding FROM d LEFT JOIN embeddings ON vec_id = source_key""",
)
reg(
    "vec4_contexts",
    lambda t: retrieval.contexts(found(t), t.documents.select(F.col("doc_id").alias("vec_id"), "text")),
    f"""WITH {CENTRES}, {found_sql()}, c AS (SELECT query_id, string_agg(coalesce(text,''), chr(10) ORDER BY rank) AS x FROM fd LEFT JOIN documents ON doc_id=vec_id GROUP BY 1)
SELECT query_id, CASE WHEN x='' THEN 'no data' ELSE x END AS context FROM c""",
)

# -- evaluation ----------------------------------------------------------------------------------

WORDS = ["license", "the", "http", "zzz"]


def questions(t):
    """A question per label: its own group of labels is expected; the last label is out of scope."""
    q = F.col("query_id")
    last = constant(t.embeddings, F.max("label"))
    return queries_of(t).select(
        "query_id", F.concat(F.lit("c"), F.pmod(q, F.lit(3)).cast("string")).alias("category"), F.when(F.pmod(q, F.lit(2)) == 0, "easy").otherwise("hard").alias("difficulty"),
        F.array(F.when(q == last, F.lit("none")).otherwise(F.concat(F.lit("ds"), F.pmod(q, F.lit(4)).cast("string")))).alias("expected"),
        F.array(*[F.lit(w) for w in WORDS]).alias("keywords"),
    )


def hits(t, k=5, hit_table=None):
    h = retrieval.scored(found(t, k) if hit_table is None else hit_table)
    ds = t.embeddings.select("vec_id", F.concat(F.lit("ds"), F.pmod("label", F.lit(4)).cast("string")).alias("dataset"))
    texts = t.documents.select(F.col("doc_id").alias("vec_id"), "text")
    return h.join(ds, "vec_id").join(texts, "vec_id", "left").withColumn("text", F.coalesce("text", F.lit("")))


def results(t, k=5, hit_table=None):
    return retrieval.evaluate_questions(questions(t), hits(t, k, hit_table))


def eval_sql(k=5, where="true", sfx=""):
    return f"""{found_sql(k, where).replace('sim AS', f'sim{sfx} AS').replace('FROM sim', f'FROM sim{sfx}').replace('fd AS', f'fd{sfx} AS')},
hh{sfx} AS (SELECT fd{sfx}.*, 'ds'||(lab%4) AS dataset, coalesce(text,'') AS text, round(similarity,4) AS score FROM fd{sfx} LEFT JOIN documents ON doc_id=vec_id),
ag{sfx} AS (SELECT query_id, list(DISTINCT dataset) AS dsets, avg(score) AS sc, count(*) AS chunks, string_agg(text, ' ' ORDER BY rank) AS x FROM hh{sfx} GROUP BY 1),
ev{sfx} AS (SELECT query_id, 'c'||(query_id%3) AS category, CASE WHEN query_id%2=0 THEN 'easy' ELSE 'hard' END AS difficulty, query_id=(SELECT max(label) FROM embeddings) AS out_of_scope,
 CASE WHEN query_id=(SELECT max(label) FROM embeddings) THEN chunks=0 ELSE list_contains(dsets,'ds'||(query_id%4)) END AS retrieval_hit, query_id=(SELECT max(label) FROM embeddings) AND chunks>0 AS false_positive,
 CASE WHEN query_id=(SELECT max(label) FROM embeddings) THEN 0e0 ELSE round(len(list_filter({WORDS}, lambda w: contains(lower(x), w)))/4.0,4) END AS keyword_coverage, round(sc,4) AS avg_score, chunks FROM ag{sfx})"""


def summary_sql(sfx=""):
    cols = "count(*) AS total, round(avg(retrieval_hit::int)::decimal(20,10),4)::double AS retrieval_accuracy, round(avg(keyword_coverage)::decimal(20,10),4)::double AS avg_keyword_coverage, round(avg(avg_score)::decimal(20,10),4)::double AS avg_similarity"
    return " UNION ALL ".join(
        f"SELECT '{lv}' AS level, {sl} AS slice, {cols} FROM ev{sfx} WHERE NOT out_of_scope GROUP BY 1, 2" for lv, sl in (("overall", "'all'"), ("category", "category"), ("difficulty", "difficulty"))
    )


reg("eva1_question_results", lambda t: results(t), f"WITH {CENTRES}, {eval_sql()} SELECT * FROM ev")
reg("eva2_summary", lambda t: retrieval.summary(results(t)), f"WITH {CENTRES}, {eval_sql()} {summary_sql()}")
SLM = "SELECT {c} AS slice, count(*) AS total, count(*) FILTER (WHERE retrieval_hit) AS hits, round(avg(retrieval_hit::int)::decimal(20,10),4)::double AS retrieval_accuracy, round(avg(keyword_coverage)::decimal(20,10),4)::double AS avg_keyword_coverage FROM ev GROUP BY 1"
reg("eva3_slice_by_category", lambda t: retrieval.slice_metrics(results(t), "category"), f"WITH {CENTRES}, {eval_sql()} {SLM.format(c='category')}")
reg("eva3_slice_by_difficulty", lambda t: retrieval.slice_metrics(results(t), "difficulty"), f"WITH {CENTRES}, {eval_sql()} {SLM.format(c='difficulty')}")
reg(
    "eva3_retrieved_shares",
    lambda t: retrieval.retrieved_shares(hits(t)),
    f"""WITH {CENTRES}, {eval_sql()}, p AS (SELECT DISTINCT query_id, dataset FROM hh) SELECT dataset, count(*) AS "count", round(count(*)/(SELECT count(*) FROM p),4) AS proportion FROM p GROUP BY 1""",
)
reg(
    "eva4_disparities",
    lambda t: retrieval.disparities(settle(retrieval.slice_metrics(results(t), "difficulty"))),
    f"""WITH {CENTRES}, {eval_sql()}, sl AS ({SLM.format(c='difficulty')}), o AS (SELECT avg(retrieval_accuracy) AS m, max(retrieval_accuracy) AS hi, min(retrieval_accuracy) AS lo, count(*) AS n FROM sl),
dp AS (SELECT 'performance_gap' AS type, (SELECT slice FROM sl ORDER BY retrieval_accuracy, slice LIMIT 1) AS slice, round(hi-lo,4) AS gap FROM o WHERE n>=2 AND hi-lo>0.15
 UNION ALL SELECT 'underperforming_slice', slice, round(m-retrieval_accuracy,4) FROM sl, o WHERE n>=2 AND m-retrieval_accuracy>0.15) SELECT *, CASE WHEN gap>0.3 THEN 'high' ELSE 'medium' END AS severity FROM dp""",
)
KS = (3, 5, 10)


def _by_k(t):
    """Overall metrics for several k, all cut from one retrieval at the largest k."""
    top = settle(found(t, max(KS)))
    out = None
    for k in KS:
        row = retrieval.summary(results(t, k, top.where(F.col("rank") <= k))).where("level = 'overall'")
        row = row.select(F.lit(k).alias("k"), F.lit(f"run_k{k}").alias("run"), "retrieval_accuracy", "avg_keyword_coverage", "avg_similarity")
        out = row if out is None else out.unionByName(row)
    return settle(out)


BYK = f"""{", ".join(eval_sql(k, sfx=f'_{k}') for k in KS)}, byk AS ({" UNION ALL ".join(f"SELECT {k} AS k, 'run_k{k}' AS run, retrieval_accuracy, avg_keyword_coverage, avg_similarity FROM ({summary_sql(f'_{k}')}) WHERE level='overall'" for k in KS)})"""
reg(
    "eva5_best_k",
    lambda t: rounded(retrieval.best_setting(_by_k(t), "k", "avg_keyword_coverage"), 4),
    f"""WITH {CENTRES}, {BYK}, b AS (SELECT (SELECT k FROM byk ORDER BY avg_keyword_coverage DESC, k LIMIT 1) AS best_value, max(avg_keyword_coverage) AS best_metric, arg_max(avg_keyword_coverage,k)-arg_min(avg_keyword_coverage,k) AS change FROM byk)
SELECT best_value, best_metric, round(change,4) AS change, CASE WHEN abs(change)<0.05 THEN 'stable' WHEN change>0 THEN 'improves' ELSE 'decreases' END AS trend FROM b""",
)


def _ablation(t):
    """Accuracy with one dataset left out of the index at a time."""
    full = constant(retrieval.summary(results(t)).where("level = 'overall'"), F.max("retrieval_accuracy"))
    out = None
    for d in range(4):
        rest = t.embeddings.where(F.pmod("label", F.lit(4)) != d).select("vec_id", "embedding")
        hit = retrieval.top_k(queries_of(t), rest, 5)
        row = retrieval.summary(results(t, 5, hit)).where("level = 'overall'").select(F.lit(f"ds{d}").alias("removed"), "retrieval_accuracy")
        out = row if out is None else out.unionByName(row)
    return retrieval.ablation(full, out, "removed", "retrieval_accuracy")


ABL = ", ".join(eval_sql(5, f"embeddings.label%4<>{d}", f"_x{d}") for d in range(4))
reg(
    "eva5_ablation",
    _ablation,
    f"""WITH {CENTRES}, {eval_sql()}, {ABL}, fu AS (SELECT retrieval_accuracy AS a FROM ({summary_sql()}) WHERE level='overall'),
w AS ({" UNION ALL ".join(f"SELECT 'ds{d}' AS removed, retrieval_accuracy AS a FROM ({summary_sql(f'_x{d}')}) WHERE level='overall'" for d in range(4))})
SELECT removed, w.a AS accuracy_without, round(fu.a-w.a,4) AS accuracy_drop, CASE WHEN fu.a-w.a>0.1 THEN 'high' WHEN fu.a-w.a>0.05 THEN 'medium' ELSE 'low' END AS importance FROM w, fu""",
)
reg(
    "eva6_best_run",
    lambda t: retrieval.best_run(_by_k(t), "avg_similarity", 1),
    f"WITH {CENTRES}, {BYK} SELECT * FROM byk ORDER BY avg_similarity DESC, run LIMIT 1",
)
