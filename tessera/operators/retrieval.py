"""Exact top-k cosine retrieval, chunk tables and retrieval evaluation."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers, strings
from tessera.operators import aggregates as agg
from tessera.operators import ordering
from tessera.operators.joining import scalar, settle

QUERY_BLOCK = 4096  # queries that one task holds as a matrix
VECTOR_BLOCK = 65_536
SCHEMA = "query_id bigint, vec_id bigint, similarity double"


def _unit(vectors) -> np.ndarray:
    m = np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best(qid, vid, sim, k) -> pd.DataFrame:
    """k best per query of a similarity block; ties go to the smaller vector id."""
    order = np.argsort(vid, kind="stable")
    vid, sim = vid[order], sim[:, order]
    top = np.argsort(-sim, axis=1, kind="stable")[:, :k]
    rows = np.arange(len(qid))[:, None]
    return pd.DataFrame(
        {"query_id": np.repeat(qid, top.shape[1]), "vec_id": vid[top].ravel(), "similarity": sim[rows, top].ravel()}
    )


def _keep_best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.sort_values(["query_id", "similarity", "vec_id"], ascending=[True, False, True], kind="stable")
    return found.groupby("query_id", sort=False).head(k)


def _few_queries(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Queries checked to fit one block ride along with the task; each task returns only its k best
    per query."""
    rows = queries.collect()
    if not rows:
        return queries.sparkSession.createDataFrame([], SCHEMA)
    qid = np.array([r[0] for r in rows], dtype=np.int64)
    qm = queries.sparkSession.sparkContext.broadcast((qid, _unit([r[1] for r in rows])))

    def score(batches):
        ids, q = qm.value
        best = None
        for pdf in batches:
            if len(pdf):
                part = _best(ids, pdf["vec_id"].to_numpy(), q @ _unit(pdf["embedding"]).T, k)
                best = part if best is None else _keep_best(pd.concat([best, part]), k)
        if best is not None:
            yield best

    return vectors.mapInPandas(score, SCHEMA)


def _many_queries(queries: DataFrame, vectors: DataFrame, k: int, nq: int, nv: int) -> DataFrame:
    """Block grid: queries in G blocks, vectors in H blocks, one task per block pair. Each side is
    copied once per block of the other, blocks have a bounded size, and only k rows per query leave
    a block."""
    g, h = max(1, -(-nq // QUERY_BLOCK)), max(1, -(-nv // VECTOR_BLOCK))

    def block(c, n):
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    left = queries.withColumns({"_g": block("query_id", g), "_h": F.explode(F.sequence(F.lit(0), F.lit(h - 1)))})
    right = vectors.withColumns({"_h": block("vec_id", h), "_g": F.explode(F.sequence(F.lit(0), F.lit(g - 1)))})

    def score(a, b):
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "similarity": []})
        return _best(a["query_id"].to_numpy(), b["vec_id"].to_numpy(), _unit(a["embedding"]) @ _unit(b["embedding"]).T, k)

    return left.groupBy("_g", "_h").cogroup(right.groupBy("_g", "_h")).applyInPandas(score, SCHEMA)


def top_k(queries: DataFrame, vectors: DataFrame, k: int, max_queries: int = QUERY_BLOCK) -> DataFrame:
    """Exact k nearest vectors per query by cosine: (query_id, vec_id, similarity, rank).

    Inputs are (query_id, embedding) and (vec_id, embedding). The query side is sent to every task
    only when a count shows that it is small; larger query sets go through the block grid.
    """
    queries, vectors = queries.select("query_id", "embedding"), vectors.select("vec_id", "embedding")
    queries = settle(queries)
    if queries.limit(max_queries + 1).count() <= max_queries:
        found = _few_queries(queries, vectors, k)
    else:
        found = _many_queries(queries, vectors, k, queries.count(), vectors.count())
    return agg.top_per_group(found, ["query_id"], [F.desc("similarity"), F.col("vec_id")], k)


def scored(found: DataFrame) -> DataFrame:
    """score = round(1 - cosine distance, 4)."""
    return found.withColumn("score", F.round("similarity", 4))


def mean_vectors(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per key: one aggregation on (key, dimension)."""
    long = df.select(key, F.posexplode(vector).alias("_i", "_x"))
    mean = long.groupBy(key, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    pairs = F.array_sort(F.collect_list(F.struct("_i", "_x")))  # one entry per dimension
    return mean.groupBy(key).agg(F.transform(pairs, lambda p: p["_x"]).alias(vector))


# -- chunk table -------------------------------------------------------------------------------


def append_chunks(existing: DataFrame | None, chunks: DataFrame, order: str, width: int = 500) -> DataFrame:
    """New chunks with ids that continue the stored ones, and the text's first ``width`` characters as ``head`` beside it.

    Every chunk gets an id of its own, also where ``order`` repeats or is NULL (NULLs come last).
    """
    start = F.lit(0) if existing is None else F.coalesce(scalar(existing, F.max("chunk_id")) + 1, F.lit(0))
    rows = ordering.numbered(chunks, order, "_before")
    return rows.withColumns({"chunk_id": (start + F.col("_before")).cast("bigint"), "head": F.substring("text", 1, width)}).drop("_before")


def chunk_rows(df: DataFrame, dataset: str, text: Column, *keep: str) -> DataFrame:
    return df.select(*keep, text.alias("text"), F.lit(dataset).alias("dataset"))


def contexts(found: DataFrame, texts: DataFrame) -> DataFrame:
    """One context per query from its ranked chunks (at most k of them), or a "no data" note."""
    rows = found.join(texts, "vec_id", "left").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.coalesce("text", F.lit("")).alias("text")))).alias("_r")
    )
    joined = F.array_join(F.transform("_r", lambda r: r["text"]), "\n")
    return rows.select("query_id", F.when(joined == "", "no data").otherwise(joined).alias("context"))


# -- evaluation --------------------------------------------------------------------------------


def evaluate_questions(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Per question: hit, keyword coverage, mean score, rejection.

    ``questions``: query_id, category, difficulty, expected (array), keywords (array);
    ``hits``: query_id, dataset, text, score, rank — at most k rows per question.
    """
    got = hits.groupBy("query_id").agg(
        F.collect_set("dataset").alias("datasets"), F.avg("score").alias("avg_score"), F.count("*").alias("chunks"),
        F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("_t"),
    )
    q = questions.join(got, "query_id", "left")
    text = F.coalesce(F.array_join(F.transform("_t", lambda r: r["text"]), " "), F.lit(""))
    outside = F.array_contains("expected", "none")
    n = F.coalesce("chunks", F.lit(0))
    hit = F.coalesce(F.arrays_overlap("expected", "datasets"), F.lit(False))
    return q.withColumn("_text", text).select(
        "query_id", "category", "difficulty", outside.alias("out_of_scope"),
        F.when(outside, n == 0).otherwise(hit).alias("retrieval_hit"),
        (outside & (n > 0)).alias("false_positive"),
        F.when(outside, 0.0).otherwise(F.round(strings.keyword_coverage("_text", "keywords"), 4)).alias("keyword_coverage"),
        F.coalesce(F.round("avg_score", 4), F.lit(0.0)).alias("avg_score"), n.alias("chunks"),
    )


def mean4(c) -> Column:
    """Average to four digits by decimal rounding: a double average may lie just below a tie that the values reach exactly."""
    return F.round(F.avg(c).cast("decimal(20,10)"), 4).cast("double")


def summary(results: DataFrame) -> DataFrame:
    """Overall, per-category and per-difficulty metrics in one grouping-sets style pass."""
    levels = F.array(
        F.struct(F.lit("overall").alias("level"), F.lit("all").alias("slice")),
        F.struct(F.lit("category").alias("level"), F.col("category").alias("slice")),
        F.struct(F.lit("difficulty").alias("level"), F.col("difficulty").alias("slice")),
    )
    rows = results.where(~F.col("out_of_scope")).select("*", F.inline(levels))
    return rows.groupBy("level", "slice").agg(
        F.count("*").alias("total"),
        mean4(F.col("retrieval_hit").cast("double")).alias("retrieval_accuracy"),
        mean4("keyword_coverage").alias("avg_keyword_coverage"),
        mean4("avg_score").alias("avg_similarity"),
    )


def slice_metrics(results: DataFrame, by: str) -> DataFrame:
    return results.groupBy(F.col(by).alias("slice")).agg(
        F.count("*").alias("total"), F.count_if("retrieval_hit").alias("hits"),
        mean4(F.col("retrieval_hit").cast("double")).alias("retrieval_accuracy"),
        mean4("keyword_coverage").alias("avg_keyword_coverage"),
    )


def retrieved_shares(hits: DataFrame) -> DataFrame:
    """How often each dataset is retrieved (once per question) and its share."""
    pairs = hits.select("query_id", "dataset").distinct()
    counts = pairs.groupBy("dataset").agg(F.count("*").alias("count"))
    return counts.withColumn("proportion", F.round(numbers.ratio("count", scalar(pairs, F.count("*"))), 4))


def disparities(slices: DataFrame, metric: str = "retrieval_accuracy", limit: float = 0.15) -> DataFrame:
    """A gap row when best and worst slice differ too much, and a row per slice far below mean."""
    mean, hi, lo = (scalar(slices, f(metric)) for f in (F.avg, F.max, F.min))
    n = scalar(slices, F.count("*"))
    below = slices.where((n >= 2) & (mean - F.col(metric) > limit)).select(
        F.lit("underperforming_slice").alias("type"), F.col("slice").cast("string").alias("slice"),
        F.round(mean - F.col(metric), 4).alias("gap"),
    )
    worst = slices.agg(
        F.count("*").alias("_n"), (F.max(metric) - F.min(metric)).alias("_gap"),
        F.min_by(F.col("slice").cast("string"), F.struct(F.col(metric), F.col("slice"))).alias("slice"),
    )
    gap = worst.where((F.col("_n") >= 2) & (F.col("_gap") > limit)).select(
        F.lit("performance_gap").alias("type"), "slice", F.round("_gap", 4).alias("gap")
    )
    return gap.unionByName(below).withColumn("severity", F.when(F.col("gap") > 0.3, "high").otherwise("medium"))


def best_setting(results: DataFrame, parameter: str, metric: str) -> DataFrame:
    """The parameter value with the best metric (first of equals), and how far the ends differ."""
    first, last = F.min_by(metric, parameter), F.max_by(metric, parameter)
    out = results.agg(
        F.min_by(parameter, F.struct((-F.col(metric)).alias("m"), F.col(parameter))).alias("best_value"),
        F.max(metric).alias("best_metric"), (last - first).alias("change"),
    )
    verdict = F.when(F.abs("change") < 0.05, "stable").when(F.col("change") > 0, "improves").otherwise("decreases")
    return out.withColumn("trend", verdict)


def ablation(full: float | Column, without: DataFrame, removed: str, metric: str) -> DataFrame:
    """Accuracy drop when one dataset is left out, with an importance rating."""
    drop = (F.lit(full) if isinstance(full, float) else full) - F.col(metric)
    rating = F.when(drop > 0.1, "high").when(drop > 0.05, "medium").otherwise("low")
    return without.select(removed, F.col(metric).alias("accuracy_without"), F.round(drop, 4).alias("accuracy_drop"), rating.alias("importance"))


def best_run(runs: DataFrame, metric: str, n: int = 1) -> DataFrame:
    return runs.orderBy(F.desc(metric), "run").limit(n)


def render_all(datasets: Mapping[str, tuple[DataFrame, Column, str]], samples: Mapping[str, int] | None = None) -> DataFrame:
    """Render and union the chunk rows of several datasets, of those in ``samples`` only so many. Each entry is
    (table, sentence, integer key)."""
    from tessera.operators.sampling import sample_rows

    out = None
    for name, (df, text, key) in datasets.items():
        part = sample_rows(df, key, samples[name]) if name in (samples or {}) else df
        part = chunk_rows(part, name, text, key).withColumnRenamed(key, "source_key")
        out = part if out is None else out.unionByName(part)
    return out


