"""Approximate nearest neighbours: an adaptive scan of dimensions within probed lists.

Centroids are fitted on a bounded sample; every vector is then put into the list of its nearest centroid, and turned by one
random rotation. After it a prefix of the components is a random projection, so the distance over the first few, scaled up,
estimates the whole. A list lies in blocks of columns: partial squared distances grow block by block, and after each one a
hypothesis test abandons candidates whose estimate exceeds the kth distance by more than chance allows. Queries probe the
lists of their nearest centroids, first the nearest alone, whose kth distance then goes along to the others. Distances of the
neighbours found are taken on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches, out, settle
from tessera.llm.vectors import QUERIES, SHARD, dealt, matrix, met, ranked

#: Vectors that the centroids are fitted on, about.
SAMPLE = 8192
#: Vectors of a list, about, and most lists.
LIST, LISTS = 800, 1024
#: Share of the lists that a query probes.
PROBED = 0.75
#: Columns of a block; width of the test, in standard deviations; rows that share one kth distance.
COLUMNS, WIDTH, ROWS = 16, 2.1, 512
STEPS = 8


@dataclass
class Lists:
    centroids: np.ndarray
    rotation: np.ndarray

    def order(self, x: np.ndarray) -> np.ndarray:
        """Lists of each vector, nearest centroid first."""
        d = (self.centroids**2).sum(1) - 2 * x @ self.centroids.T
        return np.argsort(d, axis=1, kind="stable")


def fit(vectors: DataFrame, seed: int = 7) -> dict[int, Lists]:
    """Centroids and rotation for each dimension, by k-means on about SAMPLE of its vectors."""
    counts = {r[0]: r[1] for r in vectors.groupBy("dim").agg(F.count("*")).collect()}
    result = {}
    for dim, n in counts.items():
        drawn = vectors.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("row", F.lit(3)), F.lit(1 << 30)) < min(1.0, SAMPLE / n) * (1 << 30)))
        table = drawn.select("row", "v").orderBy("row").toArrow()
        rng = np.random.default_rng(seed)
        x = matrix(table["v"]) if len(table) else np.zeros((1, dim))
        lists = max(1, min(LISTS, n // LIST, len(x) // 8))
        centroids = x[np.sort(rng.permutation(len(x))[:lists])]
        for _ in range(STEPS):
            near = ((centroids**2).sum(1) - 2 * x @ centroids.T).argmin(1)
            size = np.bincount(near, minlength=lists)
            total = np.zeros_like(centroids)
            np.add.at(total, near, x)
            centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids)
        rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        result[dim] = Lists(centroids, rotation)
    return result


def scan(x: np.ndarray, q: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list that can be among the k nearest, and their squared distances; ``bound`` is a known squared kth distance."""
    dim = x.shape[1]
    kept, squares = np.zeros(0, np.int64), np.zeros(0)
    for i in range(0, len(x), ROWS):
        alive, partial = np.arange(i, min(i + ROWS, len(x))), np.zeros(min(ROWS, len(x) - i))
        for c in range(0, dim, COLUMNS):
            part = x[alive, c : c + COLUMNS] - q[c : c + COLUMNS]
            partial = partial + np.einsum("ij,ij->i", part, part)
            seen = min(c + COLUMNS, dim)
            limit = bound * seen / dim * (1 + WIDTH / np.sqrt(seen)) ** 2 if seen < dim else bound
            stay = partial <= limit * (1 + 1e-9) + 1e-18
            alive, partial = alive[stay], partial[stay]
        kept, squares = np.concatenate([kept, alive]), np.concatenate([squares, partial])
        if len(kept) >= k:
            bound = min(bound, np.partition(squares, k - 1)[k - 1])
            stay = squares <= bound * (1 + 1e-9) + 1e-18
            kept, squares = kept[stay], squares[stay]
    return kept, squares


def search(vectors: DataFrame, queries: DataFrame, k: int, probed: float = PROBED) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each query row, by Euclidean distance, without itself.

    Both frames are (row, vec_id, v, dim) of one ``vectors.valid``; ids may repeat. A query probes the share ``probed`` of its dimension's lists, and more where those hold
    fewer than k candidates. Ties go to the smaller vec_id; without rows there is no result.
    """
    spark = vectors.sparkSession
    vectors = settle(vectors, "vectors")
    model = spark.sparkContext.broadcast(fit(vectors))

    def assign(parts):
        schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("dim", pa.int32()), ("list", pa.int32()), ("v", pa.list_(pa.float64())), ("turned", pa.list_(pa.float64()))])
        for b in batches(parts):
            dims = b.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == dim))
                m, x = model.value[dim], matrix(pa.chunked_array([own.column(2)]))
                near = m.order(x)[:, 0]
                yield out(schema, own.column(0), own.column(1), own.column(3), near.astype(np.int32), list(x), list(x @ m.rotation))

    assigned = settle(vectors.select("row", "vec_id", "v", "dim").mapInArrow(assign, "row bigint, vec_id bigint, dim int, list int, v array<double>, turned array<double>"), "lists")
    sizes: dict[int, np.ndarray] = {d: np.zeros(len(m.centroids), np.int64) for d, m in model.value.items()}
    for r in assigned.groupBy("dim", "list").agg(F.count("*").alias("n")).collect():  # at most LISTS of a dimension
        sizes[r["dim"]][r["list"]] = r["n"]
    held = spark.sparkContext.broadcast(sizes)

    def probes(parts):
        schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("dim", pa.int32()), ("list", pa.int32()), ("turn", pa.int32()), ("v", pa.list_(pa.float64())), ("turned", pa.list_(pa.float64()))])
        for b in batches(parts):
            for row, vec, v, dim in zip(*(b.column(i).to_pylist() for i in range(4))):
                if dim not in model.value:
                    continue
                m, x = model.value[dim], np.array(v)
                order = m.order(x[None])[0]
                enough = int(np.searchsorted(np.cumsum(held.value[dim][order]), k + 1)) + 1
                order = order[: max(enough, int(np.ceil(probed * len(order))))]
                n = len(order)
                yield out(schema, [row] * n, [vec] * n, [dim] * n, order, range(n), [v] * n, [x @ m.rotation] * n)

    fields = "row bigint, vec_id bigint, dim int, list int, turn int, v array<double>, turned array<double>"
    asked = settle(queries.select("row", "vec_id", "v", "dim").mapInArrow(probes, fields), "probes")
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        x, turned, ids = matrix(left["v"]), matrix(left["turned"]), left["vec_id"].to_numpy()
        numbers = left["row"].to_numpy()
        q, bounds = matrix(right["v"]), right["bound"].to_numpy(zero_copy_only=False)
        rows = []
        for n, (own, query_id, query) in enumerate(zip(right["row"].to_pylist(), right["vec_id"].to_pylist(), matrix(right["turned"]))):
            bound = bounds[n] ** 2 * (1 + 1e-9) if bounds[n] == bounds[n] else np.inf
            near, _ = scan(turned, query, k + 1, bound)  # one more: its own row may be there
            near = near[numbers[near] != own]
            exact = np.sqrt(((x[near] - q[n]) ** 2).sum(1))
            best = np.lexsort((ids[near], exact))[:k]
            rows += [(own, query_id, int(ids[near[i]]), float(exact[i])) for i in best]
        return pa.table(list(zip(*rows)) if rows else [[]] * 4, schema=schema)

    result, key = "query bigint, query_id bigint, vec_id bigint, score double", ["dim", "list"]
    shards = dealt(assigned, key, SHARD, "shard", 1)
    none = F.lit(None).cast("double").alias("bound")
    begun = settle(met(shards, dealt(asked.filter("turn = 0").select("*", none), key, QUERIES, "block", 2), key, run, result), "nearest-lists")
    limits = ranked(begun, k, "score").filter(f"rank = {k}").select(F.col("query").alias("row"), F.col("score").alias("bound"))
    others = asked.filter("turn > 0").join(limits, "row", "left")
    more = met(shards, dealt(others, key, QUERIES, "block", 2), key, run, result)
    return ranked(begun.unionByName(more), k, "score").drop("query")
