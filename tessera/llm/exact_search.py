"""Exact search for the largest inner products, with a KD-tree in each shard.

Each shard's vectors are split at the median of their widest axis until few are left, and every node keeps the tight box of
its vectors. The largest inner product that a box allows is a sum over the axes of the better of its two sides, so the bounds
of all boxes for a block of queries are two matrix products. A query takes boxes best first and stops at the first one whose
bound is below its kth score. That score is propagated: each query first searches the shard it lies in, and enters all others
with the kth score from there.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import settle
from tessera.llm.vectors import QUERIES, SHARD, dealt, matrix, met, ranked, together

LEAF = 96
#: Inner products up to this size are exact in double precision; beyond it whole numbers of Python are used.
EXACT = 2.0**53
LONG = 2**63 - 1


class Tree:
    """Nodes of a KD-tree in breadth-first order: boxes, children (0: none) and the rows of a leaf."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.left, self.right, self.rows = [], [], [], [], []
        todo = [np.arange(len(x))]
        for rows in todo:
            own = x[rows]
            low, high = own.min(0), own.max(0)
            self.low.append(low)
            self.high.append(high)
            axis = int((high - low).argmax())
            if len(rows) <= leaf or low[axis] == high[axis]:
                self.left.append(0)
                self.right.append(0)
                self.rows.append(rows)
                continue
            order = rows[np.argsort(own[:, axis], kind="stable")]
            self.left.append(len(todo))
            self.right.append(len(todo) + 1)
            self.rows.append(None)
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and node the largest inner product that the node's box allows; a little above, for rounding."""
        b = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        return b + np.abs(b) * 1e-9 + 0.5


def products(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products of whole-number vectors, exactly; what exceeds 64 bits is set to the largest or smallest such number."""
    if np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * len(q) < EXACT:
        return (x @ q).astype(np.int64).tolist()
    whole = [int(v) for v in q]
    return [max(-LONG - 1, min(LONG, sum(int(a) * b for a, b in zip(row, whole)))) for row in x]


def nearest(tree: Tree, x: np.ndarray, ids: np.ndarray, numbers: np.ndarray, q: np.ndarray, bound: np.ndarray, own: int, k: int, least: int | None) -> list[tuple[int, int, int]]:
    """(-score, id, number) of the k best of a tree but the row of number ``own``, smallest ids first where scores tie; only
    scores of ``least`` and above."""
    best: list[tuple[int, int, int]] = []
    heap = [(-bound[0], 0)]
    while heap:
        top, node = heapq.heappop(heap)
        floor = -best[-1][0] if len(best) == k else least
        if floor is not None and -top < floor:
            break
        rows = tree.rows[node]
        if rows is None:
            for below in (tree.left[node], tree.right[node]):
                heapq.heappush(heap, (-bound[below], below))
            continue
        scores = products(x[rows], q)
        new = [(-s, i, n) for s, i, n in zip(scores, ids[rows].tolist(), numbers[rows].tolist()) if n != own and (floor is None or s >= floor)]
        best = heapq.nsmallest(k, best + new)
    return best


def search(vectors: DataFrame, queries: DataFrame, k: int, scale: float) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products of each query row with all vectors but its own row.

    Both frames are (row, vec_id, v, dim) of one ``vectors.valid``; ids may repeat. Components count as floor(scale * x). Only vectors of the query's own dimension are
    compared. Ties go to the smaller vec_id; queries with fewer candidates get all; without rows there is no result.
    """
    vectors, queries = settle(dealt(vectors, ["dim"], SHARD, "shard", 1), "shards"), settle(queries, "queries")
    home = queries.join(vectors.select("row", F.col("shard").alias("home")), "row", "left").withColumn("home", F.coalesce("home", F.lit(0)))
    result = "query bigint, query_id bigint, vec_id bigint, score bigint"
    schema = pa.schema([(c, pa.int64()) for c in ("query", "query_id", "vec_id", "score")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return schema.empty_table()
        x, ids, numbers = np.floor(scale * matrix(left["v"])), left["vec_id"].to_numpy(), left["row"].to_numpy()
        q, own = np.floor(scale * matrix(right["v"])), list(zip(right["row"].to_pylist(), right["vec_id"].to_pylist()))
        least = right["least"].to_pylist() if "least" in right.column_names else [None] * len(own)
        tree = Tree(x)
        bounds = tree.bounds(q)
        rows = [(*a, i, -s) for n, a in enumerate(own) for s, i, _ in nearest(tree, x, ids, numbers, q[n], bounds[n].tolist(), a[0], k, least[n])]
        return pa.table(list(zip(*rows)) if rows else [[]] * 4, schema=schema)

    first = home.withColumnRenamed("home", "shard").select("dim", "shard", "row", "vec_id", "v")
    begun = together(vectors.select("dim", "shard", "row", "vec_id", "v"), first, ["dim", "shard"], run, result)
    floors = begun.groupBy(F.col("query").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(f"n = {k}").select("row", "least")
    asked = dealt(queries.join(floors, "row", "left"), ["dim"], QUERIES, "block", 2)
    found = met(vectors, asked, ["dim"], run, result)
    return ranked(found, k, F.desc("score")).drop("query")
