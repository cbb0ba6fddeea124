"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import forget, settle


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction of edges (a, b), a > b: everything around a node is linked to the smallest node there."""
    if small:
        around = edges
    else:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = around.join(least, "a")
    if small:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    else:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b); the component is its smallest node.

    Null ends and links of a node to itself are passed over; a repeated link counts once; no links give no rows. Each round
    is written to the shared scratch folder, so lost executors cost no more than that round.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    state, edges = None, settle(edges, "links")
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        before = edges
        state, edges = now, settle(_stars(_stars(edges, small=False), small=True), "stars")
        forget(before)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
