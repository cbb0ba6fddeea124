"""Vector tables: what counts as a vector, and the block grid of queries against shards that both searches run on."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import only, settle

#: Most vectors of a shard and most queries of a block: bounds of one group.
SHARD, QUERIES = 4096, 1024


def valid(df: DataFrame, column: str = "embedding", zero: bool = True) -> DataFrame:
    """(row, vec_id, v, dim): the vectors that can be searched, each under a number of its own.

    Left out are null ids, null and empty vectors, those with a null or non-finite component, and all-zero ones without
    ``zero``. Rows that share an id all stay. They are written once, so that their numbers are the same for every reader.
    """
    df = only(df, "vec_id", column)
    v = F.col(column).cast("array<double>")
    good = F.size(v) > 0
    good = good & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zero:
        good = good & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
    return settle(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("dim")), "rows")


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def dealt(df: DataFrame, key: list[str], most: int, name: str, salt: int) -> DataFrame:
    """Add a column that deals the rows of each key into as many shares as keep a share at ``most`` rows, about, and their number."""
    sizes = df.groupBy(*key).agg(F.expr(f"cast(ceil(count(*) / {most}) as int)").alias(f"{name}s"))
    return df.join(sizes, key).withColumn(name, F.expr(f"cast(pmod(xxhash64(row, {salt}), {name}s) as int)"))


def met(vectors: DataFrame, queries: DataFrame, key: list[str], search: Callable, schema: str) -> DataFrame:
    """Run ``search(vectors, queries)`` once for each shard and block of queries of a key; both have bounded sizes.

    Rows of a shard go to each block of queries of the key, and rows of a block to each shard.
    """
    shards = vectors.select(*key, "shards").distinct()
    blocks = queries.select(*key, "blocks").distinct()
    left = vectors.join(blocks, key).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks", "shards")
    right = queries.join(shards, key).withColumn("shard", F.explode(F.expr("sequence(0, shards - 1)"))).drop("blocks", "shards")
    return together(left, right, [*key, "shard", "block"], search, schema)


def together(left: DataFrame, right: DataFrame, key: list[str], search: Callable, schema: str) -> DataFrame:
    """Run ``search`` on the rows of each key from both frames, which may come from one table."""
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(search, schema)


def ranked(found: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows of each query row, numbered from 1; smaller vec_id first where they tie."""
    w = Window.partitionBy("query").orderBy(*order, "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query", "query_id", "rank", "vec_id", "score")
