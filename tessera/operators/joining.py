"""Joins against statistics and lookups, with broadcasting only behind a size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
#: Bytes of such a table, written as JSON: rows may be wide.
MAX_BROADCAST_BYTES = 64 << 20


def ensure_checkpoint_dir(spark) -> None:
    from tessera.session import scratch_dir

    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "ckpt"))


def settle(df: DataFrame) -> DataFrame:
    """Compute once and keep in the shared checkpoint folder, so later readers agree and a lost
    executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a settled aggregate if it has at most ``max_rows`` rows of together at most MAX_BROADCAST_BYTES; beyond
    that leave the choice to AQE, whose skew join splits hot keys of the other side."""
    df = settle(df)
    size = F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    n, width = df.limit(max_rows + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if n <= max_rows and (width or 0) <= MAX_BROADCAST_BYTES else df


def attach(
    df: DataFrame,
    stats: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Join per-group statistics back to rows. A few groups may hold most rows, so the rows are
    not shuffled by group while the statistics are small."""
    return df.join(sized(stats, max_rows), list(on), how)


#: Rows of a task where rows are put together by key for several steps in a row.
ROWS_PER_TASK = 250_000


def together(df: DataFrame, key: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows with the same key in one task, as many tasks as keep each at about ``rows_per_task`` rows however large the table.

    Groupings and windows by the key, or by more columns than it, then need no exchange of their own and no partial sums
    before it, and AQE does not put these tasks together again. For keys of few rows."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df.repartition(tasks, *key)


def left_fill(
    df: DataFrame, other: DataFrame, on: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join that replaces NULLs of the joined columns by defaults."""
    out = df.join(other, list(on), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def densify(
    df: DataFrame, key: str, bucket: str, buckets: Sequence[int], defaults: Mapping[str, object]
) -> DataFrame:
    """Every key with every bucket. The grid is exploded in place from the distinct keys, so this
    costs one shuffle on the key and no product join."""
    grid = df.select(key).distinct().select(
        key, F.explode(F.array(*[F.lit(int(b)) for b in buckets])).alias(bucket)
    )
    return left_fill(grid, df, [key, bucket], defaults)


def lagged(
    current: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    default: float = 0.0,
) -> DataFrame:
    """Value of the same key in an earlier snapshot (NULL and absent read as the default)."""
    past = history.select(*keys, F.col(value).alias(out))
    return left_fill(current, past, keys, {out: default})


def lag_by_date(
    df: DataFrame, keys: Sequence[str], date: str, value: str, lags: Mapping[str, int], default=0.0
) -> DataFrame:
    """Lags by calendar days within one table of dated snapshots: each row is sent forward to the
    days that want it, then everything meets in a single aggregation on (key, date)."""
    keys = list(keys)
    shifts = {"_own": 0, **lags}
    sends = F.array(
        *[F.struct(F.lit(n).alias("slot"), F.lit(d).alias("days")) for n, d in shifts.items()]
    )
    sent = df.select(*keys, date, value, F.explode(sends).alias("_s")).select(
        *keys, F.date_add(F.col(date), F.col("_s.days")).alias(date), F.col("_s.slot").alias("_slot"), value
    )
    pick = {n: F.max(F.when(F.col("_slot") == n, F.col(value))) for n in shifts}
    out = sent.groupBy(*keys, date).agg(
        F.max(F.col("_slot") == "_own").alias("_present"),
        pick["_own"].alias(value),
        *[F.coalesce(pick[n], F.lit(default)).alias(n) for n in lags],
    )
    return out.where("_present").drop("_present")


def semi_top(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key is among the ``n`` most frequent (ties: smaller key first)."""
    from tessera.operators.aggregates import top_values

    return df.join(F.broadcast(top_values(df, key, n).select(key)), key, "left_semi")


def other_label(df: DataFrame, key: str, n: int, out: str, label: str = "Other") -> DataFrame:
    """The key itself when among the ``n`` most frequent, else a merged label."""
    from tessera.operators.aggregates import top_values

    top = top_values(df, key, n).select(key, F.col(key).alias(out))
    return df.join(F.broadcast(top), key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(label)))


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value subquery over a table, usable inside any expression on any table."""
    return df.select(expr.alias("_scalar")).scalar()


def constant(df: DataFrame, expr: Column) -> Column:
    """A one-row aggregate evaluated now and used as a literal, so that filters against it reach
    the file scan. For reference times and the like; results inside projections use ``scalar``."""
    out = df.agg(expr.alias("v"))
    kind = out.schema["v"].dataType
    return F.lit(out.select(F.col("v").cast("string")).first().v).cast(kind)
