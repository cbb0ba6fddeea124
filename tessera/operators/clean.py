"""Row cleaning: renaming, lenient typing, filters with a drop ledger, NULL handling, dedup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geo, numbers
from tessera.functions.strings import col
from tessera.operators.joining import sized


def normalise_headers(df: DataFrame, dash: bool = False) -> DataFrame:
    """Lower-case, trimmed, blanks (and dashes) to underscores."""

    def norm(c):
        c = c.strip().lower().replace(" ", "_")
        return c.replace("-", "_") if dash else c

    return df.toDF(*[norm(c) for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient casts: what does not parse becomes NULL, and so does NaN."""
    out = {}
    for c, kind in types.items():
        if c not in df.columns:
            continue
        if kind == "datetime":
            is_time = isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))
            out[c] = F.col(c) if is_time else F.try_to_timestamp(F.col(c).cast("string"))
        elif kind in ("int", "long", "integer"):
            v = F.col(c).try_cast("double")
            out[c] = F.when(~F.isnan(v), v).try_cast("bigint")
        elif kind in ("float", "double", "number"):
            v = F.col(c).try_cast("double")
            out[c] = F.when(~F.isnan(v), v)
        elif kind in ("bool", "boolean"):
            out[c] = F.col(c).try_cast("boolean")
        else:
            out[c] = F.col(c).cast("string")
    return df.withColumns(out)


def keep_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def reindex(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Exactly the contract's columns; those absent come out as typed NULLs."""
    return df.select(
        *[
            F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c)
            for c, t in contract.items()
        ]
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def empty_like(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """The typed contract with no rows."""
    return reindex(df, contract).where(F.lit(False))


def auto_numeric(df: DataFrame, columns: Sequence[str], share: float = 0.7) -> DataFrame:
    """Make a text column numeric if more than ``share`` of its rows parse. One pass over all."""
    parsed = {c: F.regexp_replace(F.col(c), ",", "").try_cast("double") for c in columns}
    rates = df.agg(*[F.avg(parsed[c].isNotNull().cast("double")).alias(c) for c in columns]).first()
    return df.withColumns({c: parsed[c] for c in columns if (rates[c] or 0.0) > share})


def nan_to_null(df: DataFrame) -> DataFrame:
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed)


# -- filters -----------------------------------------------------------------------------------


def tag_drops(df: DataFrame, reasons: Mapping[str, Column], out: str = "drop_reason") -> DataFrame:
    """Label each row with the first reason to drop it (NULL keeps it)."""
    label = F.lit(None).cast("string")
    for name, cond in reversed(list(reasons.items())):
        label = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(label)
    return df.withColumn(out, label)


def kept(tagged: DataFrame, reason: str = "drop_reason") -> DataFrame:
    return tagged.where(F.col(reason).isNull()).drop(reason)


def ledger(tagged: DataFrame, reason: str = "drop_reason") -> DataFrame:
    return tagged.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("rows"))


_COUNTING: ContextVar = ContextVar("drop counts", default=None)


class DropCounts:
    """Counts of dropped rows by reason, taken by the pass that writes the rows that stay.

    ``with DropCounts() as c:`` puts an observation on every ``drop_rows`` that is planned inside; ``c.counts()`` has the
    result once the planned frame has been written, and waits for it until then. A task that is run again after its executor
    was lost counts again, if its output goes to a shuffle; ``rows`` are the rows that went in, so a caller who knows their
    number can tell.
    """

    def __init__(self):
        self._watched: list[tuple[Observation, list[str]]] = []

    def __enter__(self) -> DropCounts:
        self._token = _COUNTING.set(self)
        return self

    def __exit__(self, *_) -> None:
        _COUNTING.reset(self._token)

    def watch(self, tagged: DataFrame, reasons: Sequence[str], out: str) -> DataFrame:
        seen = Observation()
        self._watched.append((seen, list(reasons)))
        by_reason = [F.count_if(F.col(out) == name).alias(f"n{i}") for i, name in enumerate(reasons)]
        return tagged.observe(seen, F.count("*").alias("rows"), *by_reason)

    def rows(self) -> list[int]:
        """Rows that reached each filter, in the order of planning."""
        return [seen.get["rows"] for seen, _ in self._watched]

    def counts(self) -> dict[str, int]:
        """Rows by reason; reasons without rows are left out."""
        total: dict[str, int] = {}
        for seen, reasons in self._watched:
            for i, name in enumerate(reasons):
                total[name] = total.get(name, 0) + seen.get[f"n{i}"]
        return {name: n for name, n in total.items() if n}

    def ledger(self, spark) -> DataFrame:
        return spark.createDataFrame(list(self.counts().items()), "drop_reason string, rows bigint")


def drop_rows(df: DataFrame, reasons: Mapping[str, Column], out: str = "drop_reason") -> DataFrame:
    """Rows without a reason to drop them; what goes is counted where ``DropCounts`` is active."""
    tagged = tag_drops(df, reasons, out)
    counting = _COUNTING.get()
    return kept(counting.watch(tagged, list(reasons), out) if counting else tagged, out)


def location_reasons(lat="lat", lon="long", box=geo.BOX) -> dict[str, Column]:
    missing = col(lat).isNull() | col(lon).isNull()
    return {"missing_coordinates": missing, "outside_box": ~geo.in_box(lat, lon, box)}


def time_reasons(ts, as_of: Column, future_days: int = 1, past_years: int = 10) -> dict[str, Column]:
    """Unparseable, future and too-old event times against a given reference time."""
    ts = col(ts)
    return {
        "invalid_date": ts.isNull(),
        "future_date": ts > as_of + F.expr(f"INTERVAL {future_days} DAYS"),
        "old_date": ts < as_of - F.expr(f"INTERVAL {past_years * 365} DAYS"),
    }


def null_pair_outside(df: DataFrame, lat="lat", lon="long", box=geo.BOX) -> DataFrame:
    """Both coordinates become NULL together when the point is outside the box."""
    ok = geo.in_box(lat, lon, box)
    return df.withColumns({c: numbers.null_unless(c, ok) for c in (lat, lon)})


def null_each_outside(df: DataFrame, lat="lat", lon="long", box=geo.BOX) -> DataFrame:
    return df.withColumns(
        {
            lat: numbers.null_unless(lat, numbers.in_range(lat, box["min_lat"], box["max_lat"])),
            lon: numbers.null_unless(lon, numbers.in_range(lon, box["min_lon"], box["max_lon"])),
        }
    )


def null_zero_pair(df: DataFrame, lat="lat", lon="long") -> DataFrame:
    ok = (F.col(lat) != 0) & (F.col(lon) != 0)
    return df.withColumns({c: numbers.null_unless(c, ok) for c in (lat, lon)})


def groups_with_both_classes(df: DataFrame, group: str, outcome: str, min_rows: int) -> DataFrame:
    """Rows of groups with at least ``min_rows`` rows and two outcome values. Partial aggregates
    carry only a count and the two extremes, whatever the group size."""
    good = (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count("*").alias("_n"), F.min(outcome).alias("_lo"), F.max(outcome).alias("_hi"))
        .where((F.col("_n") >= min_rows) & (F.col("_lo") != F.col("_hi")))
        .select(group)
    )
    return df.join(sized(good), group, "left_semi")


# -- NULLs and duplicates ----------------------------------------------------------------------


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if c in df.columns}
    )


def with_missing_flags(df: DataFrame, columns: Sequence[str], fill_value: float = 0.0) -> DataFrame:
    flags = {f"{c}_missing": F.col(c).isNull().cast("int") for c in columns}
    return df.withColumns({**flags, **{c: F.coalesce(F.col(c), F.lit(fill_value)) for c in columns}})


def dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last"
) -> DataFrame:
    """One row per key: the last (or first) in the given order, ties settled by a row hash.

    An aggregate rather than a window: map tasks already reduce each key to one row, so a hot key
    ships one candidate per task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order], F.xxhash64(*[F.col(c) for c in df.columns]))
    pick = F.max_by if keep == "last" else F.min_by
    return (
        df.groupBy(*keys).agg(pick(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*")
    ).select(*df.columns)
