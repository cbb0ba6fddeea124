"""Feature tables: square-grid features, buildings, schedules and the cell × hour-bucket table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates, geo, numbers, strings
from tessera.operators import aggregates as agg
from tessera.operators import joining, ordering

# Category sets of the crime ratios.
VIOLENT = (
    "Assault", "Homicide", "Robbery", "Aggravated Assault", "Simple Assault",
    "Offenses Against Child / Family",
)
PROPERTY = (
    "Larceny", "Motor Vehicle Accident Response", "Vandalism", "Burglary", "Auto Theft",
    "Larceny From Motor Vehicle", "Residential Burglary", "Commercial Burglary",
)


def with_grid(df: DataFrame, lat="lat", lon="long") -> DataFrame:
    """Add the 0.001° grid key; rows without coordinates drop out."""
    ok = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return df.where(ok).withColumn("grid_cell", geo.grid_key(lat, lon))


def grid_features(
    df: DataFrame,
    ts: str,
    windows: Mapping[str, int],
    measures: Sequence[Column] = (),
    ref: Column | None = None,
    label: tuple[str, str] | None = None,
) -> DataFrame:
    """Counts per grid cell over trailing windows from the newest event, plus extra measures, the
    cell centre and (``label`` = column, output name) the cell's most frequent label."""
    ref = agg.latest(df, ts) if ref is None else ref
    cells = with_grid(df)
    out = cells.groupBy("grid_cell").agg(*agg.trailing_counts(ts, ref, windows), *measures)
    if label:
        out = out.join(agg.mode(cells, ["grid_cell"], label[0], label[1]), "grid_cell", "left")
    lat, lon = geo.grid_centre("grid_cell")
    return out.withColumns({"grid_lat": lat, "grid_long": lon})


def crime_measures(ts: str, ref: Column, category="offense_category", hour="hour", day="day_of_week") -> list[Column]:
    recent = agg.since(ts, ref, 30)
    cat = F.lower(F.col(category))
    return [
        F.count_if(recent & F.col("shooting")).alias("shooting_count_30d"),
        agg.mean_if(F.col("shooting"), recent).alias("shooting_ratio_30d"),
        agg.mean_if(cat.isin(*[c.lower() for c in VIOLENT])).alias("violent_crime_ratio"),
        agg.mean_if(cat.isin(*[c.lower() for c in PROPERTY])).alias("property_crime_ratio"),
        agg.mean_if(dates.is_night(hour)).alias("night_crime_ratio"),
        agg.mean_if(F.col(day).isin("Saturday", "Sunday")).alias("weekend_crime_ratio"),
    ]


def crime_risk(features: DataFrame) -> DataFrame:
    """0.5 · count / max count + 0.3 · violent ratio + 0.2 if any shooting, clipped to 0..1."""
    top = joining.scalar(features, F.max("crime_count_30d"))
    volume = F.when(top > 0, F.col("crime_count_30d") / top).otherwise(0.0)
    score = (
        volume * 0.5
        + F.col("violent_crime_ratio") * 0.3
        + F.when(F.col("shooting_count_30d") > 0, 0.2).otherwise(0.0)
    )
    return features.withColumn("crime_risk_score", numbers.clip(score, 0, 1))


def building_features(df: DataFrame) -> DataFrame:
    """Per-area intensities, electricity share, score category and the top-quartile emitter flag."""
    p75 = joining.scalar(ordering.quantiles(df, [], "total_ghg_emissions", {"p": 0.75}), F.first("p"))
    return df.withColumns(
        {
            "emissions_per_sqft": numbers.ratio("total_ghg_emissions", "gross_floor_area"),
            "energy_per_sqft": numbers.ratio("site_energy_use_kbtu", "gross_floor_area"),
            "electricity_ratio": numbers.ratio("electricity_use_grid_purchase", "site_energy_use_kbtu"),
            "high_emitter": F.coalesce(F.col("total_ghg_emissions") >= p75, F.lit(False)).cast("int"),
            "energy_star_category": numbers.rating("energy_star_score"),
        }
    )


def category_code(df: DataFrame, column: str, out: str) -> DataFrame:
    """Position of the value among the sorted distinct values, -1 for NULL. Ranks are computed on
    the distinct values only."""
    distinct = df.select(column).distinct()
    ranks = ordering_text_rank(distinct, column).select(column, F.col("_rank").cast("int").alias(out))
    return joining.left_fill(df, joining.sized(ranks), [column], {out: -1})


def ordering_text_rank(distinct: DataFrame, column: str) -> DataFrame:
    """0-based alphabetical rank of distinct text values, in ranges cut by a sample of the values themselves."""
    values = distinct.where(F.col(column).isNotNull()).select(column)
    return ordering.numbered(values, column, "_rank")


def schedule_features(df: DataFrame, weeks: Sequence[str], days: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {
            "is_every_week": numbers.all_truthy(weeks).cast("int"),
            "sweep_days_count": numbers.count_truthy(days, (*strings.TRUE_FLAGS, "1.0")),
            "tow_enforced": F.lit(1),
            "season_start_month": F.lit(4),
            "season_end_month": F.lit(11),
            "active_months_count": F.lit(8),
        }
    )


def city_score_features(df: DataFrame, metrics: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Daily mean score joined with each metric's last score of the day as a column."""
    mean = df.groupBy("date").agg(F.avg("day_score").alias("avg_day_score"))
    last = agg.pivot_last(df, "date", "metric_name", metrics, "day_score", order)
    return mean.join(last, "date", "left")


def city_score_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The same in long form, for any number of metrics: (date, metric_name, day_score, avg_day_score), one row for each metric
    of a day with its last score and the day's mean."""
    parts = df.groupBy("date", "metric_name").agg(
        F.max_by("day_score", F.struct(*order)).alias("day_score"), F.sum("day_score").alias("_sum"), F.count("day_score").alias("_n")
    )
    days = parts.groupBy("date").agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_day_score"))
    return parts.select("date", "metric_name", "day_score").join(days, "date")


# -- cell × hour-bucket table ------------------------------------------------------------------


@dataclass(frozen=True)
class CellConfig:
    """Parameters of the cell feature table; the defaults are the fixed reference values."""

    short: int = 3
    medium: int = 10
    baseline: int = 30
    long: int = 90
    trend_caps: Mapping[str, float] = field(
        default_factory=lambda: {"trend_3v10": 3.4, "trend_10v30": 3.1, "trend_30v90": 3.1}
    )
    trend_default: float = 1.0
    trend_level: str = "cell"
    high_severity: float = 5.0
    buckets: tuple[int, ...] = (0, 1, 2, 3, 4, 5)
    night_buckets: tuple[int, ...] = (0, 5)
    evening_bucket: int = 4
    ring_weights: Mapping[int, float] = field(default_factory=lambda: dict(geo.RING_WEIGHTS))
    densify_first: bool = False


KEYS = ["h3_index", "hour_bucket"]
NEIGHBOUR_SOURCES = {
    "neighbor_weighted_score_30d": "weighted_score_30d",
    "neighbor_trend_3v10": "trend_3v10",
    "neighbor_gun_count_30d": "gun_incident_count_30d",
}


def bucket_sums(
    events: DataFrame, ref: Column, cfg: CellConfig, keys: Sequence[str] = KEYS, lags: Mapping[str, int] | None = None
) -> DataFrame:
    """Every windowed sum of one key from a single conditional aggregation. ``lags`` adds the
    baseline score as it stood some days before, from the same pass."""
    ts, w = "occurred_on_date", F.col("severity_weight")
    base, long = agg.since(ts, ref, cfg.baseline), agg.since(ts, ref, cfg.long)
    lags = lags or {}

    def total(days, cond=None):
        value = w if cond is None else F.when(cond, w)
        return agg.windowed_sum(value, ts, ref, days)

    past = {
        n: agg.windowed_sum(F.when(F.col(ts) <= dates.days_before(ref, d), w), ts, ref, cfg.baseline + d)
        for n, d in lags.items()
    }
    reach = max([cfg.long, *[cfg.baseline + d for d in lags.values()]])
    out = events.where(agg.since(ts, ref, reach)).groupBy(*keys).agg(
        total(cfg.short).alias("weighted_score_3d"),
        total(cfg.medium).alias("weighted_score_10d"),
        total(cfg.baseline).alias("weighted_score_30d"),
        total(cfg.long).alias("weighted_score_90d"),
        F.count_if(base).alias("incident_count_30d"),
        total(cfg.baseline, w >= cfg.high_severity).alias("violent_score_30d"),
        F.count_if(base & F.col("shooting")).alias("gun_incident_count_30d"),
        total(cfg.baseline, F.col("weekend")).alias("_weekend_30d"),
        *[c.alias(n) for n, c in past.items()],
        F.count_if(long).alias("_rows"),
    )
    return out.where("_rows > 0").drop("_rows")


def trends(sums: DataFrame, cfg: CellConfig) -> DataFrame:
    """Ratios of daily rates between windows, defaulted and capped."""
    rate = {
        3: F.col("weighted_score_3d") / cfg.short,
        10: F.col("weighted_score_10d") / cfg.medium,
        30: F.col("weighted_score_30d") / cfg.baseline,
        90: F.col("weighted_score_90d") / cfg.long,
    }
    out = {}
    for name, (a, b) in {"trend_3v10": (3, 10), "trend_10v30": (10, 30), "trend_30v90": (30, 90)}.items():
        out[name] = numbers.capped(numbers.ratio(rate[a], rate[b], cfg.trend_default), cfg.trend_caps[name])
    return sums.withColumns(out)


def cell_sums_exprs(cfg: CellConfig) -> list[Column]:
    night = F.col("hour_bucket").isin(*cfg.night_buckets)
    evening = F.col("hour_bucket") == cfg.evening_bucket
    ws = F.col("weighted_score_30d")
    names = ["weighted_score_3d", "weighted_score_10d", "weighted_score_30d", "weighted_score_90d"]
    return [
        *[F.sum(c).alias(c) for c in names],
        F.sum(F.when(night, ws).otherwise(0.0)).alias("_night"),
        F.sum(F.when(evening, ws).otherwise(0.0)).alias("_evening"),
        F.sum("_weekend_30d").alias("_weekend"),
    ]


def cell_sums(bucket: DataFrame, cfg: CellConfig) -> DataFrame:
    """Cell-level sums and time-of-day shares from the bucket table (six rows per cell, not the raw
    events)."""
    return bucket.groupBy("h3_index").agg(*cell_sums_exprs(cfg)).withColumns(
        {
            f"{n}_score_ratio": numbers.capped(numbers.ratio(f"_{n}", "weighted_score_30d", 0.0), 1.0)
            for n in ("night", "evening", "weekend")
        }
    )


def neighbour_means(df: DataFrame, sources: Mapping[str, str], cfg: CellConfig) -> DataFrame:
    """Ring-weighted means over the cells within two rings and the same bucket.

    Each row sends its weighted values to the cells around it (a constant 19-way explode) and one
    aggregation on the key collects them. Absent neighbours count 0 and the divisor is the full
    ring weight.
    """
    q, r = geo.cell_axes("h3_index")
    sent = df.select("*", q.alias("_q"), r.alias("_r")).select(
        "hour_bucket", *sources.values(), "_q", "_r", F.explode(geo.ring_array(cfg.ring_weights)).alias("_o")
    )
    target = geo.hex_id(F.col("_q") - F.col("_o.dq"), F.col("_r") - F.col("_o.dr"))
    total = geo.total_ring_weight(cfg.ring_weights)
    got = sent.groupBy(target.alias("h3_index"), "hour_bucket").agg(
        *[(F.sum(F.col(src) * F.col("_o.weight")) / total).alias(out) for out, src in sources.items()]
    )
    return df.join(got, KEYS, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in sources})


def _cells(bucket: DataFrame, cfg: CellConfig) -> DataFrame:
    """One row per cell: trends and shares, and its bucket rows packed in an array, which holds at
    most one entry per hour bucket."""
    sums = cell_sums_exprs(cfg)
    rows = F.collect_list(F.struct(*[c for c in bucket.columns if c not in ("h3_index", "_weekend_30d")]))
    out = trends(bucket.groupBy("h3_index").agg(*sums, rows.alias("_rows")), cfg)
    shares = {
        f"{n}_score_ratio": numbers.capped(numbers.ratio(f"_{n}", "weighted_score_30d", 0.0), 1.0)
        for n in ("night", "evening", "weekend")
    }
    cell_level = [*shares, *(cfg.trend_caps if cfg.trend_level == "cell" else [])]
    return out.withColumns(shares).select("h3_index", "_rows", *cell_level)


def _unpack(cells: DataFrame, cfg: CellConfig) -> DataFrame:
    """Each bucket's row as a struct column ``_r<bucket>`` (NULL where the cell has none)."""
    return cells.withColumns(
        {f"_r{b}": F.expr(f"get(filter(_rows, r -> r.hour_bucket = {b}), 0)") for b in cfg.buckets}
    ).drop("_rows")


def _spread_cells(cells: DataFrame, sources: Mapping[str, str], cfg: CellConfig) -> DataFrame:
    """Ring-weighted means for all buckets of a cell at once, as columns ``_n_<source>_<bucket>``.

    A cell sends one message to each cell around it, holding its values of all buckets, and its own
    packed rows ride on the message to itself: one shuffle, no self-join.
    """
    total = geo.total_ring_weight(cfg.ring_weights)
    own = [c for c in cells.columns if c != "h3_index"]
    values = {}
    for out, src in sources.items():
        for b in cfg.buckets:
            v = f"_r{b}.{src}"
            if src in cells.columns:
                v = src if cfg.densify_first else f"CASE WHEN _r{b} IS NOT NULL THEN {src} END"
            values[f"_n_{out}_{b}"] = f"coalesce(CAST({v} AS DOUBLE), 0D)"
    q, r = geo.cell_axes("h3_index")
    sent = _unpack(cells.withColumns({"_q": q, "_r": r, "_packed": F.col("_rows")}), cfg)
    own = ["_packed" if c == "_rows" else c for c in own]
    sent = sent.selectExpr("_q", "_r", *own, *[f"{v} AS {n}" for n, v in values.items()]).select(
        "*", F.explode(geo.ring_array(cfg.ring_weights)).alias("_o")
    )
    target = geo.hex_id(F.col("_q") - F.col("_o.dq"), F.col("_r") - F.col("_o.dr"))
    got = sent.groupBy(target.alias("h3_index")).agg(
        F.first(F.when(F.col("_o.ring") == 0, F.struct(*own)), ignorenulls=True).alias("_own"),
        *[F.expr(f"sum({n} * _o.weight) / {total}D AS {n}") for n in values],
    )
    return got.where("_own IS NOT NULL").select("h3_index", "_own.*", *values).withColumnRenamed("_packed", "_rows")


def cell_features(
    events: DataFrame,
    as_of: Column,
    cfg: CellConfig = CellConfig(),
    yesterday: DataFrame | None = None,
    week_ago: DataFrame | None = None,
    lags_from_events: bool = False,
) -> DataFrame:
    """The full cell × bucket table. Input columns: h3_index, hour_bucket, occurred_on_date,
    severity_weight, shooting (boolean) and weekend (boolean).

    Earlier scores come from stored snapshots, or from the events themselves in the same pass. The
    plan shuffles three times (events by key, buckets by cell, neighbour messages by cell), each
    time over less data than before.
    """
    located = events.where(F.col("h3_index").isNotNull() & F.col("hour_bucket").isNotNull())
    past = {"cell_score_yesterday": 1, "cell_score_7d_ago": 7}
    bucket = bucket_sums(located, as_of, cfg, KEYS, past if lags_from_events else None)
    if not lags_from_events:
        for name, snapshot in zip(past, (yesterday, week_ago)):
            if snapshot is None:
                bucket = bucket.withColumn(name, F.lit(0.0))
            else:
                bucket = joining.lagged(bucket, snapshot, KEYS, "weighted_score_30d", name)
    bucket = bucket.withColumn(
        "high_severity_ratio_30d",
        numbers.capped(numbers.ratio("violent_score_30d", "weighted_score_30d", 0.0), 1.0),
    )
    if cfg.trend_level != "cell":
        bucket = trends(bucket, cfg)
    sources = {**NEIGHBOUR_SOURCES, "neighbor_score_yesterday": "cell_score_yesterday"}
    cells = _spread_cells(_cells(bucket, cfg), sources, cfg)

    row_cols = [c for c in bucket.columns if c not in (*KEYS, "_weekend_30d")]
    counts = ("incident_count_30d", "gun_incident_count_30d")
    shares = ["night_score_ratio", "evening_score_ratio", "weekend_score_ratio"]

    def default(c):
        return "0L" if c in counts else f"{cfg.trend_default}D" if c in cfg.trend_caps else "0D"

    structs = []
    for b in cfg.buckets:
        fields = [f"{b} AS hour_bucket", *[f"coalesce(_r{b}.{c}, {default(c)}) AS {c}" for c in row_cols]]
        fields += [f"if(_r{b} IS NOT NULL, {c}, 0D) AS {c}" for c in shares]
        near = "_n_{n}_{b}" if cfg.densify_first else "if(_r{b} IS NOT NULL, _n_{n}_{b}, 0D)"
        fields += [near.format(n=n, b=b) + f" AS {n}" for n in sources]
        structs.append(f"struct({', '.join(fields)})")
    keep = list(cfg.trend_caps) if cfg.trend_level == "cell" else []
    return _unpack(cells, cfg).selectExpr("h3_index", *keep, f"inline(array({', '.join(structs)}))")


def danger_rate(incidents: DataFrame, target: str = "danger_rate") -> DataFrame:
    """Severity per active day and incident count for each cell and bucket. Days are reduced to
    distinct (key, day) rows first, so a hot key never gathers its days in one set."""
    rows = incidents.where(F.col("h3_index").isNotNull() & F.col("occurred_on_date").isNotNull())
    per_day = rows.groupBy(*KEYS, F.to_date("occurred_on_date").alias("_day")).agg(
        F.sum("severity_weight").alias("_sev"), F.count("incident_number").alias("_n")
    )
    out = per_day.groupBy(*KEYS).agg(
        F.sum("_sev").alias("total_severity"),
        F.count("*").alias("days_active"),
        F.sum("_n").alias("incident_count"),
    )
    return out.withColumn(target, F.col("total_severity") / F.greatest("days_active", F.lit(1)))


def training_matrix(features: DataFrame, incidents: DataFrame, target: str = "danger_rate") -> DataFrame:
    """Features with labels and the cell's most frequent district; cells without incidents get 0."""
    labels = danger_rate(incidents, target).select(*KEYS, target, "incident_count")
    district = agg.mode(incidents.where(F.col("h3_index").isNotNull()), ["h3_index"], "district")
    out = joining.left_fill(features, labels, KEYS, {target: 0.0, "incident_count": 0})
    return joining.left_fill(out, district, ["h3_index"], {"district": "UNKNOWN"})


def newest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    from tessera.operators.clean import dedup

    return dedup(df, keys, [order])


def load_features(store, dataset: str, as_of: str, lookback_days: int, columns: Sequence[str], keys: Sequence[str] = KEYS, order: str = "computed_date") -> DataFrame:
    """The newest features of each key from the partitions of the last ``lookback_days`` up to a date.

    A key's row is the one that was computed last, by ``order`` or, where features have none, by the partition's date. No
    partition in that time is an error, as is a wanted column that the partitions don't have.
    """
    since = (dt.date.fromisoformat(as_of) - dt.timedelta(days=lookback_days)).isoformat()
    if not any(since <= d <= as_of for d in store.stored_dates(dataset, "features")):
        raise LookupError(f"{dataset} has no features from {since} to {as_of}")
    rows = store.between(dataset, "features", since, as_of)
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"features of {dataset} lack {', '.join(missing)}; there are {', '.join(rows.columns)}")
    newest = order if order in rows.columns else "date"
    wanted = list(dict.fromkeys([*keys, *columns, newest]))
    return newest_per_key(rows.select(*wanted), keys, newest)
