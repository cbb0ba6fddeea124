"""Gates and anomaly detection. Every check turns into rows of one findings table:
(rule, severity, feature, n, ratio)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geo, numbers
from tessera.operators import aggregates as agg
from tessera.operators import ordering, profile
from tessera.operators.joining import scalar

FINDING = ["rule", "severity", "feature", "n", "ratio"]
# Features whose sparsity is expected, per dataset.
EXPECTED_MISSING = {
    "crime": (
        "offense_description", "reporting_area", "shooting", "ucr_part", "street", "lat", "long",
        "offense_code",
    ),
    "food_inspections": (
        "dbaname", "licensecat", "violation", "violdesc", "viol_level", "comments", "descript", "zip",
        "lat", "long", "licenseno",
    ),
    "service_311": ("close_date", "lat", "long"),
    "street_sweeping": ("sam_street_id", "from_street", "to_street", "season_start", "season_end", "lat", "long"),
    "cityscore": (),
}


class GateFailed(RuntimeError):
    """A gate in strict mode found errors."""


def _findings(df: DataFrame, rule, severity, feature, n, ratio) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule") if isinstance(rule, str) else rule.alias("rule"),
        F.lit(severity).alias("severity") if isinstance(severity, str) else severity.alias("severity"),
        (F.col(feature) if feature in df.columns else F.lit(feature)).alias("feature"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(ratio, F.lit(0.0)).cast("double").alias("ratio"),
    )


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def counted(df: DataFrame, checks: Sequence[tuple[str, str, str, Column]]) -> DataFrame:
    """One pass: count the rows that break each check; only broken checks give a finding.
    A check is (rule, severity, feature, violating condition)."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(f"_{i}") for i, (*_, c) in enumerate(checks)])
    items = [
        F.struct(
            F.lit(rule).alias("rule"), F.lit(sev).alias("severity"), F.lit(feat).alias("feature"),
            F.col(f"_{i}").alias("n"), numbers.ratio(f"_{i}", "_rows", 0.0).alias("ratio"),
        )
        for i, (rule, sev, feat, _) in enumerate(checks)
    ]
    return row.select(F.inline(F.array(*items))).where("n > 0")


def _number(df: DataFrame, c: str) -> Column:
    """A numeric column with NaN read as NULL, since NaN compares above every number."""
    floats = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    return F.when(~F.isnan(c), F.col(c)) if floats else F.col(c)


# -- contracts ---------------------------------------------------------------------------------

COMPATIBLE = {
    "string": (T.StringType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "number": profile.NUMERIC,
    "float": profile.NUMERIC,
    "boolean": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def type_matches(actual: T.DataType, wanted) -> bool:
    kinds = [wanted] if isinstance(wanted, str) else list(wanted)
    return any(isinstance(actual, COMPATIBLE[k]) for k in kinds if k in COMPATIBLE)


def contract_of(df: DataFrame) -> DataFrame:
    """A contract drawn from a table: column, type name, nullable as observed."""
    kinds = {}
    for f in df.schema:
        kinds[f.name] = next((k for k, ts in COMPATIBLE.items() if isinstance(f.dataType, ts)), "string")
    m = profile.moments(df)
    kind = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])[F.col("column")]
    return m.select("column", kind.alias("type"), (F.col("missing") > 0).alias("nullable"))


def contract_findings(
    df: DataFrame, contract: Mapping[str, Mapping], allow_extra: bool = True, required: Sequence[str] | None = None
) -> DataFrame:
    """Missing or extra columns, type mismatches, NULLs in non-nullable columns, and the minimum /
    maximum / enum constraints a contract may state. ``required`` limits which columns must exist;
    by default all of them must."""
    rows = []
    must = contract if required is None else required
    for c, spec in contract.items():
        if c not in df.columns:
            if c in must:
                rows.append(("missing_column", "error", c))
        elif not type_matches(df.schema[c].dataType, spec.get("type", "string")):
            rows.append(("type_mismatch", "error", c))
    if not allow_extra:
        rows += [("extra_column", "error", c) for c in df.columns if c not in contract]
    checks = []
    for c, spec in contract.items():
        if c not in df.columns:
            continue
        if not spec.get("nullable", True):
            checks.append(("null_in_required", "error", c, F.col(c).isNull()))
        if "minimum" in spec:
            checks.append(("below_minimum", "warning", c, _number(df, c) < spec["minimum"]))
        if "maximum" in spec:
            checks.append(("above_maximum", "warning", c, _number(df, c) > spec["maximum"]))
        if "enum" in spec:
            checks.append(("not_in_enum", "warning", c, ~F.col(c).isin(*spec["enum"])))
    schema = "rule string, severity string, feature string, n bigint, ratio double"
    static = df.sparkSession.createDataFrame([(*r, 0, 0.0) for r in rows], schema)
    return static.unionByName(counted(df, checks)) if checks else static


# -- gates -------------------------------------------------------------------------------------


def threshold_for(column: str, thresholds: Mapping[str, float], dataset: float | None, overall: float) -> float:
    """The column's own limit, else the dataset's, else the global one."""
    return thresholds.get(column, overall if dataset is None else dataset)


def min_rows(df: DataFrame, least: int) -> DataFrame:
    n = df.agg(F.count("*").alias("n")).where(F.col("n") < least)
    return _findings(n, "min_rows", "error", "__all__", F.col("n"), F.lit(0.0))


def null_ratio(df: DataFrame, limits: Mapping[str, float] | None = None, dataset=None, overall: float = 0.25):
    limits = limits or {}
    m = profile.moments(df)
    limit = F.create_map(
        *[x for c in df.columns for x in (F.lit(c), F.lit(float(threshold_for(c, limits, dataset, overall))))]
    )[F.col("column")]
    bad = m.where(F.col("missing_ratio") > limit)
    return _findings(bad, "null_ratio", "error", "column", F.col("missing"), F.col("missing_ratio"))


def duplicate_ratio(df: DataFrame, most: float = 0.01, keys: Sequence[str] | None = None) -> DataFrame:
    d = profile.duplicates(df, keys).where(F.col("duplicate_ratio") > most)
    return _findings(d, "duplicate_ratio", "warning", "__all__", F.col("duplicates"), F.col("duplicate_ratio"))


def geo_bounds(df: DataFrame, lat="lat", lon="long", box=geo.BOX, severity="warning") -> DataFrame:
    y, x = _number(df, lat), _number(df, lon)
    out_lat = (y < box["min_lat"]) | (y > box["max_lat"])
    out_lon = (x < box["min_lon"]) | (x > box["max_lon"])
    return counted(df, [("latitude_bounds", severity, lat, out_lat), ("longitude_bounds", severity, lon, out_lon)])


TIME_WORDS = ("date", "time", "timestamp", "occurred", "created")


def named_time_columns(df: DataFrame) -> list[str]:
    return [c for c in profile.time_columns(df) if any(w in c.lower() for w in TIME_WORDS)]


def time_bounds(df: DataFrame, as_of: Column, future_days=1, past_years=10, columns=None, old="info") -> DataFrame:
    checks = []
    for c in columns or named_time_columns(df):
        checks.append(("future_dates", "warning", c, F.col(c) > as_of + F.expr(f"INTERVAL {future_days} DAYS")))
        checks.append(("old_dates", old, c, F.col(c) < as_of - F.expr(f"INTERVAL {past_years * 365} DAYS")))
    return counted(df, checks)


def infinities(df: DataFrame) -> DataFrame:
    inf = float("inf")
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return counted(df, [("infinite_values", "error", c, F.abs(c) == inf) for c in floats])


def raw_gate(df, contract, least=100, limits=None, overall=0.25, dup=0.01, dataset=None) -> DataFrame:
    return union(
        [contract_findings(df, contract), min_rows(df, least), null_ratio(df, limits, dataset, overall), duplicate_ratio(df, dup)]
    )


def processed_gate(df, contract, as_of: Column, least=100, lat="lat", lon="long") -> DataFrame:
    return union([contract_findings(df, contract), min_rows(df, least), geo_bounds(df, lat, lon), time_bounds(df, as_of)])


def features_gate(df, contract, limits=None, overall=0.25) -> DataFrame:
    return union([contract_findings(df, contract), null_ratio(df, limits, None, overall), infinities(df)])


def cell_raw_gate(df, required: Sequence[str], key: str, skip: Sequence[str] = (), overall=0.25) -> DataFrame:
    """Required columns, at least one row, NULL or blank share per column, duplicate keys."""
    missing = [(("missing_column"), "error", c, 0, 0.0) for c in required if c not in df.columns]
    schema = "rule string, severity string, feature string, n bigint, ratio double"
    blank = {
        c: F.col(c).isNull() | (F.trim(F.col(c)) == "") if c in profile.text_columns(df) else F.col(c).isNull()
        for c in df.columns
        if c not in skip
    }
    nulls = counted(df, [("null_or_blank", "error", c, cond) for c, cond in blank.items()])
    return union(
        [
            df.sparkSession.createDataFrame(missing, schema),
            min_rows(df, 1),
            nulls.where(F.col("ratio") > overall),
            duplicate_ratio(df, 0.0, [key]),
        ]
    )


def cell_processed_gate(df) -> DataFrame:
    """No cell at all, hour bucket outside 0–5, non-positive severity."""
    empty = df.agg(F.count("*").alias("n"), F.count("h3_index").alias("k")).where("n > 0 and k = 0")
    return union(
        [
            _findings(empty, "all_cells_null", "error", "h3_index", F.col("n"), F.lit(1.0)),
            counted(
                df,
                [
                    ("bucket_range", "error", "hour_bucket", ~F.col("hour_bucket").between(0, 5)),
                    ("severity_positive", "error", "severity_weight", F.col("severity_weight") <= 0),
                ],
            ),
        ]
    )


def cell_features_gate(df, least_cells: int, score="risk_score", lo=0.0, hi=100.0) -> DataFrame:
    few = df.agg(F.count_distinct("h3_index").alias("n")).where(F.col("n") < least_cells)
    return union(
        [
            _findings(few, "min_cells", "error", "h3_index", F.col("n"), F.lit(0.0)),
            counted(df, [("score_bounds", "error", score, (F.col(score) < lo) | (F.col(score) > hi))]),
        ]
    )


def enforce(findings: DataFrame, strict: bool = True) -> DataFrame:
    """Raise when any error-level finding exists (looks at one row only)."""
    if strict and findings.where(F.col("severity").isin("error", "critical")).limit(1).count():
        raise GateFailed("validation found errors")
    return findings


# -- anomalies ---------------------------------------------------------------------------------


def missing_anomalies(df: DataFrame, warning=0.2, critical=0.5) -> DataFrame:
    m = profile.moments(df).where(F.col("missing_ratio") > warning)
    sev = F.when(F.col("missing_ratio") > critical, F.lit("critical")).otherwise(F.lit("warning"))
    return _findings(m, "missing_values", sev, "column", F.col("missing"), F.col("missing_ratio"))


def outlier_counts(df: DataFrame, columns: Sequence[str] | None = None, z: float = 3.5) -> DataFrame:
    """Per numeric column: rows beyond ``z`` population standard deviations and beyond 1.5·IQR."""
    columns = list(columns or profile.numeric_columns(df))
    long = agg.melt(df, columns).where("value is not null")
    m = long.groupBy("column").agg(
        F.count("*").alias("rows"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
    q = ordering.quantiles(long, ["column"], "value", {"q1": 0.25, "q3": 0.75})
    limits = F.broadcast(m.join(q, "column"))  # one row per column of the table
    iqr = F.col("q3") - F.col("q1")
    by_z = F.abs(F.col("value") - F.col("mean")) > z * F.col("std")
    by_iqr = (F.col("value") < F.col("q1") - 1.5 * iqr) | (F.col("value") > F.col("q3") + 1.5 * iqr)
    return long.join(limits, "column").groupBy("column").agg(
        F.max("rows").alias("rows"), F.count_if((F.col("std") > 0) & by_z).alias("z_outliers"), F.count_if(by_iqr).alias("iqr_outliers")
    )


def outlier_anomalies(df: DataFrame, columns=None, z=3.5, share=0.05, least=10) -> DataFrame:
    o = outlier_counts(df, columns, z).where(F.col("rows") >= least)
    n = F.greatest("z_outliers", "iqr_outliers")
    bad = o.withColumn("n", n).withColumn("ratio", numbers.ratio("n", "rows")).where(F.col("ratio") > share)
    return _findings(bad, "outlier", "warning", "column", F.col("n"), F.col("ratio"))


def geo_anomalies(df: DataFrame, lat="lat", lon="long", box=geo.BOX) -> DataFrame:
    zero = counted(df, [("zero_coordinates", "warning", f"{lat}/{lon}", (F.col(lat) == 0) & (F.col(lon) == 0))])
    return geo_bounds(df, lat, lon, box).unionByName(zero)


def category_anomalies(df: DataFrame, columns=None) -> DataFrame:
    """Columns that are nearly all unique, and columns made mostly of values seen once."""
    columns = list(columns or profile.text_columns(df))
    d = profile.keyed_counts(df, columns).groupBy("column").agg(
        F.sum("n").alias("present"), F.count("*").alias("distinct"), F.count_if(F.col("n") == 1).alias("singletons")
    )
    d = d.withColumns(
        {"unique_ratio": F.col("distinct") / F.col("present"), "single_ratio": F.col("singletons") / F.col("distinct")}
    )
    unique = d.where("unique_ratio > 0.9 and distinct > 100")
    single = d.where("single_ratio > 0.5 and distinct > 20")
    return _findings(unique, "high_cardinality", "info", "column", F.col("distinct"), F.col("unique_ratio")).unionByName(
        _findings(single, "singleton_values", "info", "column", F.col("singletons"), F.col("single_ratio"))
    )


def duplicate_anomalies(df: DataFrame) -> DataFrame:
    d = profile.duplicates(df).where("duplicates > 0")
    sev = (
        F.when(F.col("duplicate_ratio") > 0.1, "critical").when(F.col("duplicate_ratio") > 0.01, "warning").otherwise("info")
    )
    return _findings(d, "duplicate_rows", sev, "__all__", F.col("duplicates"), F.col("duplicate_ratio"))


def anomalies(
    df: DataFrame, as_of: Column, missing=True, outliers=True, geographic=True, temporal=True, categorical=True,
    duplicates=True,
) -> DataFrame:
    parts = []
    if missing:
        parts.append(missing_anomalies(df))
    if outliers and profile.numeric_columns(df):
        parts.append(outlier_anomalies(df))
    if geographic and {"lat", "long"} <= set(df.columns):
        parts.append(geo_anomalies(df))
    if temporal and named_time_columns(df):
        parts.append(time_bounds(df, as_of))
    if categorical and profile.text_columns(df):
        parts.append(category_anomalies(df))
    if duplicates:
        parts.append(duplicate_anomalies(df))
    return union(parts)


def suppress_expected(findings: DataFrame, dataset: str) -> DataFrame:
    expected = EXPECTED_MISSING.get(dataset, ())
    if not expected:
        return findings
    return findings.where(~((F.col("rule") == "missing_values") & F.col("feature").isin(*expected)))


def dataset_card(df: DataFrame, ts: str, findings: DataFrame) -> DataFrame:
    """One row: size, time range and finding counts by severity."""
    sev = {s: scalar(findings, F.count_if(F.col("severity") == s)) for s in ("info", "warning", "critical")}
    card = df.agg(F.count("*").alias("rows"), F.min(ts).alias("first_event"), F.max(ts).alias("last_event"))
    return card.select(
        "rows", F.lit(len(df.columns)).alias("columns"), "first_event", "last_event",
        *[v.alias(f"findings_{s}") for s, v in sev.items()],
    )
