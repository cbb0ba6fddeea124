"""The datasets as configuration over shared operators, plus the hooks for user-defined ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates, geo, numbers, strings
from tessera.operators import aggregates as agg
from tessera.operators import clean as cleaning
from tessera.operators import features
from tessera.operators.profile import feature_ranges
from tessera.sources.layers import incremental

# Ordered keyword weights; the first keyword found decides.
SEVERITY_WEIGHTS = {
    "MURDER": 3.0, "MANSLAUGHTER": 3.0, "BALLISTICS EVIDENCE": 3.0, "ASSAULT - AGGRAVATED": 3.0, "ROBBERY": 3.0,
    "RAPE": 3.0, "SEXUAL ASSAULT": 3.0, "KIDNAPPING": 3.0, "WEAPON VIOLATION": 3.0, "FIREARM": 3.0,
    "ASSAULT - SIMPLE": 3.0, "THREATS TO DO BODILY HARM": 3.0, "INTIMIDATING WITNESS": 3.0, "EXTORTION": 3.0,
    "CARJACKING": 3.0, "BURGLARY": 3.0, "BREAKING AND ENTERING": 3.0, "AUTO THEFT": 3.0, "DRUGS": 2.0, "ARSON": 2.0,
    "HOME INVASION": 2.0, "INVESTIGATE PERSON": 0.5, "INVESTIGATE PROPERTY": 0.5, "SERVICE TO OTHER": 0.1,
    "SICK ASSIST": 0.1, "MISSING PERSON": 0.5,
}
SHOOTING_FACTOR = 2.0


@dataclass(frozen=True)
class DatasetPlan:
    """Everything that differs between datasets. ``transform`` and ``features`` take a DataFrame and
    the reference time and return a DataFrame."""

    name: str
    mappings: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    keys: Sequence[str] = ()
    order: Sequence[str] = ()
    time: str | None = None
    transform: Callable[[DataFrame, Column | None], DataFrame] | None = None
    output: Sequence[str] = ()
    features: Callable[[DataFrame, Column | None], DataFrame] | None = None
    definitions: Sequence[tuple[str, float | None, float | None]] = ()
    raw_contract: Mapping[str, Mapping] = field(default_factory=dict)
    processed_contract: Mapping[str, Mapping] = field(default_factory=dict)
    #: Contracts by layer, as ``sources.contracts.with_contracts`` puts them in; they take the place of the two above.
    contracts: Mapping[str, object] = field(default_factory=dict)
    fairness_dimension: str | None = None
    drift_offset_days: int = 1
    drift_ignore: Sequence[str] = ()
    reader: Callable | None = None


def ingest(plan: DatasetPlan, raw: DataFrame, since: Column, until: Column | None = None, time: str | None = None) -> DataFrame:
    """New rows of a source past its watermark."""
    return incremental(raw, time or plan.time, since, until)


def clean(plan: DatasetPlan, raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """NaN to NULL, rename, coerce, transform, deduplicate and project."""
    df = cleaning.coerce(cleaning.rename(cleaning.nan_to_null(raw), plan.mappings), plan.types)
    if plan.transform is not None:
        df = plan.transform(df, as_of)
    if plan.keys:
        df = cleaning.dedup(df, plan.keys, plan.order or plan.keys)
    return cleaning.keep_existing(df, plan.output) if plan.output else df


def build(plan: DatasetPlan, processed: DataFrame, as_of: Column | None = None) -> DataFrame:
    return plan.features(processed, as_of)


def check_definitions(plan: DatasetPlan, built: DataFrame) -> DataFrame:
    return feature_ranges(built, [d for d in plan.definitions if d[0] in built.columns])


def _time_filter(df: DataFrame, ts: str, as_of: Column | None) -> DataFrame:
    if as_of is None:
        return cleaning.drop_rows(df, {"invalid_date": F.col(ts).isNull()})
    return cleaning.drop_rows(df, cleaning.time_reasons(ts, as_of))


def _parts(df: DataFrame, ts: str) -> DataFrame:
    """Date parts, kept where the source already has them."""
    parts = {**dates.date_parts(ts), "day_of_week": dates.day_name(ts)}
    keep = {n: parts[n] for n in ("year", "month", "hour", "day_of_week")}
    return df.withColumns(
        {n: F.coalesce(F.col(n).cast("string" if n == "day_of_week" else "int"), c) if n in df.columns else c for n, c in keep.items()}
    )


# -- crime ---------------------------------------------------------------------------------------


def _crime(df: DataFrame, as_of) -> DataFrame:
    df = _time_filter(df.withColumn("shooting", strings.truthy("shooting")), "occurred_on_date", as_of)
    df = cleaning.null_pair_outside(_parts(df, "occurred_on_date"))
    return df.withColumns(
        {"district": strings.upper_or("district", "UNKNOWN"), "offense_category": strings.title_or("offense_category", "Other")}
    )


def _crime_features(df: DataFrame, as_of) -> DataFrame:
    ref = agg.latest(df, "occurred_on_date") if as_of is None else as_of
    windows = {f"crime_count_{d}d": d for d in (7, 30, 90)}
    out = features.grid_features(df, "occurred_on_date", windows, features.crime_measures("occurred_on_date", ref), ref, ("district", "district"))
    return features.crime_risk(out)


CRIME_MAP = {
    "INCIDENT_NUMBER": "incident_number", "OFFENSE_CODE": "offense_code", "OFFENSE_CODE_GROUP": "offense_category",
    "OFFENSE_DESCRIPTION": "offense_description", "DISTRICT": "district", "REPORTING_AREA": "reporting_area", "SHOOTING": "shooting",
    "OCCURRED_ON_DATE": "occurred_on_date", "YEAR": "year", "MONTH": "month", "DAY_OF_WEEK": "day_of_week", "HOUR": "hour",
    "UCR_PART": "ucr_part", "STREET": "street", "Lat": "lat", "Long": "long",
}
CRIME = DatasetPlan(
    name="crime", mappings=CRIME_MAP,
    types={"incident_number": "string", "offense_code": "int", "shooting": "string", "occurred_on_date": "datetime", "lat": "float", "long": "float", "year": "int", "month": "int", "hour": "int"},
    keys=["incident_number"], order=["occurred_on_date"], time="occurred_on_date", transform=_crime,
    output=["incident_number", "offense_code", "offense_category", "offense_description", "district", "reporting_area", "shooting", "occurred_on_date", "year", "month", "day_of_week", "hour", "ucr_part", "street", "lat", "long"],
    features=_crime_features,
    definitions=[("grid_lat", 42.2, 42.4), ("grid_long", -71.2, -70.9), *[(f"crime_count_{d}d", 0.0, None) for d in (7, 30, 90)], ("shooting_ratio_30d", 0.0, 1.0), ("crime_risk_score", 0.0, 1.0)],
    processed_contract={"incident_number": {"type": "string", "nullable": False}, "occurred_on_date": {"type": "datetime", "nullable": False}, "shooting": {"type": "boolean"}, "hour": {"type": "integer", "minimum": 0, "maximum": 23}},
    fairness_dimension="district",
)

# -- crime by cell -------------------------------------------------------------------------------


def _cells(df: DataFrame, as_of) -> DataFrame:
    df = cleaning.null_each_outside(df.withColumn("shooting", strings.is_one("shooting")))
    df = df.withColumns(
        {
            "severity_weight": strings.keyword_weight("offense_description", SEVERITY_WEIGHTS, 1.0, F.col("shooting"), SHOOTING_FACTOR),
            "hour": F.coalesce(F.col("hour").cast("int"), F.lit(0)),
            "day_of_week": strings.strip("day_of_week"),
        }
    )
    return df.withColumns(
        {
            "h3_index": geo.hex_cell("lat", "long"),
            "hour_bucket": F.when(F.col("hour").between(0, 23), dates.hour_bucket("hour")),
            "weekend": F.lower("day_of_week").isin("saturday", "sunday"),
        }
    )


CRIME_BY_CELL = DatasetPlan(
    name="crime_navigate", mappings=CRIME_MAP,
    types={"incident_number": "string", "occurred_on_date": "datetime", "lat": "float", "long": "float", "hour": "int"},
    keys=["incident_number"], order=["occurred_on_date"], time="occurred_on_date", transform=_cells,
    output=["incident_number", "offense_description", "occurred_on_date", "shooting", "severity_weight", "lat", "long", "h3_index", "hour", "hour_bucket", "day_of_week", "weekend", "district"],
    features=lambda df, as_of: features.cell_features(df, as_of if as_of is not None else agg.latest(df, "occurred_on_date"), lags_from_events=True),
    definitions=[("night_score_ratio", 0.0, 1.0), ("evening_score_ratio", 0.0, 1.0), ("weekend_score_ratio", 0.0, 1.0), ("trend_3v10", 0.0, 3.4)],
    fairness_dimension="district", drift_offset_days=3,
)

# -- service requests ----------------------------------------------------------------------------


def _requests(df: DataFrame, as_of) -> DataFrame:
    df = cleaning.null_pair_outside(_parts(_time_filter(df, "open_date", as_of), "open_date"))
    return df.withColumn("neighborhood", strings.title_or("neighborhood", "Unknown"))


def _request_features(df: DataFrame, as_of) -> DataFrame:
    ref = agg.latest(df, "open_date") if as_of is None else as_of
    overdue = agg.mean_if(F.col("on_time") == "OVERDUE", agg.since("open_date", ref, 30)).alias("overdue_ratio_30d")
    return features.grid_features(df, "open_date", {f"request_count_{d}d": d for d in (7, 30, 90)}, [overdue], ref, ("neighborhood", "neighborhood"))


# The source's columns and what they are called here.
REQUEST_COLUMNS = {
    "case_enquiry_id": "case_id", "open_dt": "open_date", "closed_dt": "close_date", "subject": "case_topic",
    "reason": "service_name", "department": "assigned_department", "case_status": "case_status",
    "neighborhood": "neighborhood", "latitude": "lat", "longitude": "long", "on_time": "on_time", "type": "type",
}
SERVICE_REQUESTS = DatasetPlan(
    name="service_311",
    mappings={**REQUEST_COLUMNS, "ontime": "on_time"},  # older extracts spell it in one word
    types={"case_id": "string", "open_date": "datetime", "close_date": "datetime", "lat": "float", "long": "float"},
    keys=["case_id"], order=["open_date"], time="open_date", transform=_requests,
    output=["case_id", "open_date", "close_date", "case_topic", "service_name", "type", "assigned_department", "case_status", "neighborhood", "on_time", "lat", "long", "year", "month", "hour", "day_of_week"],
    features=_request_features, definitions=[("overdue_ratio_30d", 0.0, 1.0)], fairness_dimension="neighborhood",
    drift_ignore=["open_date", "on_time", "case_status", "close_date"],
)

# -- inspections ---------------------------------------------------------------------------------


def _inspections(df: DataFrame, as_of) -> DataFrame:
    lat, lon = strings.extract_pair("location")
    df = df.withColumns({"lat": lat, "long": lon})
    df = cleaning.null_pair_outside(_parts(_time_filter(df, "resultdttm", as_of), "resultdttm"))
    return cleaning.fill(df.withColumn("zip", strings.zip5("zip")), {"businessname": "Unknown", "result": "Unknown"})


def _inspection_features(df: DataFrame, as_of) -> DataFrame:
    ref = agg.latest(df, "resultdttm") if as_of is None else as_of
    fail, recent = strings.contains_ci("result", "fail"), agg.since("resultdttm", ref, 180)
    measures = [F.count_if(fail & recent).alias("failure_count_180d"), agg.mean_if(fail, recent).alias("failure_ratio_180d")]
    out = features.grid_features(df, "resultdttm", {f"inspection_count_{d}d": d for d in (90, 180, 365)}, measures, ref)
    return out.withColumn("neighborhood", F.lit("Unknown"))


FOOD_INSPECTIONS = DatasetPlan(
    name="food_inspections", types={"_id": "int", "resultdttm": "datetime"}, keys=["_id"], order=["resultdttm"], time="resultdttm", transform=_inspections,
    output=["_id", "businessname", "licenseno", "result", "resultdttm", "viol_level", "address", "zip", "lat", "long", "year", "month", "day_of_week"],
    features=_inspection_features, definitions=[("failure_ratio_180d", 0.0, 1.0)],
    drift_ignore=["_id", "businessname", "licenseno", "resultdttm", "address", "zip", "lat", "long", "year", "month", "day_of_week"],
)

# -- city scores ---------------------------------------------------------------------------------


def _scores(df: DataFrame, as_of) -> DataFrame:
    df = _parts(_time_filter(df, "timestamp", as_of), "timestamp")
    nums = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in ("target", "day_score", "week_score", "month_score") if c in df.columns}
    return df.withColumns({**nums, "metric_name": strings.title_or("metric_name", "Unknown"), "date": F.to_date("timestamp")})


def _score_features(df: DataFrame, as_of) -> DataFrame:
    """Columns per metric, whose names are read first. Beyond MAX_METRICS names, which is more columns than a table should have,
    the long form: a row for each day and metric."""
    names = [r.metric_name for r in df.select("metric_name").distinct().limit(MAX_METRICS + 1).collect()]
    if len(names) > MAX_METRICS:
        return features.city_score_rows(df, ["timestamp"])
    names.sort()
    return cleaning.normalise_headers(features.city_score_features(df, names, ["timestamp"]), dash=True)


MAX_METRICS = 2000
CITY_SCORES = DatasetPlan(
    name="cityscore", mappings={"score_calculated_ts": "timestamp"}, types={"timestamp": "datetime"},
    keys=["metric_name", "timestamp"], order=["timestamp"], time="timestamp", transform=_scores,
    output=["metric_name", "timestamp", "target", "day_score", "week_score", "month_score", "year", "month", "hour", "day_of_week", "date"],
    features=_score_features, fairness_dimension="metric_name",
)

# -- buildings -----------------------------------------------------------------------------------

BUILDING_NUMBERS = ["gross_floor_area", "site_energy_use_kbtu", "total_ghg_emissions", "energy_star_score", "electricity_use_grid_purchase", "natural_gas_use", "lat", "long"]


def _buildings(df: DataFrame, as_of) -> DataFrame:
    df = df.withColumns({c: numbers.non_negative(F.col(c).try_cast("double")) for c in BUILDING_NUMBERS if c in df.columns and c != "long"})
    text = {c: F.upper(strings.null_tokens(c)) for c in ("address", "zip", "property_type") if c in df.columns}
    df = df.withColumns(text)
    if "electricity_use_grid_purchase" in df.columns:
        df = df.withColumn("electricity_use_grid_purchase", numbers.kwh_to_kbtu("electricity_use_grid_purchase"))
    return cleaning.fill(df, {"property_type": "Unknown"})


BUILDINGS = DatasetPlan(
    name="berdo", types={"_id": "int", "reporting_year": "int"}, keys=["_id"], order=["reporting_year"], transform=_buildings,
    output=["_id", "reporting_year", "property_name", "address", "zip", "property_type", *BUILDING_NUMBERS],
    features=lambda df, as_of: cleaning.keep_existing(features.building_features(df), ["_id", "emissions_per_sqft", "energy_per_sqft", "high_emitter", "energy_star_category", "electricity_ratio", "property_type"]),
    definitions=[("emissions_per_sqft", 0.0, None), ("energy_per_sqft", 0.0, None)], fairness_dimension="property_type", drift_offset_days=365,
)

# -- street sweeping -----------------------------------------------------------------------------

WEEKS = ["week_1", "week_2", "week_3", "week_4"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday"]


def _sweeping(df: DataFrame, as_of) -> DataFrame:
    return df.withColumn("sam_street_id", strings.drop_decimal_tail("sam_street_id"))


def _sweeping_features(df: DataFrame, as_of) -> DataFrame:
    df = df.withColumns({c: F.lit(None).cast("string") for c in (*WEEKS, *DAYS) if c not in df.columns})
    out = features.category_code(features.schedule_features(df, WEEKS, DAYS), "district", "district_code")
    return out.select("_id", "sam_street_id", "district", "tow_enforced", "is_every_week", "sweep_days_count", "season_start_month", "season_end_month", "active_months_count", "district_code")


STREET_SWEEPING = DatasetPlan(
    name="street_sweeping", types={"_id": "int", "sam_street_id": "string"}, keys=["_id"], order=["_id"], transform=_sweeping,
    features=_sweeping_features, definitions=[("district_code", -1.0, None)], fairness_dimension="district", drift_offset_days=30,
)

ALL = {p.name: p for p in (CRIME, CRIME_BY_CELL, SERVICE_REQUESTS, FOOD_INSPECTIONS, CITY_SCORES, BUILDINGS, STREET_SWEEPING)}
