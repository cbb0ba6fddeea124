"""Cleaning behaviour and the dataset plans."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import dates, geo, numbers, strings
from tessera.operators import clean
from tessera.plans import datasets


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text,want", [("Y", True), (" yes ", True), ("1", True), ("0", False), ("", False), (None, False), ("TRUE", True)])
def test_truthy(spark, text, want):
    assert one(spark, text, strings.truthy) is want


@pytest.mark.parametrize("text,want", [("  a1 ", "A1"), ("\t\n", "UNKNOWN"), (None, "UNKNOWN")])
def test_upper_or(spark, text, want):
    assert one(spark, text, lambda c: strings.upper_or(c, "UNKNOWN")) == want


@pytest.mark.parametrize("text,want", [("nan", None), (" n/a", None), ("x", "x"), (None, None)])
def test_null_tokens(spark, text, want):
    assert one(spark, text, strings.null_tokens) == want


def test_first_keyword_wins(spark):
    w = lambda c: strings.keyword_weight(c, datasets.SEVERITY_WEIGHTS, 1.0)
    assert one(spark, "drugs - robbery", w) == 3.0
    assert one(spark, "sick assist", w) == 0.1
    assert one(spark, None, w) == 1.0


def test_pair_and_wkt(spark):
    lat, lon = strings.extract_pair("x")
    df = spark.createDataFrame([("(42.3, -71.06)",), ("bad",), (None,)], "x string").select(lat.alias("a"), lon.alias("b"))
    assert [tuple(r) for r in df.collect()] == [(42.3, -71.06), (None, None), (None, None)]
    a, b = geo.wkt_centroid("x")
    got = spark.createDataFrame([("LINESTRING (-71 42, -71.2 42.2)",), ("",)], "x string").select(a.alias("a"), b.alias("b")).collect()
    assert got[0].a == pytest.approx(42.1) and got[0].b == pytest.approx(-71.1) and got[1].a is None


def test_parse_with_and_without_offset(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+02:00",), ("2024-01-01 08:00:00",), ("x",)], "x string").select(dates.parse_utc("x").alias("t"))
    a, b, c = (r.t for r in df.collect())
    assert a == b and c is None


def test_nan_and_inf_are_not_in_range(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (None,)], "x double").select(numbers.in_range("x", 0, 2).alias("y"))
    assert [r.y for r in df.collect()] == [False, False, True, False]


def test_half_even_grid(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "x double").select(geo.snap("x", 1.0).alias("y"))
    assert [r.y for r in df.collect()] == [2.0, 4.0]


def test_first_matching_box(spark):
    df = spark.createDataFrame([(42.356, -71.06), (10.0, 10.0), (None, 1.0)], "lat double, lon double").select(geo.first_box("lat", "lon").alias("y"))
    assert [r.y for r in df.collect()] == ["Beacon Hill / North End", "Other", "Unknown"]


def test_dedup_keeps_whole_rows_in_order(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, None), ("k", 2, "c"), (None, 1, "n")], "k string, t int, v string")
    last = {r.k: (r.t, r.v) for r in clean.dedup(df, ["k"], ["t"]).collect()}
    assert last == {"k": (3, None), None: (1, "n")}
    assert {r.k: r.t for r in clean.dedup(df, ["k"], ["t"], "first").collect()} == {"k": 1, None: 1}


def test_ledger_counts_first_reason(spark):
    df = spark.createDataFrame([(None, 1.0), (42.3, -71.0), (50.0, -71.0)], "lat double, long double")
    tagged = clean.tag_drops(df, clean.location_reasons())
    assert {r.drop_reason: r.rows for r in clean.ledger(tagged).collect()} == {"missing_coordinates": 1, "outside_box": 1}
    assert clean.kept(tagged).count() == 1


RAW = "INCIDENT_NUMBER string, OFFENSE_CODE string, OFFENSE_CODE_GROUP string, OFFENSE_DESCRIPTION string, DISTRICT string, SHOOTING string, OCCURRED_ON_DATE string, HOUR string, DAY_OF_WEEK string, Lat string, Long string"


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("I1", "613", "larceny", "LARCENY SHOPLIFTING", " d4 ", "0", "2024-01-10 13:00:00", "13", "Wednesday", "42.35", "-71.06"),
        ("I1", "613", "larceny", "LARCENY SHOPLIFTING", "D4", "0", "2024-01-11 13:00:00", "13", "Thursday", "42.35", "-71.06"),
        ("I2", "x", "Robbery", "ROBBERY", "", "Y", "2024-01-12 23:00:00", "23", "Friday", "0", "-71.06"),
        ("I3", "1", None, "MURDER", "A1", "1", "not a date", "1", "Friday", "42.3", "-71.1"),
        ("I4", "1", None, "MURDER", "A1", "1", "2001-01-01 00:00:00", "0", "Monday", "42.3", "-71.1"),
        ("I5", "1", None, "MURDER", "A1", "1", "2030-01-01 00:00:00", "0", "Monday", "42.3", "-71.1"),
    ]
    return spark.createDataFrame(rows, RAW)


def test_crime_plan(raw):
    out = {r.incident_number: r for r in datasets.clean(datasets.CRIME, raw, F.lit("2024-01-15").cast("timestamp")).collect()}
    assert set(out) == {"I1", "I2"}
    assert out["I1"].district == "D4" and out["I1"].shooting is False and out["I1"].day_of_week == "Thursday"
    assert out["I2"].lat is None and out["I2"].long is None and out["I2"].offense_code is None
    assert out["I2"].shooting is True and out["I2"].district == "UNKNOWN" and out["I1"].offense_category == "Larceny"


def test_cell_plan_features(raw):
    plan = datasets.CRIME_BY_CELL
    done = datasets.clean(plan, raw)
    w = {r.incident_number: (r.severity_weight, r.hour_bucket) for r in done.collect()}
    assert w["I3"] == (6.0, 0) and w["I2"][0] == 3.0  # "Y" is not the cell feed's shooting flag
    built = datasets.build(plan, done, F.lit("2024-01-15").cast("timestamp"))
    assert built.count() % 6 == 0


def test_grid_plan_features(raw):
    plan, as_of = datasets.CRIME, F.lit("2024-01-15").cast("timestamp")
    out = datasets.build(plan, datasets.clean(plan, raw, as_of), as_of).collect()
    assert len(out) == 1 and out[0].grid_cell == "42.350_-71.060" and out[0].crime_count_7d == 1 and 0 <= out[0].crime_risk_score <= 1
    assert datasets.check_definitions(plan, datasets.build(plan, datasets.clean(plan, raw, as_of), as_of)).where("below_min or above_max").count() == 0


def test_building_and_schedule_plans(spark):
    b = spark.createDataFrame(
        [(1, 2023, "office", "100", "50", "80", "-5"), (2, 2023, "nan", "0", "10", None, "1")],
        "_id int, reporting_year int, property_type string, gross_floor_area string, total_ghg_emissions string, energy_star_score string, electricity_use_grid_purchase string",
    ).withColumn("site_energy_use_kbtu", F.lit("10"))
    done = datasets.clean(datasets.BUILDINGS, b)
    got = {r._id: r for r in datasets.build(datasets.BUILDINGS, done).collect()}
    assert got[1].emissions_per_sqft == 0.5 and got[1].high_emitter == 1 and got[1].energy_star_category == "High" and got[1].electricity_ratio is None
    assert got[2].emissions_per_sqft is None and got[2].energy_star_category == "Unknown" and got[2].property_type == "Unknown"
    s = spark.createDataFrame([(1, "12.0", "B"), (2, "13", "A"), (3, "14", None)], "_id int, sam_street_id string, district string")
    s = s.withColumns({w: F.lit("yes") for w in datasets.WEEKS} | {d: F.lit("1" if d == "monday" else "0") for d in datasets.DAYS})
    got = {r._id: r for r in datasets.build(datasets.STREET_SWEEPING, datasets.clean(datasets.STREET_SWEEPING, s)).collect()}
    assert (got[1].sam_street_id, got[1].district_code, got[2].district_code, got[3].district_code) == ("12", 1, 0, -1)
    assert got[1].is_every_week == 1 and got[1].sweep_days_count == 1


def test_city_scores_and_requests_and_inspections(spark):
    c = spark.createDataFrame([("on time", "2024-01-01 10:00:00", "1", "0.5"), ("on time", "2024-01-01 12:00:00", "1", "0.7"), ("b-c", "2024-01-01 09:00:00", "1", "x")], "metric_name string, score_calculated_ts string, target string, day_score string")
    out = datasets.build(datasets.CITY_SCORES, datasets.clean(datasets.CITY_SCORES, c)).first()
    assert out.on_time == 0.7 and out.b_c == 0.0 and out.avg_day_score == pytest.approx(0.4)
    r = spark.createDataFrame([("1", "2024-01-01", "back bay", "42.35", "-71.06", "OVERDUE"), ("2", "2023-12-30", None, "42.35", "-71.06", "ONTIME")], "case_enquiry_id string, open_dt string, neighborhood string, latitude string, longitude string, ontime string")
    got = datasets.build(datasets.SERVICE_REQUESTS, datasets.clean(datasets.SERVICE_REQUESTS, r)).first()
    assert got.request_count_7d == 2 and got.overdue_ratio_30d == 0.5 and got.neighborhood == "Back Bay"
    f = spark.createDataFrame([(1, "2024-01-01", "HE_Fail", "(42.35, -71.06)", "2115"), (2, "2024-01-01", "HE_Pass", "(42.35, -71.06)", "02115-1")], "_id int, resultdttm string, result string, location string, zip string")
    done = datasets.clean(datasets.FOOD_INSPECTIONS, f)
    assert {x.zip for x in done.collect()} == {"02115"}
    assert datasets.build(datasets.FOOD_INSPECTIONS, done).first().failure_ratio_180d == 0.5


def test_empty_inputs_keep_the_contract(raw):
    out = datasets.clean(datasets.CRIME, raw.where("false"), F.lit("2024-01-15").cast("timestamp"))
    assert out.count() == 0 and "occurred_on_date" in out.columns
