"""String cleaning as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRUE_FLAGS = ("Y", "1", "TRUE", "YES")
NULL_TOKENS = ("NAN", "NONE", "<NA>", "NULL", "NOT AVAILABLE", "N/A")
STREET_TYPES = {
    "AVE": "Avenue", "AVENUE": "Avenue", "ST": "Street", "STREET": "Street", "RD": "Road",
    "ROAD": "Road", "BLVD": "Boulevard", "BOULEVARD": "Boulevard", "HWY": "Highway",
    "HIGHWAY": "Highway", "DR": "Drive", "DRIVE": "Drive", "PL": "Place", "PLACE": "Place",
    "CT": "Court", "COURT": "Court", "SQ": "Square", "SQUARE": "Square", "WAY": "Way",
    "TER": "Terrace", "TERRACE": "Terrace",
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters that count as white space when stripping.
WHITESPACE = " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(col(c), F.lit(WHITESPACE))


def upper_or(c, default: str) -> Column:
    """Trim and upper-case; blank or NULL becomes ``default``."""
    v = F.upper(strip(c))
    return F.when(v.isNull() | (v == ""), F.lit(default)).otherwise(v)


def title_or(c, default: str) -> Column:
    return F.coalesce(F.initcap(strip(c)), F.lit(default))


def truthy(c, values: Sequence[str] = TRUE_FLAGS) -> Column:
    """Flag parsing from text; NULL is false."""
    return F.coalesce(F.upper(strip(col(c).cast("string"))).isin(*values), F.lit(False))


def is_one(c) -> Column:
    return F.coalesce(strip(col(c).cast("string")) == "1", F.lit(False))


def contains_ci(c, needle: str) -> Column:
    return F.coalesce(F.contains(F.lower(col(c)), F.lit(needle.lower())), F.lit(False))


def null_tokens(c, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    v = strip(c)
    return F.when(F.upper(v).isin(*tokens), F.lit(None)).otherwise(v)


def keyword_weight(
    c, rules: Mapping[str, float], default: float, flag: Column | None = None, factor: float = 1.0
) -> Column:
    """Weight of the first rule whose keyword occurs in the text, times ``factor`` when flagged."""
    text = F.upper(F.coalesce(col(c), F.lit("")))
    weight = F.lit(float(default))
    for keyword, w in reversed(list(rules.items())):
        weight = F.when(F.contains(text, F.lit(keyword)), F.lit(float(w))).otherwise(weight)
    if flag is None:
        return weight
    return F.when(F.coalesce(flag, F.lit(False)), weight * factor).otherwise(weight)


def extract_pair(c) -> tuple[Column, Column]:
    """The two numbers of "(lat, lon)" text, NULL where it does not parse."""
    pattern = r"\(\s*(-?\d+\.?\d*)\s*,\s*(-?\d+\.?\d*)\s*\)"
    return tuple(F.regexp_extract(col(c), pattern, i).try_cast("double") for i in (1, 2))


def drop_decimal_tail(c) -> Column:
    return F.split_part(col(c).cast("string"), F.lit("."), F.lit(1))


def money(c) -> Column:
    return F.regexp_replace(col(c), r"[$,\s]", "").try_cast("double")


def zip5(c) -> Column:
    return F.lpad(F.substring(strip(col(c).cast("string")), 1, 5), 5, "0")


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Value map held in the plan; meant for small fixed maps."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    hit = F.create_map(*pairs)[col(c)]
    return hit if default is None else F.coalesce(hit, F.lit(default))


def last_token(c) -> Column:
    return F.upper(F.element_at(F.split(strip(c), r"\s+"), -1))


def street_type(c) -> Column:
    return lookup(last_token(c), STREET_TYPES, "Other")


def clean_kind(c, expected: str) -> Column:
    """Free text → the expected word, "(missing)" or "(dirty)"."""
    v = F.regexp_replace(F.lower(strip(F.coalesce(col(c), F.lit("")))), "`+$", "")
    v = F.regexp_replace(v, "s+$", "")
    return (
        F.when(v == expected.lower(), F.lit(expected.upper()))
        .when(v.isin("none", "nan", ""), F.lit("(missing)"))
        .otherwise(F.lit("(dirty)"))
    )


def three_way(c, first: tuple[str, str], second: tuple[str, str], other: str) -> Column:
    """Label by substring: ``(needle, label)`` pairs tried in order."""
    return (
        F.when(contains_ci(c, first[0]), F.lit(first[1]))
        .when(contains_ci(c, second[0]), F.lit(second[1]))
        .otherwise(F.lit(other))
    )


def other_text(main, other, prefix: str = "other: ") -> Column:
    """Where the main value is missing or "other", fall back to prefixed free text."""
    m = F.lower(strip(main))
    m = F.when(m.isin("none", "nan"), F.lit(None)).otherwise(m)
    free = F.lower(strip(other))
    return F.when((m.isNull() | (m == "other")) & free.isNotNull(), F.concat(F.lit(prefix), free)).otherwise(m)


def render(*parts: str | Column) -> Column:
    """Sentence from literal text and columns; NULL columns read "Unknown"."""
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("Unknown")) for p in parts]
    )


#: The sentence by which a record of each dataset is described; {a|b} takes b where a is missing.
RECORDS = {
    "crime": "Crime incident in Boston. Type: {offense_description}. Category: {offense_category}. District: {district}. Street: {street}. "
    "Date: {occurred_on_date}. Hour: {hour}. Day: {day_of_week}. Shooting: {shooting}.",
    "service_311": "Boston 311 service request. Topic: {case_topic}. Service: {service_name}. Status: {case_status}. Neighborhood: {neighborhood}. "
    "Department: {assigned_department}. Opened: {open_date}. Closed: {close_date}. On time: {on_time}.",
    "food_inspections": "Boston food inspection. Restaurant: {businessname}. Address: {address}. Result: {result}. Date: {resultdttm}. License: {licenseno}.",
    "cityscore": "Boston CityScore metric. Metric: {metric_name}. Day score: {day_score}. Week score: {week_score}. Month score: {month_score}. "
    "Target: {target}. Date: {date|timestamp}.",
    "berdo": "Boston building emissions (BERDO). Property: {property_name}. Address: {address}. Type: {property_type}. Energy use: {site_energy_use_kbtu} kBtu. "
    "Emissions: {total_ghg_emissions} metric tons CO2. Energy Star score: {energy_star_score}. Year: {reporting_year}.",
    "street_sweeping": "Boston street sweeping schedule. Street: {full_street_name}. From: {from_street}. To: {to_street}. District: {district}. "
    "Side: {side_of_street}. Season: {season_start} to {season_end}. Frequency: {week_type}. Tow zone: {tow_zone}.",
}


def record(dataset: str, columns: Sequence[str]) -> Column:
    """The sentence of a dataset's record; columns that a frame lacks and NULLs read "Unknown", a missing shooting "False"."""
    parts = []
    for text, names, _, _ in Formatter().parse(RECORDS[dataset]):
        parts.append(text)
        if names:
            there = [F.col(n).cast("string") for n in names.split("|") if n in columns]
            parts.append(F.coalesce(*there, F.lit("False" if names == "shooting" else "Unknown")))
    return render(*[p for p in parts if not isinstance(p, str) or p])


def keyword_hits(text, keywords) -> Column:
    """Those array elements that occur in the text, ignoring case."""
    low = F.lower(col(text))
    return F.filter(col(keywords), lambda k: F.contains(low, F.lower(k)))


def keyword_coverage(text, keywords) -> Column:
    total = F.size(col(keywords))
    return F.when(total > 0, F.size(keyword_hits(text, keywords)) / total).otherwise(F.lit(0.0))
