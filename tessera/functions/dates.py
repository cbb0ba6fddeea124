"""Date and time Column expressions. Weekdays count from Monday = 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import col

# Named quarters of the day.
DAY_PERIODS = ((0, 6, "Night"), (6, 12, "Morning"), (12, 18, "Afternoon"), (18, 24, "Evening"))


def parse_utc(c) -> Column:
    """Lenient timestamp parse; offsets are honoured and unparseable text becomes NULL."""
    return F.try_to_timestamp(col(c))


def date_parts(ts) -> dict[str, Column]:
    ts = col(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "dayofweek": F.weekday(ts),
    }


def day_name(ts) -> Column:
    return F.date_format(col(ts), "EEEE")


def is_weekend(ts) -> Column:
    return F.weekday(col(ts)).isin(5, 6)


def is_night(hour, start: int = 20, end: int = 6) -> Column:
    h = col(hour)
    return (h >= start) | (h < end)


def hour_bucket(hour, width: int = 4) -> Column:
    return F.floor(col(hour) / width).cast("int")


def day_period(hour) -> Column:
    h = col(hour)
    out = F.lit(None).cast("string")
    for lo, hi, name in DAY_PERIODS:
        out = F.when((h >= lo) & (h < hi), F.lit(name)).otherwise(out)
    return out


def clock_slot(c) -> Column:
    """Clock text such as "08:30" to a slot name; NULL or garbage gives "Unknown"."""
    h = F.split_part(col(c), F.lit(":"), F.lit(1)).try_cast("int")
    return (
        F.when(h.isNull(), F.lit("Unknown"))
        .when(h < 6, F.lit("Overnight"))
        .when(h < 12, F.lit("Morning"))
        .otherwise(F.lit("Afternoon"))
    )


def hours_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", col(start), col(end)) / 3600.0


def month_label(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def days_before(ts, days: int) -> Column:
    return col(ts) - F.expr(f"INTERVAL {int(days)} DAYS")
