"""Scalar trip expressions: clock boundaries, calendar parts, flags, route."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: calendar flags (weekday 0 = Monday) ----
WEEKEND_DAYS = (5, 6)
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
# ---- end of fixed values ----

_MICROS = {"minute": 60_000_000, "second": 1_000_000}


def _clock_tick(ts: Column, unit: str) -> Column:
    # Counted from a zone-less epoch, so the session time zone cannot shift it.
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))
    return F.floor((micros - F.pmod(micros, F.lit(_MICROS[unit]))) / _MICROS[unit])


def boundaries_crossed(unit: str, start: Column, end: Column) -> Column:
    """How many clock minutes (or seconds) begin after ``start`` and up to ``end``."""
    return _clock_tick(end, unit) - _clock_tick(start, unit)


def exact_minutes(start: Column, end: Column) -> Column:
    span = F.timestamp_diff("MICROSECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return span / F.lit(60_000_000.0)


def speed_mph(distance: Column, start: Column, end: Column) -> Column:
    seconds = boundaries_crossed("second", start, end)
    return F.when(seconds > 0, distance / (seconds / F.lit(3600.0)))


def flag(condition: Column) -> Column:
    return condition.cast("int")


def in_list(value: Column, members: Iterable[int]) -> Column:
    return flag(value.isin(*members))


def calendar(pickup: Column) -> dict[str, Column]:
    hour, weekday = F.hour(pickup), F.weekday(pickup)
    return {
        "pickup_year": F.year(pickup),
        "pickup_hour": hour,
        "pickup_dayofweek": weekday,
        "pickup_month": F.month(pickup),
        "is_weekend": in_list(weekday, WEEKEND_DAYS),
        "is_rush_hour": in_list(hour, RUSH_HOURS),
        "is_night": in_list(hour, NIGHT_HOURS),
    }


def route(pickup_zone: Column, dropoff_zone: Column) -> dict[str, Column]:
    return {
        "route_id": F.concat(
            pickup_zone.cast("bigint").cast("string"), F.lit("_"), dropoff_zone.cast("bigint").cast("string")
        ),
        "same_zone": flag(pickup_zone == dropoff_zone),
    }


def fleet_name(value: Column) -> Column:
    """Trimmed, lower-cased fleet; missing or blank means yellow."""
    cleaned = F.lower(F.trim(value))
    return F.when(cleaned.isNull() | (cleaned == ""), F.lit("yellow")).otherwise(cleaned)


def month_of_file(file_name: Column) -> Column:
    return F.regexp_extract(file_name, r"_(\d{4}-\d{2})\.parquet", 1)


def number(value: Column) -> Column:
    """A double, or NULL for text that is no number and for NaN."""
    parsed = value.try_cast("double")
    return F.nanvl(parsed, F.lit(None).cast("double"))
