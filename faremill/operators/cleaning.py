"""Staging filter, candidate mask and per-row rule flags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.contract import DISTANCE, SOURCE_DISTANCE, TARGET
from faremill.functions import rules
from faremill.functions.trip import boundaries_crossed, flag, number, speed_mph
from faremill.operators.canonical import normalise_frame
from faremill.settings import Settings

_NUMBERS = (SOURCE_DISTANCE, "passenger_count", TARGET)


def with_trip_diagnostics(df: DataFrame) -> DataFrame:
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return df.withColumns(
        {
            "trip_duration_min": boundaries_crossed("minute", pickup, dropoff),
            "speed_mph": speed_mph(F.col("trip_distance"), pickup, dropoff),
        }
    )


def staging(canonical: DataFrame, settings: Settings) -> DataFrame:
    """Structurally valid trips: one narrow pass, no shuffle."""
    return with_trip_diagnostics(canonical.filter(rules.all_hold(rules.STRICT, settings)))


def _typed(df: DataFrame) -> rules.Read:
    """Columns of a normalised frame as the rules want them, though they may have come as text."""
    texts = {name for name, kind in df.dtypes if kind == "string"}

    def read(name: str) -> Column:
        column = F.col(DISTANCE if name == SOURCE_DISTANCE else name)
        if name in _NUMBERS:
            return number(column)
        return column.try_cast("timestamp_ntz") if name in texts and name.endswith("_datetime") else column

    return read


def candidate_mask(
    df: DataFrame, first: date | None = None, last: date | None = None, positive_fare: bool = True
) -> Column:
    """The lenient rules on a normalised frame whose columns may still hold text; true or false for every row."""
    read = _typed(df)
    profile = (*rules.CANDIDATE, rules.FARE_POSITIVE if positive_fare else rules.FARE_NOT_NEGATIVE)
    keep = rules.all_hold(profile, None, read)
    if first is not None and last is not None:
        keep = keep & rules.within_days(read("pickup_datetime"), first, last)
    return F.coalesce(keep, F.lit(False))


def candidate_trips(
    df: DataFrame, first: date | None = None, last: date | None = None, positive_fare: bool = True
) -> DataFrame:
    trips = normalise_frame(df)
    return trips.filter(candidate_mask(trips, first, last, positive_fare))


def with_rule_flags(df: DataFrame, settings: Settings) -> DataFrame:
    """1 where a diagnostic rule is known to be broken; an unknown outcome stays 0."""

    def broken(condition: Column) -> Column:
        return F.coalesce(flag(condition), F.lit(0))

    return df.withColumns(
        {
            "bad_pickup_null": broken(F.col("pickup_datetime").isNull()),
            "bad_dropoff_null": broken(F.col("dropoff_datetime").isNull()),
            "bad_date_range": broken(~rules.PICKUP_IN_WINDOW.holds(settings)),
            "bad_time_order": broken(~rules.TIME_ORDER.holds(settings)),
            "bad_trip_distance": broken(~rules.DISTANCE_POSITIVE.holds(settings)),
            "bad_passenger_count": broken(~rules.PASSENGERS_IN_RANGE.holds(settings)),
            "bad_fare_amount": broken(~rules.FARE_POSITIVE.holds(settings)),
            "bad_pickup_location": broken(F.col("pickup_location_id").isNull()),
            "bad_dropoff_location": broken(F.col("dropoff_location_id").isNull()),
        }
    )


def failing_trips(df: DataFrame, settings: Settings) -> DataFrame:
    """Rows where a diagnostic rule is false (a merely unknown rule set does not list the row)."""
    return with_rule_flags(df.filter(~rules.all_hold(rules.DIAGNOSTIC, settings)), settings)
