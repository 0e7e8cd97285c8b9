"""Checks on scoring requests, as a list of error codes per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.contract import FLEETS
from faremill.functions.rules import DISTANCE_RANGE, PASSENGER_RANGE

# ---- fixed values: what a request may hold ----
ZONE_BOUNDS = (1, 265)
PASSENGER_BOUNDS = (1, 8)
VENDOR_BOUNDS = (1, 2)
RATECODE_BOUNDS = (1, 6)
SAME_ZONE_MILES = 12.0
LONG_TRIP_MILES = 35.0
# ---- end of fixed values ----


def _outside(column: str, bounds: tuple[int, int]) -> Column:
    return ~F.coalesce(F.col(column).between(*bounds), F.lit(False))


def _codes(conditions: dict[str, Column]) -> Column:
    found = F.array(*[F.when(condition, F.lit(code)) for code, condition in conditions.items()])
    return F.filter(found, lambda code: code.isNotNull())


def check_requests(df: DataFrame) -> DataFrame:
    """Adds ``errors`` (why a request is refused) and ``warnings`` (accepted, but unusual)."""
    errors = {
        "trip_type": ~F.coalesce(F.col("trip_type").isin(*FLEETS), F.lit(False)),
        "pickup_datetime": F.col("pickup_datetime").isNull(),
        "pickup_location_id": _outside("pickup_location_id", ZONE_BOUNDS),
        "dropoff_location_id": _outside("dropoff_location_id", ZONE_BOUNDS),
        "passenger_count": _outside("passenger_count", PASSENGER_BOUNDS),
        "estimated_distance": ~F.coalesce(F.col("estimated_distance") >= 0, F.lit(False)),
        "vendor_id": _outside("vendor_id", VENDOR_BOUNDS),
        "ratecode_id": _outside("ratecode_id", RATECODE_BOUNDS),
    }
    distance = F.col("estimated_distance")
    warnings = {
        "same_zone_long": (F.col("pickup_location_id") == F.col("dropoff_location_id"))
        & (distance > SAME_ZONE_MILES),
        "long_trip": distance >= LONG_TRIP_MILES,
        "beyond_training": (F.col("passenger_count") > PASSENGER_RANGE[1])
        | ~distance.between(*DISTANCE_RANGE),
    }
    return df.withColumns({"errors": _codes(errors), "warnings": _codes(warnings)})


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0)


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)
