"""The cleaning rules, each a named predicate, grouped into profiles.

Predicates follow SQL logic: a NULL input makes the rule unknown, which filters the row out
and counts as not passing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from faremill.contract import FLEETS
from faremill.settings import Settings

# ---- fixed values: accepted ranges ----
FARE_RANGE = (2.50, 300.0)
DISTANCE_RANGE = (0.1, 150.0)
PASSENGER_RANGE = (1, 6)
RATECODE_RANGE = (1, 6)
# ---- end of fixed values ----


#: How a rule reads a column: plainly, or typed and renamed on the way.
Read = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    test: Callable[[Settings | None, Read], Column]

    def holds(self, settings: Settings | None, read: Read = F.col) -> Column:
        return self.test(settings, read)


def within_days(ts: Column, first: date, last: date) -> Column:
    """First to last day inclusive, as a half-open timestamp range that file statistics can prune."""
    after = last + timedelta(days=1)
    return (ts >= F.lit(first.isoformat()).cast("timestamp_ntz")) & (
        ts < F.lit(after.isoformat()).cast("timestamp_ntz")
    )


def _present(name: str, column: str) -> Rule:
    return Rule(name, lambda _, read: read(column).isNotNull())


def _between(name: str, column: str, bounds: tuple[float, float]) -> Rule:
    return Rule(name, lambda _, read: read(column).between(*bounds))


PICKUP_PRESENT = _present("pickup_present", "pickup_datetime")
DROPOFF_PRESENT = _present("dropoff_present", "dropoff_datetime")
PICKUP_IN_WINDOW = Rule(
    "pickup_in_window", lambda s, read: within_days(read("pickup_datetime"), s.data_start, s.data_end)
)
TIME_ORDER = Rule("dropoff_after_pickup", lambda _, read: read("dropoff_datetime") > read("pickup_datetime"))
FARE_IN_RANGE = _between("fare_in_range", "fare_amount", FARE_RANGE)
FARE_POSITIVE = Rule("fare_positive", lambda _, read: read("fare_amount") > 0)
FARE_NOT_NEGATIVE = Rule("fare_not_negative", lambda _, read: read("fare_amount") >= 0)
FLEET_KNOWN = Rule("fleet_known", lambda _, read: read("trip_type").isin(*FLEETS))
DISTANCE_IN_RANGE = _between("distance_in_range", "trip_distance", DISTANCE_RANGE)
DISTANCE_POSITIVE = Rule("distance_positive", lambda _, read: read("trip_distance") > 0)
PASSENGERS_IN_RANGE = _between("passengers_in_range", "passenger_count", PASSENGER_RANGE)
PICKUP_ZONE_PRESENT = _present("pickup_zone_present", "pickup_location_id")
DROPOFF_ZONE_PRESENT = _present("dropoff_zone_present", "dropoff_location_id")
RATECODE_IN_CATALOG = _between("ratecode_in_catalog", "ratecode_id", RATECODE_RANGE)

STRICT = (
    PICKUP_PRESENT,
    DROPOFF_PRESENT,
    PICKUP_IN_WINDOW,
    TIME_ORDER,
    FARE_IN_RANGE,
    DISTANCE_IN_RANGE,
    PASSENGERS_IN_RANGE,
    PICKUP_ZONE_PRESENT,
    DROPOFF_ZONE_PRESENT,
    RATECODE_IN_CATALOG,
)

DIAGNOSTIC = (
    PICKUP_PRESENT,
    DROPOFF_PRESENT,
    PICKUP_IN_WINDOW,
    TIME_ORDER,
    DISTANCE_POSITIVE,
    PASSENGERS_IN_RANGE,
    FARE_POSITIVE,
    PICKUP_ZONE_PRESENT,
    DROPOFF_ZONE_PRESENT,
)

# What may be learnt from or scored, besides a fare rule and, where one is given, the date window.
CANDIDATE = (
    FLEET_KNOWN,
    PICKUP_ZONE_PRESENT,
    DROPOFF_ZONE_PRESENT,
    PASSENGERS_IN_RANGE,
    DISTANCE_POSITIVE,
    TIME_ORDER,
)

# Shown next to each other in the cleaning report: the lenient and the strict distance rule.
REPORTED = (
    PICKUP_PRESENT,
    DROPOFF_PRESENT,
    PICKUP_IN_WINDOW,
    TIME_ORDER,
    DISTANCE_POSITIVE,
    DISTANCE_IN_RANGE,
    PASSENGERS_IN_RANGE,
    FARE_IN_RANGE,
    PICKUP_ZONE_PRESENT,
    DROPOFF_ZONE_PRESENT,
    RATECODE_IN_CATALOG,
)

RETENTION = (
    DISTANCE_IN_RANGE,
    PASSENGERS_IN_RANGE,
    FARE_IN_RANGE,
    PICKUP_ZONE_PRESENT,
    DROPOFF_ZONE_PRESENT,
)


def all_hold(rules: tuple[Rule, ...], settings: Settings | None, read: Read = F.col) -> Column:
    return reduce(lambda left, right: left & right, [rule.holds(settings, read) for rule in rules])


def passes(rules: tuple[Rule, ...], settings: Settings) -> Column:
    """``all_hold`` closed to true/false, for use as a column."""
    return F.coalesce(all_hold(rules, settings), F.lit(False))
