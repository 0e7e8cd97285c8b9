"""Pre-trip features, the leakage guard and the feature contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.contract import (
    DISTANCE,
    FEATURE_ROLES,
    MODEL_FEATURES,
    OBT_COLUMNS,
    RAW_FEATURES,
    STRICT_LEAKAGE,
    TARGET,
)
from faremill.functions.trip import calendar, number, route
from faremill.operators.canonical import normalise_frame


def refuse_leakage(columns: Iterable[str], forbidden: Iterable[str] = STRICT_LEAKAGE) -> None:
    found = sorted({name.lower() for name in columns} & set(forbidden))  # published files differ in case
    if found:
        raise ValueError("columns known only after the trip: " + ", ".join(found))


def _require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError("missing feature columns: " + ", ".join(missing))


def with_trip_features(df: DataFrame) -> DataFrame:
    pickup = F.col("pickup_datetime")
    if dict(df.dtypes)["pickup_datetime"] == "string":
        pickup = pickup.try_cast("timestamp_ntz")
    return df.withColumns(
        {
            **calendar(pickup),
            "log_estimated_distance": F.log1p(number(F.col(DISTANCE))),
            **route(F.col("pickup_location_id"), F.col("dropoff_location_id")),
        }
    )


def obt(staged: DataFrame, *keep: str) -> DataFrame:
    """The modelling table: safe columns, derivations, target, the pickup year to partition by, and columns to keep beside."""
    lasting = staged.filter(F.col("trip_duration_min") > 0)
    return with_trip_features(lasting).select(*OBT_COLUMNS, "pickup_year", *keep)


def prepare_features(df: DataFrame) -> DataFrame:
    refuse_leakage(df.columns)
    frame = normalise_frame(df)
    _require(frame, RAW_FEATURES)
    return with_trip_features(frame).select(*MODEL_FEATURES)


def select_raw_features(df: DataFrame, *keep: str) -> DataFrame:
    refuse_leakage(df.columns)
    frame = normalise_frame(df)
    _require(frame, RAW_FEATURES)
    return frame.select(*RAW_FEATURES, *keep)


def features_and_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Raw features with the target as a double (NULL where it is no number)."""
    if target not in df.columns:
        raise ValueError(f"target column {target} not found")
    return select_raw_features(df, target).withColumn(target, number(F.col(target)))


def with_feature_role(profile: DataFrame) -> DataFrame:
    """Place in the contract and role, for a frame with one row per feature in ``column``."""
    names = F.array(*[F.lit(name) for name in MODEL_FEATURES])
    roles = F.create_map(*[F.lit(part) for pair in FEATURE_ROLES.items() for part in pair])
    return profile.withColumn("position", F.array_position(names, F.col("column"))).withColumn(
        "role", F.try_element_at(roles, F.col("column"))
    )
