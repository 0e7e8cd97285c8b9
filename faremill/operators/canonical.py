"""Bring every fleet's raw columns under one schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.contract import DEFAULT_FLEET, DISTANCE, FLEETS, SOURCE_DISTANCE, SOURCE_NAMES
from faremill.functions.trip import fleet_name
from faremill.settings import Settings

# Which raw time columns each fleet publishes; other raw names are shared.
_TIME_PREFIX = {"yellow": "tpep", "green": "lpep"}


def canonical_columns(fleet: str) -> list[Column]:
    # Every column is named, so a raw column that happens to be called trip_type is never picked up.
    prefix = _TIME_PREFIX[fleet]
    airport_fee = F.col("airport_fee") if fleet == "yellow" else F.lit(None).cast("double")
    return [
        F.lit(fleet).alias("trip_type"),
        F.col(f"{prefix}_pickup_datetime").alias("pickup_datetime"),
        F.col(f"{prefix}_dropoff_datetime").alias("dropoff_datetime"),
        F.col("fare_amount"),
        F.col("trip_distance"),
        F.col("trip_distance").alias(DISTANCE),
        F.col("passenger_count"),
        F.col("vendorid").alias("vendor_id"),
        F.col("ratecodeid").alias("ratecode_id"),
        F.col("pulocationid").alias("pickup_location_id"),
        F.col("dolocationid").alias("dropoff_location_id"),
        F.col("payment_type"),
        F.col("extra"),
        F.col("mta_tax"),
        F.col("tip_amount"),
        F.col("tolls_amount"),
        F.col("improvement_surcharge"),
        F.col("congestion_surcharge"),
        airport_fee.alias("airport_fee"),
        F.col("total_amount"),
    ]


def canonical_trips(raw: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """Union of the enabled fleets; a fleet that is switched off is not even read."""
    enabled = [fleet for fleet in settings.fleets if fleet in raw]
    if not enabled:
        raise ValueError("no enabled fleet has raw trips")
    return reduce(DataFrame.unionByName, [raw[fleet].select(*canonical_columns(fleet)) for fleet in enabled])


def normalise_frame(df: DataFrame) -> DataFrame:
    """Accept a frame under raw or canonical names and return it under canonical ones.

    Raw green files have a ``trip_type`` that is a dispatch code. A frame that has only their time columns is green,
    except for rows that name a fleet there.
    """
    df = df.toDF(*[name.lower() for name in df.columns])
    present = set(df.columns)
    renames: dict[str, str] = {}
    for source, target in SOURCE_NAMES.items():
        if source in present and target not in present and target not in renames.values():
            renames[source] = target
    out = df
    if DISTANCE not in present and SOURCE_DISTANCE in present:
        out = out.withColumn(DISTANCE, F.col(SOURCE_DISTANCE))
    out = out.withColumnsRenamed(renames)
    times = {name for name in present if name.endswith("pickup_datetime")}
    fleet = fleet_name(F.col("trip_type").cast("string")) if "trip_type" in present else F.lit(DEFAULT_FLEET)
    if times == {"lpep_pickup_datetime"}:
        named = F.lower(F.trim(F.col("trip_type").cast("string"))) if "trip_type" in present else F.lit(None).cast("string")
        fleet = F.when(named.isin(*FLEETS), named).otherwise(F.lit("green"))
    return out.withColumn("trip_type", fleet)
