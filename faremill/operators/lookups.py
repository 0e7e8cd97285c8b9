"""Zone and code labels. Whether a dimension is broadcast is left to the planner, which knows its size."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.contract import RATECODE_LABELS, VENDOR_LABELS

def _with_role(trips: DataFrame, dim: DataFrame, role: str, picked: Mapping[str, Column]) -> DataFrame:
    side = dim.select(
        F.col("location_id").alias(f"{role}_location_id"),
        *[expr.alias(f"{role}_{name}") for name, expr in picked.items()],
    )
    return trips.join(side, f"{role}_location_id", "left")


def with_zone_labels(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """``pickup_zone`` and ``dropoff_zone`` as "id — zone (borough)", or "Zone id" when unknown."""
    label = F.format_string("%d — %s (%s)", "location_id", "zone", "borough")
    out = trips
    for role in ("pickup", "dropoff"):
        out = _with_role(out, zones, role, {"zone": label})
        plain = F.concat(F.lit("Zone "), F.col(f"{role}_location_id").cast("string"))
        out = out.withColumn(f"{role}_zone", F.coalesce(F.col(f"{role}_zone"), plain))
    return out


def is_airport(service_zone: Column) -> Column:
    return service_zone.isin("Airports", "EWR").cast("int")


def with_zone_facts(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough and airport flag at both ends of the trip; NULL for an unknown zone."""
    facts = {"borough": F.col("borough"), "is_airport": is_airport(F.col("service_zone"))}
    return _with_role(_with_role(trips, zones, "pickup", facts), zones, "dropoff", facts)


def _labels(table: Mapping[int, str], code: Column, missing: str) -> Column:
    label = F.concat(F.lit(missing), code.cast("string"))
    for key, text in table.items():
        label = F.when(code == key, F.lit(text)).otherwise(label)
    return label


def with_code_labels(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "ratecode_label": _labels(RATECODE_LABELS, F.col("ratecode_id"), "Rate "),
            "vendor_label": _labels(VENDOR_LABELS, F.col("vendor_id"), "Vendor "),
        }
    )
