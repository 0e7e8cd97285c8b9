from datetime import date

import pytest
from pyspark.sql import functions as F

from faremill import contract
from faremill.operators import cleaning, features
from faremill.operators.canonical import canonical_trips, normalise_frame
from tests.frames import trips


def column(frame, name):
    return [row[name] for row in frame.collect()]


def test_leakage_is_refused():
    features.refuse_leakage(["estimated_distance"])
    with pytest.raises(ValueError, match="extra, tip_amount"):
        features.refuse_leakage(["tip_amount", "estimated_distance", "extra"])
    with pytest.raises(ValueError, match="ehail_fee"):
        features.refuse_leakage(["ehail_fee"])
    features.refuse_leakage(["ehail_fee"], contract.LEAKAGE)
    with pytest.raises(ValueError, match="airport_fee"):
        features.refuse_leakage(["Airport_fee"])


def test_feature_frame(spark):
    frame = features.prepare_features(trips(spark).limit(2).drop("fare_amount"))
    assert tuple(frame.columns) == contract.MODEL_FEATURES
    frame = frame.orderBy("pickup_hour")
    assert column(frame, "pickup_hour") == [8, 17]
    assert column(frame, "pickup_month") == [1, 1]
    assert column(frame, "pickup_dayofweek") == [4, 6]
    assert column(frame, "is_weekend") == [0, 1]
    assert column(frame, "is_rush_hour") == [1, 1]
    assert column(frame, "is_night") == [0, 0]
    assert column(frame, "route_id") == ["161_237", "237_142"]
    assert column(frame, "same_zone") == [0, 0]


def test_feature_frame_needs_all_columns_and_no_outcome(spark):
    with pytest.raises(ValueError, match="vendor_id"):
        features.prepare_features(trips(spark).drop("vendor_id", "fare_amount"))
    with pytest.raises(ValueError, match="total_amount"):
        features.select_raw_features(trips(spark).withColumn("total_amount", F.lit(1.0)))


def test_target_is_split_off_as_a_number(spark):
    frame = trips(spark).withColumn("fare_amount", F.when(F.col("vendor_id") == 1, "12.5").otherwise("free"))
    out = features.features_and_target(frame)
    assert out.columns == [*contract.RAW_FEATURES, "fare_amount"]
    assert sorted(column(out, "fare_amount"), key=str) == [12.5, 12.5, None]
    with pytest.raises(ValueError, match="not found"):
        features.features_and_target(frame.drop("fare_amount"))


def test_contract_payload():
    audit = contract.feature_audit()
    assert audit["feature_contract_version"] == contract.CONTRACT_VERSION
    assert set(contract.MODEL_FEATURES) == set(contract.NUMERIC_FEATURES) | set(contract.CATEGORICAL_FEATURES)
    assert "trip_duration_min" in audit["diagnostic_only_columns"]
    assert set(contract.FEATURE_ROLES) == set(contract.MODEL_FEATURES)


RAW = (
    "tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance double, passenger_count bigint, "
    "VendorID bigint, RatecodeID bigint, PULocationID bigint, DOLocationID bigint, fare_amount double"
)
FIRST = ("2025-01-03 08:15:00", "2025-01-03 08:35:00", 1.5, 2, 1, 1, 161, 237, 12.5)
SECOND = ("2025-01-04 09:00:00", "2025-01-04 08:55:00", 2.0, 1, 2, 1, 132, 132, 10.0)


def test_raw_names_become_canonical(spark):
    row = normalise_frame(spark.createDataFrame([FIRST], RAW)).first()
    assert row["pickup_location_id"] == 161 and row["dropoff_location_id"] == 237
    assert row["estimated_distance"] == 1.5
    assert row["trip_type"] == "yellow"


def test_candidates_exclude_reversed_times(spark):
    raw = spark.createDataFrame([(*FIRST, "yellow"), (*SECOND, "green")], RAW + ", trip_type string")
    kept = cleaning.candidate_trips(raw, date(2025, 1, 1), date(2025, 1, 31)).collect()
    assert [(row["trip_type"], row["estimated_distance"]) for row in kept] == [("yellow", 1.5)]


def test_candidate_mask_handles_text_and_nan(spark):
    raw = spark.createDataFrame([FIRST], RAW)
    trips_ = normalise_frame(raw)
    for change in (F.lit("far"), F.lit("NaN"), F.lit(None).cast("string"), F.lit("0")):
        changed = trips_.withColumn("estimated_distance", change)
        assert changed.filter(cleaning.candidate_mask(changed)).count() == 0
    free = trips_.withColumn("fare_amount", F.lit("0"))
    assert free.filter(cleaning.candidate_mask(free)).count() == 0
    assert free.filter(cleaning.candidate_mask(free, positive_fare=False)).count() == 1


def test_a_green_column_named_trip_type_is_not_the_fleet(spark, january):
    green = spark.createDataFrame([], contract.RAW_GREEN)
    values = {field.name: F.lit(None).cast(field.dataType) for field in contract.RAW_GREEN}
    row = spark.range(1).select(*[v.alias(n) for n, v in values.items()]).withColumn("trip_type", F.lit("1"))
    out = canonical_trips({"green": green.unionByName(row)}, january).first()
    assert out["trip_type"] == "green" and out["airport_fee"] is None


def test_no_enabled_fleet_is_an_error(spark, january):
    with pytest.raises(ValueError, match="no enabled fleet"):
        canonical_trips({}, january)
