import pytest
from pyspark.sql import functions as F

from faremill.operators import cleaning, features, reports
from tests.frames import canonical

BOUNDARIES = [
    ({"fare_amount": 2.49}, False),
    ({"fare_amount": 2.50}, True),
    ({"fare_amount": 300.0}, True),
    ({"fare_amount": 300.01}, False),
    ({"fare_amount": None}, False),
    ({"fare_amount": float("nan")}, False),
    ({"trip_distance": 0.09}, False),
    ({"trip_distance": 0.1}, True),
    ({"trip_distance": 150.0}, True),
    ({"trip_distance": 150.01}, False),
    ({"trip_distance": None}, False),
    ({"passenger_count": 0}, False),
    ({"passenger_count": 1}, True),
    ({"passenger_count": 6}, True),
    ({"passenger_count": 7}, False),
    ({"passenger_count": None}, False),
    ({"ratecode_id": 0}, False),
    ({"ratecode_id": 6}, True),
    ({"ratecode_id": 7}, False),
    ({"ratecode_id": 99}, False),
    ({"ratecode_id": None}, False),
    ({"pickup_location_id": None}, False),
    ({"dropoff_location_id": None}, False),
    ({"pickup_datetime": None}, False),
    ({"dropoff_datetime": None}, False),
    ({"dropoff_datetime": "2025-01-03 10:00:00"}, False),
    ({"dropoff_datetime": "2025-01-03 09:59:00"}, False),
    ({"pickup_datetime": "2025-01-01 00:00:00"}, True),
    ({"pickup_datetime": "2024-12-31 23:59:59.999999"}, False),
    ({"pickup_datetime": "2025-01-31 23:59:59.999999", "dropoff_datetime": "2025-02-01 00:10:00"}, True),
    ({"pickup_datetime": "2025-02-01 00:00:00", "dropoff_datetime": "2025-02-01 00:10:00"}, False),
]


@pytest.mark.parametrize(("change", "kept"), BOUNDARIES, ids=lambda v: str(v))
def test_staging_boundaries(spark, january, change, kept):
    assert cleaning.staging(canonical(spark, **change), january).count() == int(kept)


@pytest.mark.parametrize(
    ("pickup", "dropoff", "minutes", "seconds_speed"),
    [
        ("10:00:05", "10:00:50", 0, 160.0),
        ("10:00:55", "10:01:05", 1, 720.0),
        ("10:00:00.900000", "10:00:01.100000", 0, 7200.0),
        ("10:00:00.100000", "10:00:00.900000", 0, None),
        ("10:01:00", "10:00:59", -1, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_durations_count_clock_boundaries(spark, pickup, dropoff, minutes, seconds_speed, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = canonical(
            spark, pickup_datetime=f"2025-01-03 {pickup}", dropoff_datetime=f"2025-01-03 {dropoff}"
        )
        row = cleaning.with_trip_diagnostics(frame).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["trip_duration_min"] == minutes
    assert row["speed_mph"] == (pytest.approx(seconds_speed) if seconds_speed else None)


def test_same_minute_trips_leave_the_modelling_table(spark, january):
    same = canonical(spark, pickup_datetime="2025-01-03 10:00:05", dropoff_datetime="2025-01-03 10:00:50")
    crossing = canonical(spark, pickup_datetime="2025-01-03 10:00:55", dropoff_datetime="2025-01-03 10:01:05")
    staged = cleaning.staging(same.unionByName(crossing), january)
    assert staged.count() == 2
    assert features.obt(staged).count() == 1


def test_unknown_is_not_flagged_as_broken(spark, january):
    row = cleaning.with_rule_flags(canonical(spark, passenger_count=None, fare_amount=-1.0), january).first()
    assert row["bad_passenger_count"] == 0 and row["bad_fare_amount"] == 1


def test_pass_table_and_diagnostics_agree(spark, january):
    frame = canonical(spark).unionByName(canonical(spark, fare_amount=-1.0)).unionByName(
        canonical(spark, passenger_count=None)
    )
    row = reports.rule_diagnostics(frame, january).first()
    assert (row["raw_total"], row["fare_positive"], row["passengers_in_range"], row["rows_passing_all"]) == (3, 2, 2, 1)
    table = {r["rule"]: (r["rows_passing"], r["pass_pct"]) for r in reports.rule_pass_table(frame, january).collect()}
    assert table["passengers_in_range"] == (2, 66.67)
    assert table["pickup_present"] == (3, 100.0)


def test_weights(spark):
    frame = spark.createDataFrame([("yellow",)] * 9000 + [("Green",)] * 1000, "trip_type string")
    weights = reports.fleet_weight_map(frame)
    assert weights["green"] == pytest.approx(5.0)
    assert weights["yellow"] == pytest.approx(10000 / 18000)
    mean = reports.with_fleet_weight(frame, weights).agg(F.avg("weight")).first()[0]
    assert mean == pytest.approx(1.0)
    assert reports.fleet_weight_map(frame.limit(0)) == {}
    assert reports.fleet_weight_map(spark.createDataFrame([("yellow",)] * 50, "trip_type string")) == {"yellow": 1.0}


def test_weight_lookup(spark):
    frame = spark.createDataFrame([("yellow",), ("GREEN",), ("Yellow",), (None,), ("unknown",)], "trip_type string")
    found = reports.with_fleet_weight(frame, {"yellow": 0.5, "green": 5.0})
    assert [row["weight"] for row in found.collect()] == [0.5, 5.0, 0.5, 1.0, 1.0]
    assert "weight" not in reports.with_fleet_weight(frame, None).columns
    assert "weight" not in reports.with_fleet_weight(frame, {}).columns
    assert "weight" not in reports.with_fleet_weight(frame.withColumnRenamed("trip_type", "t"), {"yellow": 1.0}).columns
