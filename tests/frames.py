"""Small frames the tests share."""

TRIP_COLUMNS = (
    "trip_type string, pickup_datetime string, passenger_count bigint, estimated_distance double, "
    "pickup_location_id bigint, dropoff_location_id bigint, vendor_id bigint, ratecode_id bigint, fare_amount double"
)
TRIPS = [
    ("yellow", "2025-01-03 08:15:00", 1, 1.5, 161, 237, 1, 1, 12.5),
    ("green", "2025-01-26 17:45:00", 2, 7.2, 237, 142, 2, 1, 31.8),
    ("yellow", "2025-01-27 06:10:00", 1, 3.1, 132, 170, 1, 1, 18.4),
]


def trips(spark, rows=TRIPS):
    frame = spark.createDataFrame(rows, TRIP_COLUMNS)
    return frame.withColumn("pickup_datetime", frame["pickup_datetime"].cast("timestamp_ntz"))


def thirty_days(spark):
    """One trip a day; the fare is eight times the distance."""
    rows = [
        (
            "yellow" if day % 2 else "green",
            f"2025-01-{day:02d} 08:00:00",
            1 + day % 3,
            1.0 + day / 10.0,
            100 + day % 5,
            200 + day % 7,
            1 + day % 2,
            1,
            8.0 + day * 0.8,
        )
        for day in range(1, 31)
    ]
    return trips(spark, rows)


def canonical(spark, **changes):
    """One valid canonical trip per row of changes."""
    base = {
        "trip_type": "yellow",
        "pickup_datetime": "2025-01-03 10:00:00",
        "dropoff_datetime": "2025-01-03 10:20:00",
        "fare_amount": 12.5,
        "trip_distance": 2.0,
        "estimated_distance": 2.0,
        "passenger_count": 1,
        "vendor_id": 1,
        "ratecode_id": 1,
        "pickup_location_id": 10,
        "dropoff_location_id": 20,
    }
    base.update(changes)
    kinds = {
        "fare_amount": "double",
        "trip_distance": "double",
        "estimated_distance": "double",
        "passenger_count": "bigint",
        "vendor_id": "bigint",
        "ratecode_id": "bigint",
        "pickup_location_id": "bigint",
        "dropoff_location_id": "bigint",
    }
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in base)
    frame = spark.createDataFrame([tuple(base.values())], schema)
    for name in ("pickup_datetime", "dropoff_datetime"):
        frame = frame.withColumn(name, frame[name].cast("timestamp_ntz"))
    return frame
