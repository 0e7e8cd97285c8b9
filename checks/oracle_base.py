"""SQL for the trip layers, shared by the oracle queries. Derived from the table mapping alone."""

TRIPS = """
lines AS (
  SELECT *, l_linenumber::BIGINT AS nth,
         CASE WHEN l_partkey % 83 = 0 THEN -5.0::DOUBLE
              WHEN l_partkey % 79 = 0 THEN 450.0::DOUBLE
              ELSE 2.5::DOUBLE + l_quantity + l_extendedprice / 10000.0::DOUBLE END AS fare,
         l_shipdate + to_seconds(((l_orderkey * 7919 + l_linenumber::BIGINT * 104729) % 86400)::BIGINT) AS pickup
  FROM lineitem
),
canonical AS (
  SELECT CASE WHEN l_suppkey % 10 = 0 THEN 'green' ELSE 'yellow' END AS trip_type,
         pickup AS pickup_datetime,
         pickup + to_seconds(((l_partkey * 37 + nth * 11) % 3600 - 60)::BIGINT) AS dropoff_datetime,
         fare AS fare_amount,
         CASE WHEN l_partkey % 97 = 0 THEN 0.0::DOUBLE
              WHEN l_partkey % 89 = 0 THEN 200.0::DOUBLE
              ELSE l_quantity * 0.4::DOUBLE END AS trip_distance,
         CASE WHEN l_partkey % 97 = 0 THEN 0.0::DOUBLE
              WHEN l_partkey % 89 = 0 THEN 200.0::DOUBLE
              ELSE l_quantity * 0.4::DOUBLE END AS estimated_distance,
         CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE nth END AS passenger_count,
         1 + nth % 2 AS vendor_id,
         CASE WHEN l_partkey % 67 = 0 THEN 99 ELSE 1 + l_orderkey % 6 END AS ratecode_id,
         CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE 1 + l_partkey % 265 END AS pickup_location_id,
         1 + (l_partkey + l_orderkey % 5) % 265 AS dropoff_location_id,
         1 + l_orderkey % 4 AS payment_type,
         0.5::DOUBLE AS extra,
         0.5::DOUBLE AS mta_tax,
         l_tax * fare AS tip_amount,
         0.0::DOUBLE AS tolls_amount,
         0.3::DOUBLE AS improvement_surcharge,
         2.5::DOUBLE AS congestion_surcharge,
         CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 0.0::DOUBLE END AS airport_fee,
         fare + l_tax * fare + 3.8::DOUBLE AS total_amount
  FROM lines
),
staging AS (
  SELECT *,
         date_diff('minute', pickup_datetime, dropoff_datetime)::BIGINT AS trip_duration_min,
         CASE WHEN date_diff('second', pickup_datetime, dropoff_datetime) > 0
              THEN trip_distance / (date_diff('second', pickup_datetime, dropoff_datetime) / 3600.0::DOUBLE)
         END AS speed_mph
  FROM canonical
  WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND CAST(pickup_datetime AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    AND dropoff_datetime > pickup_datetime
    AND fare_amount BETWEEN 2.5 AND 300
    AND trip_distance BETWEEN 0.1::DOUBLE AND 150
    AND passenger_count BETWEEN 1 AND 6
    AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
    AND ratecode_id BETWEEN 1 AND 6
),
obt AS (
  SELECT trip_type, pickup_datetime,
         hour(pickup_datetime)::INTEGER AS pickup_hour,
         (isodow(pickup_datetime) - 1)::INTEGER AS pickup_dayofweek,
         month(pickup_datetime)::INTEGER AS pickup_month,
         (isodow(pickup_datetime) >= 6)::INTEGER AS is_weekend,
         (hour(pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19))::INTEGER AS is_rush_hour,
         (hour(pickup_datetime) >= 22 OR hour(pickup_datetime) < 6)::INTEGER AS is_night,
         passenger_count, estimated_distance,
         ln(1 + estimated_distance) AS log_estimated_distance,
         pickup_location_id, dropoff_location_id, vendor_id, ratecode_id,
         pickup_location_id::VARCHAR || '_' || dropoff_location_id::VARCHAR AS route_id,
         (pickup_location_id = dropoff_location_id)::INTEGER AS same_zone,
         fare_amount,
         year(pickup_datetime)::INTEGER AS pickup_year
  FROM staging
  WHERE trip_duration_min > 0
),
splits AS (
  SELECT *, CASE WHEN CAST(pickup_datetime AS DATE) <= DATE '1999-12-31' THEN 'train'
                 WHEN CAST(pickup_datetime AS DATE) <= DATE '2000-12-31' THEN 'validation'
                 ELSE 'test' END AS split
  FROM obt
),
zones AS (
  SELECT p_partkey + 1 AS location_id, p_brand AS borough, p_name AS zone, CASE p_type WHEN 'PROMO' THEN 'Airports' ELSE p_type END AS service_zone FROM part
)
"""


def over_trips(body: str, *extra: str) -> str:
    """A query body with the trip layers (and further CTEs) in front."""
    return "WITH " + ",".join([TRIPS, *extra]) + "\n" + body


def rounded(columns: str, digits: int = 9) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in columns.split())
