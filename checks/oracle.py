"""Independent SQL for the registered queries, on the given tables only."""

from __future__ import annotations

from checks.oracle_base import over_trips, rounded

SQL: dict[str, str] = {}

CANONICAL_TEXT = "trip_type pickup_datetime dropoff_datetime"
CANONICAL_NUMBERS = (
    "fare_amount trip_distance estimated_distance extra mta_tax tip_amount tolls_amount "
    "improvement_surcharge congestion_surcharge airport_fee total_amount"
)
CANONICAL_IDS = "passenger_count vendor_id ratecode_id pickup_location_id dropoff_location_id payment_type"


def _list(names: str) -> str:
    return ", ".join(names.split())


CANONICAL = f"{_list(CANONICAL_TEXT)}, {_list(CANONICAL_IDS)}, {rounded(CANONICAL_NUMBERS)}"
OBT_PLAIN = (
    "trip_type pickup_datetime pickup_hour pickup_dayofweek pickup_month is_weekend is_rush_hour is_night "
    "passenger_count pickup_location_id dropoff_location_id vendor_id ratecode_id route_id same_zone"
)
OBT_18 = f"{_list(OBT_PLAIN)}, {rounded('estimated_distance log_estimated_distance fare_amount')}"
OBT = f"{OBT_18}, pickup_year"

SQL["split_overview"] = over_trips(
    """SELECT split, trip_type, count(*) AS rows, round(avg(fare_amount), 9) AS mean_fare,
       round(median(fare_amount), 9) AS median_fare
FROM splits GROUP BY split, trip_type"""
)
SQL["canonical_union"] = over_trips(f"SELECT {CANONICAL} FROM canonical")
SQL["enabled_fleet_only"] = over_trips(f"SELECT {CANONICAL} FROM canonical WHERE trip_type = 'green'")
SQL["normalised_raw"] = over_trips(f"SELECT {CANONICAL} FROM canonical WHERE trip_type = 'yellow'")
SQL["normalised_green"] = SQL["enabled_fleet_only"]
SQL["fleet_names"] = over_trips(
    """SELECT given, CASE WHEN given IS NULL OR trim(given) = '' THEN 'yellow' ELSE lower(trim(given)) END AS trip_type,
       count(*) AS rows
FROM (SELECT CASE WHEN passenger_count IS NULL THEN NULL WHEN vendor_id = 1 THEN ' ' || upper(trip_type) || ' '
             WHEN payment_type = 1 THEN '  ' ELSE trip_type END AS given FROM canonical)
GROUP BY 1, 2"""
)
SQL["staging_trips"] = over_trips(
    f"SELECT {CANONICAL}, trip_duration_min, round(speed_mph, 9) AS speed_mph FROM staging"
)
CANDIDATE = """dropoff_datetime > pickup_datetime AND trip_distance > 0 AND passenger_count BETWEEN 1 AND 6
  AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL AND fare_amount > 0
  AND pickup_datetime >= TIMESTAMP '1995-01-01' AND pickup_datetime < TIMESTAMP '2002-01-01'"""
SQL["candidate_trips"] = over_trips(f"SELECT {CANONICAL} FROM canonical WHERE {CANDIDATE}")
SQL["candidate_from_text"] = over_trips(
    f"""SELECT trip_type, kept, count(*) AS rows FROM (
  SELECT trip_type, coalesce(ratecode_id <> 99 AND {CANDIDATE.replace('fare_amount > 0', 'fare_amount >= 0')}, false) AS kept
  FROM canonical) GROUP BY trip_type, kept"""
)
SQL["trip_durations"] = over_trips(
    """SELECT date_diff('minute', pickup_datetime, dropoff_datetime)::BIGINT AS trip_duration_min, count(*) AS rows,
       round(min(exact), 9) AS shortest, round(max(exact), 9) AS longest,
       round(max(CASE WHEN seconds > 0 THEN trip_distance / (seconds / 3600.0::DOUBLE) END), 9) AS max_speed,
       count(CASE WHEN seconds > 0 THEN trip_distance / (seconds / 3600.0::DOUBLE) END) AS with_speed
FROM (SELECT *, epoch(dropoff_datetime - pickup_datetime) / 60 AS exact,
             date_diff('second', pickup_datetime, dropoff_datetime) AS seconds FROM canonical)
GROUP BY 1"""
)
SQL["obt_trips"] = over_trips(f"SELECT {OBT} FROM obt")
SQL["obt_reference_columns"] = over_trips(f"SELECT {OBT_18} FROM obt")
SQL["feature_frame"] = over_trips(
    """SELECT trip_type, year(pickup_datetime)::INTEGER AS pickup_year, hour(pickup_datetime)::INTEGER AS pickup_hour,
       (isodow(pickup_datetime) - 1)::INTEGER AS pickup_dayofweek, month(pickup_datetime)::INTEGER AS pickup_month,
       (isodow(pickup_datetime) >= 6)::INTEGER AS is_weekend,
       (hour(pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19))::INTEGER AS is_rush_hour,
       (hour(pickup_datetime) NOT BETWEEN 6 AND 21)::INTEGER AS is_night,
       passenger_count, round(estimated_distance, 9) AS estimated_distance,
       round(ln(1 + estimated_distance), 9) AS log_estimated_distance,
       pickup_location_id, dropoff_location_id, vendor_id, ratecode_id,
       concat(pickup_location_id, '_', dropoff_location_id) AS route_id,
       (pickup_location_id = dropoff_location_id)::INTEGER AS same_zone
FROM staging"""
)
RAW_FEATURES = (
    "pickup_datetime, passenger_count, round(estimated_distance, 9) AS estimated_distance, pickup_location_id, "
    "dropoff_location_id, vendor_id, ratecode_id, trip_type"
)
SQL["features_with_target"] = over_trips(f"SELECT {RAW_FEATURES}, round(fare_amount, 9) AS fare_amount FROM obt")
SQL["time_splits"] = over_trips(f"SELECT {OBT}, split FROM splits")
SQL["validation_split"] = over_trips(f"SELECT {OBT} FROM splits WHERE split = 'validation'")
SQL["split_spans"] = over_trips(
    """SELECT split, count(*) AS rows, min(pickup_datetime) AS min_pickup, max(pickup_datetime) AS max_pickup
FROM splits GROUP BY split"""
)
SQL["split_overlap"] = over_trips(
    """SELECT count(*) FILTER (WHERE held > 1) AS in_several, count(*) FILTER (WHERE held = 0) AS in_none, count(*) AS rows
FROM (SELECT (day BETWEEN DATE '1995-01-01' AND DATE '1999-12-31')::INTEGER
           + (day BETWEEN DATE '2000-01-01' AND DATE '2000-12-31')::INTEGER
           + (day BETWEEN DATE '2001-01-01' AND DATE '2001-12-31')::INTEGER AS held
      FROM (SELECT CAST(pickup_datetime AS DATE) AS day FROM obt))"""
)
SQL["layer_counts"] = over_trips(
    """SELECT 'raw_' || trip_type AS layer, count(*) AS rows FROM canonical GROUP BY trip_type
UNION ALL SELECT 'staging', count(*) FROM staging
UNION ALL SELECT 'obt', count(*) FROM obt
UNION ALL SELECT split, count(*) FROM splits GROUP BY split"""
)

# ---- rule reports ----

IN_WINDOW = "CAST(pickup_datetime AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"
DIAGNOSTIC = {
    "pickup_present": "pickup_datetime IS NOT NULL",
    "dropoff_present": "dropoff_datetime IS NOT NULL",
    "pickup_in_window": IN_WINDOW,
    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
    "distance_positive": "trip_distance > 0",
    "passengers_in_range": "passenger_count BETWEEN 1 AND 6",
    "fare_positive": "fare_amount > 0",
    "pickup_zone_present": "pickup_location_id IS NOT NULL",
    "dropoff_zone_present": "dropoff_location_id IS NOT NULL",
}
REPORTED = {
    **{name: test for name, test in DIAGNOSTIC.items() if name != "fare_positive"},
    "distance_in_range": "trip_distance BETWEEN 0.1::DOUBLE AND 150",
    "fare_in_range": "fare_amount BETWEEN 2.5 AND 300",
    "ratecode_in_catalog": "ratecode_id BETWEEN 1 AND 6",
}
ALL_DIAGNOSTIC = " AND ".join(f"({test})" for test in DIAGNOSTIC.values())
SQL["rule_diagnostics"] = over_trips(
    "SELECT count(*) AS raw_total, "
    + ", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in DIAGNOSTIC.items())
    + f", count(*) FILTER (WHERE {ALL_DIAGNOSTIC}) AS rows_passing_all FROM canonical"
)
SQL["rule_pass_table"] = over_trips(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS rows_passing, "
        f"round(count(*) FILTER (WHERE {test}) * 100.0::DOUBLE / count(*), 2) AS pass_pct FROM canonical"
        for name, test in REPORTED.items()
    )
)
CHECKS = {
    "rows": "true",
    "fare_not_positive": "fare_amount <= 0",
    "fare_over_maximum": "fare_amount > 300",
    "fare_below_minimum": "fare_amount < 2.5",
    "distance_not_positive": "estimated_distance <= 0",
    "distance_over_maximum": "estimated_distance > 150",
    "passengers_out_of_range": "passenger_count < 1 OR passenger_count > 6",
    "pickup_zone_missing": "pickup_location_id IS NULL",
    "dropoff_zone_missing": "dropoff_location_id IS NULL",
    "yellow_rows": "trip_type = 'yellow'",
    "green_rows": "trip_type = 'green'",
}
SQL["quality_checks"] = over_trips(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {test}) AS value FROM canonical"
        for name, test in CHECKS.items()
    )
)
BROKEN = {
    "bad_pickup_null": "pickup_datetime IS NULL",
    "bad_dropoff_null": "dropoff_datetime IS NULL",
    "bad_date_range": f"NOT ({IN_WINDOW})",
    "bad_time_order": "dropoff_datetime <= pickup_datetime",
    "bad_trip_distance": "trip_distance <= 0",
    "bad_passenger_count": "passenger_count NOT BETWEEN 1 AND 6",
    "bad_fare_amount": "fare_amount <= 0",
    "bad_pickup_location": "pickup_location_id IS NULL",
    "bad_dropoff_location": "dropoff_location_id IS NULL",
}
BAD_FLAGS = {name: f"CASE WHEN {test} THEN 1 ELSE 0 END AS {name}" for name, test in BROKEN.items()}
SQL["failing_trips"] = over_trips(
    f"""SELECT trip_type, vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
       pickup_location_id, dropoff_location_id, {rounded("trip_distance fare_amount")}, {", ".join(BAD_FLAGS.values())}
FROM canonical WHERE NOT ({ALL_DIAGNOSTIC})"""
)


def trip_key(dropoff: bool = False) -> str:
    def text(name: str) -> str:
        return f"coalesce({name}::VARCHAR, '-')"

    def clock(name: str) -> str:
        return f"{name}::VARCHAR"

    parts = ["trip_type", clock("pickup_datetime")]
    parts += [clock("dropoff_datetime")] if dropoff else []
    parts += [text(name) for name in ("pickup_location_id", "dropoff_location_id", "passenger_count")]
    parts += [text("vendor_id"), text("ratecode_id")]
    parts += ["floor(estimated_distance * 100)::BIGINT::VARCHAR", "floor(fare_amount * 1000000)::BIGINT::VARCHAR"]
    return " || '|' || ".join(parts)


SQL["failing_trip_preview"] = over_trips(
    f"""SELECT {trip_key(True)} AS trip_key, {BAD_FLAGS["bad_time_order"]}, {BAD_FLAGS["bad_trip_distance"]},
       {BAD_FLAGS["bad_passenger_count"]}, {BAD_FLAGS["bad_fare_amount"]}
FROM canonical WHERE NOT ({ALL_DIAGNOSTIC}) ORDER BY pickup_datetime, trip_key LIMIT 10"""
)
RETAINED = " AND ".join(
    f"({REPORTED[name]})"
    for name in (
        "distance_in_range",
        "passengers_in_range",
        "fare_in_range",
        "pickup_zone_present",
        "dropoff_zone_present",
    )
)
SQL["retention_by_fleet"] = over_trips(
    f"""SELECT trip_type, count(*) AS total, count(*) FILTER (WHERE {RETAINED}) AS passing,
       round(count(*) FILTER (WHERE {RETAINED}) * 100.0::DOUBLE / count(*), 1) AS retention_pct
FROM canonical GROUP BY trip_type"""
)
MEANS = ", ".join(
    f"round(avg({name}), 9) AS {name}_mean" for name in ("fare_amount", "estimated_distance", "passenger_count")
)
SQL["raw_against_candidate"] = over_trips(
    f"""SELECT 'raw' AS dataset, count(*) AS rows, {MEANS} FROM canonical
UNION ALL SELECT 'candidate', count(*), {MEANS} FROM canonical WHERE {CANDIDATE}"""
)

# ---- column reports ----

KINDS = {
    **{name: "string" for name in ("trip_type",)},
    **{name: "timestamp_ntz" for name in ("pickup_datetime", "dropoff_datetime")},
    **{name: "bigint" for name in CANONICAL_IDS.split()},
    **{name: "double" for name in CANONICAL_NUMBERS.split()},
}
SQL["column_profile"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{kind}' AS dtype, count(*) AS rows, count(*) - count({name}) AS nulls,
       count(DISTINCT {name}) + (CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END) AS n_unique,
       round((count(*) - count({name})) * 100.0::DOUBLE / count(*), 2) AS null_pct FROM canonical"""
        for name, kind in KINDS.items()
    )
)

SQL["merged_profile"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{kind}' AS dtype, count(*) AS rows, count(*) - count({name}) AS nulls,
       count(DISTINCT {name}) + (CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END) AS n_unique, true AS close,
       round((count(*) - count({name})) * 100.0::DOUBLE / count(*), 2) AS null_pct FROM canonical"""
        for name, kind in KINDS.items()
    )
)


def described(columns: dict[str, str], points: list[float], source: str) -> str:
    def name(point: float) -> str:
        return "p" + f"{point * 100:g}".replace(".", "_")

    return "\nUNION ALL ".join(
        f"""SELECT '{column}' AS "column", count({expr}) AS count, round(avg({expr}), 9) AS mean,
       round(stddev_samp({expr}), 9) AS std, round(min({expr})::DOUBLE, 9) AS min, round(max({expr})::DOUBLE, 9) AS max, """
        + ", ".join(
            f"round(quantile_cont(({expr})::DOUBLE, {point}), 9) AS {name(point)}" for point in points
        )
        + f" FROM {source}"
        for column, expr in columns.items()
    )


EDA = {
    "fare_amount": "fare_amount",
    "estimated_distance": "estimated_distance",
    "passenger_count": "passenger_count",
    "pickup_hour": "hour(pickup_datetime)",
    "pickup_dayofweek": "isodow(pickup_datetime) - 1",
    "pickup_month": "month(pickup_datetime)",
}
NUMERIC = (
    "pickup_year pickup_hour pickup_dayofweek pickup_month is_weekend is_rush_hour is_night passenger_count "
    "estimated_distance log_estimated_distance same_zone"
).split()
FIVE_POINTS = [0.01, 0.05, 0.5, 0.95, 0.99]
SQL["describe_numeric"] = over_trips(described(EDA, FIVE_POINTS, "canonical"))
SQL["describe_outliers"] = over_trips(
    described({n: n for n in ("fare_amount", "estimated_distance")}, [0.95, 0.99, 0.995, 0.999], "canonical")
)
SQL["describe_features"] = over_trips(described({n: n for n in [*NUMERIC, "fare_amount"]}, FIVE_POINTS, "obt"))
SQL["post_trip_charges"] = over_trips(
    described({"total_minus_fare": "total_amount - fare_amount"}, [0.25, 0.5, 0.75], "canonical")
)
SQL["fleet_statistics"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT trip_type, '{name}' AS "column", round(avg({name}), 3) AS mean, round(median({name})::DOUBLE, 3) AS median,
       round(stddev_samp({name}), 3) AS std FROM obt GROUP BY trip_type"""
        for name in ("fare_amount", "estimated_distance", "passenger_count")
    )
)
SQL["year_fleet_coverage"] = over_trips(
    """SELECT year(pickup_datetime)::INTEGER AS pickup_year, count(*) FILTER (WHERE trip_type = 'yellow') AS yellow,
       count(*) FILTER (WHERE trip_type = 'green') AS green
FROM canonical GROUP BY 1"""
)
SQL["target_comparison"] = over_trips(
    """SELECT 'fare_amount' AS "column", round(avg(fare_amount), 9) AS mean, 1.0::DOUBLE AS correlation_with_fare,
       round(median(fare_amount), 9) AS median FROM canonical
UNION ALL SELECT 'total_amount', round(avg(total_amount), 9), round(corr(fare_amount, total_amount), 9),
       round(median(total_amount), 9) FROM canonical"""
)
SQL["correlation_matrix"] = over_trips(
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS \"column\", '{b}' AS other, "
        f"{'1.0::DOUBLE' if a == b else f'round(corr({EDA[a]}, {EDA[b]}), 9)'} AS correlation "
        "FROM canonical GROUP BY ()"
        for a in EDA
        for b in EDA
    )
)


def histogram(columns: dict[str, str], bins: int, source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    same = f" AND v.{by} = e.{by}" if by else ""
    return ", ".join(
        [
            "vals AS ("
            + " UNION ALL ".join(
                f"SELECT {key}'{name}' AS col, ({expr})::DOUBLE AS v FROM {source} WHERE ({expr}) IS NOT NULL"
                for name, expr in columns.items()
            )
            + ")",
            f"edges AS (SELECT {key}col, min(v) AS low, max(v) AS high, count(*) AS total FROM vals GROUP BY {key}col)",
            f"""hits AS (SELECT {"e." + by + ", " if by else ""}e.col,
  least(floor((v.v - e.low) / (e.high - e.low) * {bins}), {bins - 1})::INTEGER AS bin, count(*) AS n
  FROM vals v JOIN edges e ON v.col = e.col{same} GROUP BY ALL)""",
            f"every AS (SELECT e.*, b.bin FROM edges e, (SELECT unnest(range({bins}))::INTEGER AS bin) b)",
        ]
    )


def histogram_query(columns: dict[str, str], bins: int, source: str, by: str = "") -> str:
    key = f"e.{by}, " if by else ""
    same = f" AND e.{by} = h.{by}" if by else ""
    return over_trips(
        f"""SELECT {key}e.col AS "column", e.bin,
       round(e.low + (e.high - e.low) / {bins} * e.bin, 9) AS bin_low,
       round(e.low + (e.high - e.low) / {bins} * (e.bin + 1), 9) AS bin_high,
       coalesce(h.n, 0) AS rows,
       round(coalesce(h.n, 0) / (e.total * ((e.high - e.low) / {bins})), 9) AS density
FROM every e LEFT JOIN hits h ON e.col = h.col AND e.bin = h.bin{same}""",
        histogram(columns, bins, source, by),
    )


SQL["fare_histogram"] = histogram_query({n: n for n in ("fare_amount", "estimated_distance")}, 50, "canonical")
SQL["cleaning_histogram"] = histogram_query(
    {
        "trip_distance": "trip_distance",
        "fare_amount": "fare_amount",
        "trip_minutes": "epoch(dropoff_datetime - pickup_datetime) / 60",
    },
    60,
    "canonical",
)
SQL["fleet_histogram"] = histogram_query(
    {n: n for n in ("estimated_distance", "fare_amount", "passenger_count")}, 40, "obt", "trip_type"
)
SQL["trips_by_hour"] = over_trips(
    "SELECT hour(pickup_datetime)::INTEGER AS pickup_hour, trip_type, count(*) AS rows FROM canonical GROUP BY 1, 2"
)
SQL["trips_by_weekday"] = over_trips(
    """SELECT (isodow(pickup_datetime) - 1)::INTEGER AS pickup_dayofweek, trip_type, count(*) AS rows
FROM canonical GROUP BY 1, 2"""
)
SQL["trips_by_vendor"] = over_trips("SELECT vendor_id, count(*) AS rows FROM obt GROUP BY vendor_id")
SQL["trips_by_ratecode"] = over_trips("SELECT ratecode_id, count(*) AS rows FROM obt GROUP BY ratecode_id")


def box(column: str, by: str, source: str) -> str:
    return over_trips(
        f"""SELECT t.{by}, count(*) AS rows, round(any_value(q1), 9) AS q1, round(any_value(m), 9) AS median,
       round(any_value(q3), 9) AS q3,
       round(min(v) FILTER (WHERE v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5), 9) AS whisker_low,
       round(max(v) FILTER (WHERE v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5), 9) AS whisker_high,
       count(*) FILTER (WHERE NOT (v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5)) AS outliers
FROM (SELECT {by}, {column} AS v FROM {source}) t
JOIN (SELECT {by}, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS m,
             quantile_cont({column}, 0.75) AS q3 FROM {source} GROUP BY {by}) b ON t.{by} = b.{by}
GROUP BY t.{by}"""
    )


SQL["fare_box_by_passengers"] = box(
    "fare_amount", "passenger_count", f"(SELECT * FROM canonical WHERE {CANDIDATE})"
)
SQL["distance_box_by_hour"] = box("estimated_distance", "pickup_hour", "obt")
SQL["distance_box_by_weekday"] = box("estimated_distance", "pickup_dayofweek", "obt")

ROLES = {
    "TARGET": "fare_amount",
    "LEAKAGE": "payment_type extra mta_tax tip_amount tolls_amount improvement_surcharge congestion_surcharge "
    "airport_fee total_amount trip_duration_min speed_mph dropoff_datetime",
    "FEATURE": "trip_type passenger_count estimated_distance vendor_id ratecode_id pickup_location_id "
    "dropoff_location_id",
    "CONTROL": "pickup_datetime",
    "RAW": "trip_distance",
}
SQL["column_roles"] = over_trips(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{role}' AS role, count({name}) AS \"values\" FROM staging"
        for role, names in ROLES.items()
        for name in names.split()
    )
)
CONTRACT = [
    ("trip_type", "categorical fleet"),
    ("pickup_year", "numeric temporal"),
    ("pickup_hour", "numeric temporal"),
    ("pickup_dayofweek", "numeric temporal"),
    ("pickup_month", "numeric temporal"),
    ("is_weekend", "numeric temporal"),
    ("is_rush_hour", "numeric temporal"),
    ("is_night", "numeric temporal"),
    ("passenger_count", "numeric trip"),
    ("estimated_distance", "numeric trip"),
    ("log_estimated_distance", "numeric trip"),
    ("pickup_location_id", "categorical location"),
    ("dropoff_location_id", "categorical location"),
    ("vendor_id", "categorical operator"),
    ("ratecode_id", "categorical operator"),
    ("route_id", "categorical route"),
    ("same_zone", "categorical route"),
]
STAGED_FEATURE = {
    "pickup_year": "year(pickup_datetime)",
    "pickup_hour": "hour(pickup_datetime)",
    "pickup_dayofweek": "isodow(pickup_datetime)",
    "pickup_month": "month(pickup_datetime)",
    "is_weekend": "isodow(pickup_datetime) >= 6",
    "is_rush_hour": "hour(pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19)",
    "is_night": "hour(pickup_datetime) NOT BETWEEN 6 AND 21",
    "log_estimated_distance": "estimated_distance",
    "route_id": "concat(pickup_location_id, '_', dropoff_location_id)",
    "same_zone": "pickup_location_id = dropoff_location_id",
}
SQL["feature_contract"] = over_trips(
    "\nUNION ALL ".join(
        f"SELECT {place}::BIGINT AS position, '{name}' AS \"column\", '{role}' AS role, "
        f"count(DISTINCT {STAGED_FEATURE.get(name, name)}) AS n_unique FROM staging"
        for place, (name, role) in enumerate(CONTRACT, start=1)
    )
)
WEIGHTS = """fleet AS (
  SELECT trip_type, count(*) AS rows FROM splits WHERE split = 'train' GROUP BY trip_type
), weights AS (
  SELECT trip_type, rows,
         (SELECT sum(rows) FROM fleet)::DOUBLE / ((SELECT count(*) FROM fleet) * rows) AS weight FROM fleet
)"""
SQL["fleet_weights"] = over_trips(
    "SELECT trip_type, rows, round(weight, 9) AS weight FROM weights", WEIGHTS
)
SQL["row_weights"] = over_trips(
    """SELECT split, s.trip_type, round(sum(weight), 6) AS weight, count(*) AS rows
FROM splits s JOIN weights w ON s.trip_type = w.trip_type GROUP BY split, s.trip_type""",
    WEIGHTS,
)

# ---- windows, samples, previews ----

SQL["month_windows"] = over_trips(
    """SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS window_start,
       last_day(pickup_datetime) AS window_end, count(*) AS rows
FROM splits WHERE split = 'validation' GROUP BY 1, 2"""
)
SQL["week_windows"] = over_trips(
    """SELECT w AS window_start, least(w + 6, DATE '2000-12-31') AS window_end, count(s.pickup_datetime) AS rows
FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 7 DAY)) AS DATE) AS w)
LEFT JOIN (SELECT pickup_datetime FROM splits WHERE split = 'validation') s
  ON CAST(s.pickup_datetime AS DATE) BETWEEN w AND w + 6
GROUP BY w"""
)
SQL["window_trips"] = over_trips(
    f"SELECT {OBT} FROM obt WHERE year(pickup_datetime) = 2001 AND month(pickup_datetime) = 1"
)
SQL["day_slice"] = over_trips(f"SELECT {OBT} FROM obt WHERE day(pickup_datetime) BETWEEN 8 AND 14")
SQL["balanced_raw_sample"] = over_trips(
    f"""SELECT {CANONICAL} FROM canonical
QUALIFY row_number() OVER (PARTITION BY trip_type
  ORDER BY md5({trip_key(True)} || '#' || CASE trip_type WHEN 'yellow' THEN '43' ELSE '44' END)) <= 2501"""
)
SQL["random_obt_sample"] = over_trips(
    f"SELECT {OBT} FROM obt QUALIFY row_number() OVER (ORDER BY md5({trip_key()} || '#42')) <= 2000"
)
SQL["stratified_train_sample"] = over_trips(
    f"""SELECT {OBT} FROM splits WHERE split = 'train'
QUALIFY row_number() OVER (PARTITION BY pickup_year, trip_type ORDER BY md5({trip_key()} || '#42')) <= 1000"""
)
SQL["newest_trips"] = over_trips(
    f"SELECT {OBT}, {trip_key()} AS trip_key FROM obt ORDER BY obt.pickup_datetime DESC, trip_key LIMIT 10"
)

# ---- lookups and request checks ----

LABEL = "coalesce({0}.location_id::VARCHAR || ' — ' || {0}.zone || ' (' || {0}.borough || ')', 'Zone ' || o.{1}_location_id)"
SQL["zone_labels"] = over_trips(
    f"""SELECT {LABEL.format("p", "pickup")} AS pickup_zone, {LABEL.format("d", "dropoff")} AS dropoff_zone,
       count(*) AS rows
FROM obt o LEFT JOIN zones p ON o.pickup_location_id = p.location_id
LEFT JOIN zones d ON o.dropoff_location_id = d.location_id GROUP BY 1, 2"""
)
SQL["zone_facts"] = over_trips(
    """SELECT p.borough AS pickup_borough, d.borough AS dropoff_borough,
       (p.service_zone IN ('Airports', 'EWR'))::INTEGER AS pickup_is_airport,
       (d.service_zone IN ('Airports', 'EWR'))::INTEGER AS dropoff_is_airport,
       count(*) AS rows, round(sum(fare_amount), 6) AS fares
FROM obt o LEFT JOIN zones p ON o.pickup_location_id = p.location_id
LEFT JOIN zones d ON o.dropoff_location_id = d.location_id GROUP BY 1, 2, 3, 4"""
)
SQL["code_labels"] = over_trips(
    """SELECT CASE ratecode_id WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK flat rate (~$52)'
            WHEN 3 THEN 'Newark (metered)' WHEN 4 THEN 'Nassau / Westchester' WHEN 5 THEN 'Negotiated fare'
            WHEN 6 THEN 'Group ride' ELSE 'Rate ' || ratecode_id END AS ratecode_label,
       CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies' ELSE 'Curb Mobility (VeriFone)' END AS vendor_label,
       count(*) AS rows
FROM canonical GROUP BY 1, 2"""
)
SQL["request_checks"] = over_trips(
    """SELECT concat_ws(',',
         CASE WHEN pickup_location_id IS NULL OR pickup_location_id NOT BETWEEN 1 AND 265 THEN 'pickup_location_id' END,
         CASE WHEN dropoff_location_id NOT BETWEEN 1 AND 265 THEN 'dropoff_location_id' END,
         CASE WHEN passenger_count IS NULL OR passenger_count NOT BETWEEN 1 AND 8 THEN 'passenger_count' END,
         CASE WHEN estimated_distance < 0 THEN 'estimated_distance' END,
         CASE WHEN vendor_id NOT BETWEEN 1 AND 2 THEN 'vendor_id' END,
         CASE WHEN ratecode_id NOT BETWEEN 1 AND 6 THEN 'ratecode_id' END) AS errors,
       concat_ws(',',
         CASE WHEN pickup_location_id = dropoff_location_id AND estimated_distance > 12 THEN 'same_zone_long' END,
         CASE WHEN estimated_distance >= 35 THEN 'long_trip' END,
         CASE WHEN passenger_count > 6 OR estimated_distance < 0.1::DOUBLE OR estimated_distance > 150
              THEN 'beyond_training' END) AS warnings,
       count(*) AS rows
FROM canonical GROUP BY 1, 2"""
)
SQL["valid_requests"] = over_trips(
    f"""SELECT {RAW_FEATURES} FROM canonical
WHERE pickup_location_id IS NOT NULL AND passenger_count IS NOT NULL AND ratecode_id <= 6"""
)

# ---- scalar functions ----

SQL["calendar_parts"] = over_trips(
    """SELECT year(pickup_datetime)::INTEGER AS pickup_year, hour(pickup_datetime)::INTEGER AS pickup_hour,
       (isodow(pickup_datetime) - 1)::INTEGER AS pickup_dayofweek, month(pickup_datetime)::INTEGER AS pickup_month,
       (isodow(pickup_datetime) >= 6)::INTEGER AS is_weekend,
       (hour(pickup_datetime) IN (7, 8, 9, 16, 17, 18, 19))::INTEGER AS is_rush_hour,
       (hour(pickup_datetime) NOT BETWEEN 6 AND 21)::INTEGER AS is_night, count(*) AS rows
FROM canonical GROUP BY ALL"""
)
SQL["route_counts"] = over_trips(
    """SELECT pickup_location_id || '_' || dropoff_location_id AS route_id,
       (pickup_location_id = dropoff_location_id)::INTEGER AS same_zone, count(*) AS rows,
       round(sum(ln(1 + estimated_distance)), 9) AS log_distance
FROM canonical GROUP BY 1, 2"""
)
SQL["parsed_text"] = over_trips(
    """SELECT try_cast(number AS DOUBLE) AS number, count(*) AS rows, count(try_cast(time AS TIMESTAMP)) AS times,
       min(try_cast(time AS TIMESTAMP)) AS first_time
FROM (SELECT CASE WHEN ratecode_id = 99 THEN 'x1' ELSE payment_type::VARCHAR END AS number,
             CASE WHEN vendor_id = 1 THEN 'never' ELSE strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') END AS time
      FROM canonical)
GROUP BY 1"""
)

# ---- files, audit, tables ----

MONTHLY = """monthly AS (
  SELECT trip_type || '_tripdata_' || strftime(pickup_datetime, '%Y-%m') || '.parquet' AS file_name, trip_type,
         strftime(pickup_datetime, '%Y-%m') AS period_label, count(*) AS rows,
         min(pickup_datetime) AS first_pickup, max(pickup_datetime) AS last_pickup
  FROM canonical GROUP BY ALL
), expected AS (
  SELECT f.trip_type, strftime(m, '%Y-%m') AS period_label,
         f.trip_type || '_tripdata_' || strftime(m, '%Y-%m') || '.parquet' AS file_name
  FROM (SELECT unnest(['yellow', 'green']) AS trip_type) f,
       (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m)
)"""
SQL["month_files"] = over_trips(
    """SELECT e.file_name, e.trip_type, e.period_label, coalesce(m.rows, 0) AS rows
FROM expected e LEFT JOIN monthly m ON e.file_name = m.file_name""",
    MONTHLY,
)
SQL["loaded_raw"] = SQL["streamed_raw"] = SQL["canonical_union"]
SQL["load_audit"] = over_trips(
    """SELECT file_name, trip_type, period_label, 'COPIED' AS copy_status, rows AS rows_loaded FROM monthly""",
    MONTHLY,
)
SQL["file_catalogue"] = over_trips(
    """SELECT file_name, rows, first_pickup, last_pickup FROM monthly
WHERE first_pickup < TIMESTAMP '1997-01-01' AND last_pickup >= TIMESTAMP '1996-01-01'""",
    MONTHLY,
)
SQL["audit_upsert"] = over_trips(
    """SELECT file_name, CASE WHEN rows > 300 THEN 'COPIED' ELSE 'STAGED_ONLY' END AS copy_status,
       CASE WHEN rows > 300 THEN rows ELSE 0 END AS rows_loaded,
       CASE WHEN rows > 300 THEN last_pickup ELSE first_pickup END AS loaded_at
FROM monthly""",
    MONTHLY,
)
SQL["files_to_load"] = over_trips(
    """SELECT file_name, trip_type, period_label FROM expected
WHERE file_name NOT IN (SELECT file_name FROM monthly WHERE rows > 300)""",
    MONTHLY,
)
SQL["zone_file"] = over_trips("SELECT location_id, borough, zone, service_zone FROM zones")
SQL["stored_layers"] = over_trips(
    """SELECT 'staging' AS layer, true AS present, count(*) AS rows FROM staging
UNION ALL SELECT 'obt', true, count(*) FROM obt
UNION ALL SELECT split, true, count(*) FROM splits GROUP BY split
UNION ALL SELECT 'scored', false, 0"""
)
SQL["layer_statistics"] = over_trips(
    """SELECT 'staging' AS layer, NULL AS split, f.trip_type, count(s.trip_type) AS rows,
       min(pickup_datetime) AS first_pickup, max(pickup_datetime) AS last_pickup
FROM (VALUES ('yellow'), ('green')) f(trip_type) LEFT JOIN staging s USING (trip_type) GROUP BY f.trip_type
UNION ALL
SELECT 'obt', p.split, f.trip_type, count(s.trip_type), min(pickup_datetime), max(pickup_datetime)
FROM (VALUES ('yellow'), ('green')) f(trip_type) CROSS JOIN (VALUES ('train'), ('validation'), ('test')) p(split)
LEFT JOIN splits s USING (trip_type, split) GROUP BY p.split, f.trip_type"""
)
SQL["stored_obt"] = SQL["incremental_obt"] = SQL["obt_trips"]
SQL["fleet_probe"] = over_trips(
    """SELECT trip_type AS fleet, true AS present, count(*) AS rows FROM canonical GROUP BY trip_type
UNION ALL SELECT 'blue', false, 0"""
)

# ---- preprocessing ----

RAW_NUMERIC = {
    **{name: STAGED_FEATURE[name] for name in ("pickup_year", "pickup_hour", "pickup_month")},
    "pickup_dayofweek": "isodow(pickup_datetime) - 1",
    **{name: f"({STAGED_FEATURE[name]})::INTEGER" for name in ("is_weekend", "is_rush_hour", "is_night", "same_zone")},
    "passenger_count": "passenger_count",
    "estimated_distance": "estimated_distance",
    "log_estimated_distance": "ln(1 + estimated_distance)",
}
SQL["numeric_preprocessing"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "column", round(any_value(m), 9) AS median,
       round(avg(coalesce(x, m)), 9) AS mean, round(stddev_pop(coalesce(x, m)), 9) AS std
FROM (SELECT x, quantile_cont(x, 0.5) OVER () AS m FROM (SELECT ({expr})::DOUBLE AS x FROM canonical))"""
        for name, expr in RAW_NUMERIC.items()
    )
)
RAW_CATEGORIES = {
    **{name: name for name in ("trip_type", "pickup_location_id", "dropoff_location_id", "vendor_id", "ratecode_id")},
    "route_id": "pickup_location_id || '_' || dropoff_location_id",
}
SQL["category_preprocessing"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT * FROM (SELECT '{name}' AS "column", x::VARCHAR AS most_frequent, count(*) OVER () AS levels
FROM (SELECT {expr} AS x, count(*) AS n FROM canonical GROUP BY 1) WHERE x IS NOT NULL ORDER BY n DESC, x LIMIT 1)"""
        for name, expr in RAW_CATEGORIES.items()
    )
)
CATEGORIES = list(RAW_CATEGORIES)
SQL["category_dictionary"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "column", x AS value, n, row_number() OVER (ORDER BY x) - 1 AS id
FROM (SELECT ({expr})::VARCHAR AS x, count(*) AS n FROM canonical GROUP BY 1) WHERE x IS NOT NULL"""
        for name, expr in RAW_CATEGORIES.items()
    )
)
CODED = ("pickup_location_id", "dropoff_location_id", "route_id")
SQL["category_ids"] = over_trips(
    f"""SELECT {", ".join(f"{name}_known.id AS {name}_id" for name in CODED)}, count(*) AS rows FROM splits
"""
    + "\n".join(
        f"""LEFT JOIN (SELECT x, row_number() OVER (ORDER BY x) - 1 AS id
  FROM (SELECT DISTINCT {name}::VARCHAR AS x FROM splits WHERE split = 'train')) {name}_known ON {name}_known.x = splits.{name}::VARCHAR"""
        for name in CODED
    )
    + "\nWHERE split = 'validation' GROUP BY 1, 2, 3"
)
SQL["feature_matrix_shape"] = over_trips(
    "SELECT count(*) AS rows, 11 + "
    + " + ".join(f"count(DISTINCT {name})" for name in CATEGORIES)
    + " AS columns, 6 * count(*) AS one_hot_entries FROM splits WHERE split = 'train'"
)
SQL["unseen_categories"] = over_trips(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "column", (SELECT count(DISTINCT {name}) FROM obt WHERE trip_type = 'green') AS levels,
       count(*) FILTER (WHERE {name} NOT IN (SELECT {name} FROM obt WHERE trip_type = 'green')) AS unseen_rows
FROM obt WHERE trip_type = 'yellow'"""
        for name in ("trip_type", "pickup_location_id", "dropoff_location_id", "route_id")
    )
)

# ---- metrics on fixed predictors ----


def metric_columns(guess: str, digits: int = 9) -> str:
    error = f"(fare_amount - ({guess}))"
    return f"""count(*) AS rows, round(sqrt(avg({error} * {error})), {digits}) AS rmse,
       round(avg(abs({error})), {digits}) AS mae,
       round(avg(abs({error}) / greatest(abs(fare_amount), 1e-8)) * 100, {digits}) AS mape,
       round(1 - avg({error} * {error}) / CASE WHEN var_pop(fare_amount) > 0 THEN var_pop(fare_amount) ELSE 1 END, {digits}) AS r2"""


def middle_error(guess: str, digits: int = 9) -> str:
    return f"round(median(abs(fare_amount - ({guess}))), {digits}) AS med_ae"


RATE = "3.0::DOUBLE + 2.5::DOUBLE * estimated_distance"
HELD_OUT = "splits WHERE split <> 'train'"
SQL["fixed_rate_metrics"] = over_trips(
    f"SELECT split, {metric_columns(RATE)}, {middle_error(RATE)} FROM {HELD_OUT} GROUP BY split"
)
SQL["overall_metrics"] = over_trips(f"SELECT {metric_columns(RATE)}, {middle_error(RATE)} FROM {HELD_OUT}")
SQL["metrics_by_month"] = over_trips(
    f"""SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS window_start, trip_type, {metric_columns(RATE)},
       {middle_error(RATE)} FROM splits WHERE split = 'validation' GROUP BY 1, 2"""
)
SQL["metrics_by_week"] = over_trips(
    f"""SELECT DATE '2001-01-01' + ((CAST(pickup_datetime AS DATE) - DATE '2001-01-01') // 7 * 7)::INTEGER AS window_start,
       {metric_columns(RATE, 10)}, {middle_error(RATE, 10)} FROM splits WHERE split = 'test' GROUP BY 1"""
)
SQL["fleet_metrics_with_total"] = over_trips(
    f"SELECT trip_type, {metric_columns(RATE)}, {middle_error(RATE)} FROM {HELD_OUT} GROUP BY ROLLUP (trip_type)"
)
SQL["metrics_by_grain"] = over_trips(
    f"""SELECT CASE grouping(window_start, trip_type) WHEN 3 THEN 'total' WHEN 2 THEN 'trip_type' WHEN 1 THEN 'window_start'
            ELSE 'window_start+trip_type' END AS grain, window_start, trip_type, {metric_columns(RATE)}, {middle_error(RATE)}
FROM (SELECT *, CAST(date_trunc('month', pickup_datetime) AS DATE) AS window_start FROM splits WHERE split = 'validation')
GROUP BY CUBE (window_start, trip_type)"""
)
MEAN = "train_mean AS (SELECT avg(fare_amount) AS mean_fare FROM splits WHERE split = 'train')"
SQL["mean_baseline"] = over_trips(
    f"""SELECT split, {metric_columns("mean_fare")}, {middle_error("mean_fare")}
FROM (SELECT * FROM {HELD_OUT}), train_mean GROUP BY split""",
    MEAN,
)
RUNS = MEAN + """, code_mean AS (
  SELECT ratecode_id AS code, avg(fare_amount) AS code_fare FROM splits WHERE split = 'train' GROUP BY ratecode_id
), guesses AS (
  SELECT split, fare_amount, mean_fare, code_fare, 2.5::DOUBLE + 3.0::DOUBLE * estimated_distance AS mile_fare
  FROM splits JOIN code_mean ON ratecode_id = code, train_mean
), runs AS (""" + " UNION ALL ".join(
    f"""SELECT '{name}' AS model, {run}::BIGINT AS run, count(*) FILTER (WHERE split = 'train') AS sample_rows,
  sqrt(avg((fare_amount - {guess}) ** 2) FILTER (WHERE split = 'validation')) AS val_rmse,
  sqrt(avg((fare_amount - {guess}) ** 2) FILTER (WHERE split = 'test')) AS test_rmse,
  'v4_multi_taxi_year_estimated_distance' AS contract_version FROM guesses"""
    for name, run, guess in (("mean", 1, "mean_fare"), ("ratecode_mean", 1, "code_fare"), ("per_mile", 2, "mile_fare"))
) + ")"
RUN_COLUMNS = f"model, run, sample_rows, contract_version, {rounded('val_rmse test_rmse')}"
SQL["run_ledger"] = over_trips(f"SELECT {RUN_COLUMNS} FROM runs", RUNS)
SQL["versioned_ledger"] = SQL["run_ledger"]
SQL["model_comparison"] = over_trips(
    f"SELECT {RUN_COLUMNS}, round(test_rmse - val_rmse, 9) AS gap FROM runs", RUNS
)
SQL["best_models"] = over_trips(
    """SELECT arg_min(model, val_rmse) AS best_by_validation, arg_min(model, abs(test_rmse - val_rmse)) AS best_by_gap
FROM runs""",
    RUNS,
)

# ---- scoring ----

SCORED = f"{RAW_FEATURES}, round({RATE}, 2) AS estimated_fare_amount"
SQL["scored_trips"] = over_trips(
    f"""SELECT {SCORED} FROM canonical
WHERE pickup_location_id IS NOT NULL AND passenger_count IS NOT NULL AND ratecode_id <= 6"""
)
SQL["scored_raw_names"] = over_trips(f"SELECT {SCORED} FROM canonical WHERE trip_type = 'yellow'")
SQL["scored_stream"] = over_trips(f"SELECT {SCORED} FROM obt")
