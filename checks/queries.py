"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.trips import SETTINGS, canonical, obt_rows, raw, staged, zones
from faremill.contract import CONTRACT_VERSION, DISTANCE, FLEETS, NUMERIC_FEATURES, OBT_COLUMNS, RAW_FEATURES, TARGET
from faremill.functions import trip as fn
from faremill.functions.rules import within_days
from faremill.operators import cleaning, features, learners, lookups, metrics, preprocess, reports, requests, sampling, splits
from faremill.operators.canonical import canonical_trips, normalise_frame
from faremill.operators.dictionary import with_ids
from faremill.operators.quantiles import exact_percentiles
from faremill.plans import incremental, scoring, training
from faremill.plans.layers import build_layers, read_statistics
from faremill.session import cut_lineage, new_folder
from faremill.sources import audit, catalogue, ledger, months, raw_files, tables
from faremill.sources import zones as zone_source
from faremill.streaming import arrivals

SEED = SETTINGS.eda_sample_seed
REGISTERED: dict[str, object] = {}


def registered(query):
    REGISTERED[query.__name__] = query
    return query


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles to a fixed number of places, so that summation order does not show."""
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# ---- layers ----


@registered
def split_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips to splits: rows, mean and median fare per split and fleet."""
    rows = splits.with_split(obt_rows(spark, sf_dir), SETTINGS)
    sums = rows.groupBy("split", "trip_type").agg(F.count("*").alias("rows"), F.avg(TARGET).alias("mean_fare"))
    middle = exact_percentiles(rows, [TARGET], [0.5], ["split", "trip_type"]).select(
        "split", "trip_type", F.col("quantiles")[0].alias("median_fare")
    )
    return rounded(sums.join(F.broadcast(middle), ["split", "trip_type"]))


@registered
def canonical_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(canonical(spark, sf_dir))


@registered
def enabled_fleet_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = canonical_trips(raw(spark, sf_dir), replace(SETTINGS, fleets=("green",)))
    return rounded(green)


@registered
def normalised_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw names to canonical names; a frame without a fleet column becomes yellow."""
    frame = normalise_frame(raw(spark, sf_dir)["yellow"])
    return rounded(frame.drop("store_and_fwd_flag"))


@registered
def normalised_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw green names to canonical names: its dispatch code is no fleet."""
    frame = normalise_frame(raw(spark, sf_dir)["green"])
    return rounded(frame.drop("store_and_fwd_flag", "ehail_fee").withColumn("airport_fee", F.lit(None).cast("double")))


@registered
def fleet_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet names given with blanks, in capitals, empty or not at all."""
    trips_ = canonical(spark, sf_dir)
    written = (
        F.when(F.col("passenger_count").isNull(), F.lit(None).cast("string"))
        .when(F.col("vendor_id") == 1, F.concat(F.lit(" "), F.upper("trip_type"), F.lit(" ")))
        .when(F.col("payment_type") == 1, F.lit("  "))
        .otherwise(F.col("trip_type"))
    )
    frame = normalise_frame(trips_.withColumn("given", written).withColumn("trip_type", written))
    return frame.groupBy("given", "trip_type").agg(F.count("*").alias("rows"))


@registered
def staging_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(staged(spark, sf_dir))


@registered
def candidate_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cleaning.candidate_trips(canonical(spark, sf_dir), SETTINGS.data_start, SETTINGS.data_end)
    return rounded(frame)


@registered
def candidate_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mask over columns that arrive as text, some of it no number."""
    frame = canonical(spark, sf_dir).select(
        "trip_type",
        F.col("pickup_datetime").cast("string"),
        F.col("dropoff_datetime").cast("string"),
        F.when(F.col("ratecode_id") == 99, "n/a").otherwise(F.col("trip_distance").cast("string")).alias("trip_distance"),
        F.col("passenger_count").cast("string"),
        "pickup_location_id",
        "dropoff_location_id",
        F.col("fare_amount").cast("string"),
    )
    trips_ = normalise_frame(frame)
    kept = cleaning.candidate_mask(trips_, SETTINGS.data_start, SETTINGS.data_end, positive_fare=False)
    return trips_.groupBy("trip_type", kept.alias("kept")).agg(F.count("*").alias("rows"))


@registered
def trip_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.with_trip_diagnostics(canonical(spark, sf_dir))
    exact = fn.exact_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    rows = rows.withColumn("trip_duration_min_exact", exact)
    return rounded(
        rows.groupBy("trip_duration_min").agg(
            F.count("*").alias("rows"),
            F.min("trip_duration_min_exact").alias("shortest"),
            F.max("trip_duration_min_exact").alias("longest"),
            F.max("speed_mph").alias("max_speed"),
            F.count("speed_mph").alias("with_speed"),
        )
    )


@registered
def obt_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(obt_rows(spark, sf_dir))


@registered
def obt_reference_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(obt_rows(spark, sf_dir).select(*OBT_COLUMNS))


@registered
def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17 model features, derived from raw feature columns that passed the leakage guard."""
    rows = staged(spark, sf_dir).select(*RAW_FEATURES)
    return rounded(features.prepare_features(rows))


@registered
def features_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.features_and_target(obt_rows(spark, sf_dir)))


@registered
def time_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splits.with_split(obt_rows(spark, sf_dir), SETTINGS))


@registered
def validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splits.split(obt_rows(spark, sf_dir), "validation", SETTINGS))


@registered
def split_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_summary(obt_rows(spark, sf_dir), SETTINGS)


@registered
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that lie in more than one split, and in none: both must be 0."""
    rows = obt_rows(spark, sf_dir)
    member = sum(
        (
            F.coalesce(within_days(F.col("pickup_datetime"), *span).cast("int"), F.lit(0))
            for span in SETTINGS.split_ranges.values()
        ),
        F.lit(0),
    )
    return rows.agg(
        F.count_if(member > 1).alias("in_several"),
        F.count_if(member == 0).alias("in_none"),
        F.count("*").alias("rows"),
    )


@registered
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.layer_counts(canonical(spark, sf_dir), SETTINGS)


# ---- rule reports ----


@registered
def rule_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rule_diagnostics(canonical(spark, sf_dir), SETTINGS)


@registered
def rule_pass_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rule_pass_table(canonical(spark, sf_dir), SETTINGS)


@registered
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_checks(canonical(spark, sf_dir))


@registered
def failing_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip that breaks a diagnostic rule, with the broken rules flagged."""
    rows = cleaning.failing_trips(canonical(spark, sf_dir), SETTINGS)
    shown = [
        "trip_type",
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "pickup_location_id",
        "dropoff_location_id",
        "fare_amount",
    ]
    return rounded(rows.select(*shown, *[name for name in rows.columns if name.startswith("bad_")]))


@registered
def failing_trip_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten failing trips by pickup."""
    return rounded(
        cleaning.failing_trips(canonical(spark, sf_dir), SETTINGS)
        .withColumn("trip_key", sampling.trip_key(dropoff=True))
        .orderBy("pickup_datetime", "trip_key")
        .limit(10)
        .select("trip_key", "bad_time_order", "bad_trip_distance", "bad_passenger_count", "bad_fare_amount")
    )


@registered
def retention_by_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.retention_by_fleet(canonical(spark, sf_dir), SETTINGS)


@registered
def raw_against_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = canonical(spark, sf_dir)
    return rounded(reports.raw_against_candidate(rows, SETTINGS.data_start, SETTINGS.data_end))


# ---- column reports ----

DESCRIBED = ["fare_amount", DISTANCE, "passenger_count", "pickup_hour", "pickup_dayofweek", "pickup_month"]


@registered
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.column_profile(canonical(spark, sf_dir))


@registered
def approximate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.approximate_profile(canonical(spark, sf_dir))


@registered
def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column profile from sketches that are stored month by month: rows, NULLs, and whether the estimate is within its error."""
    rows = canonical(spark, sf_dir)
    path = new_folder(spark, "profile")
    month = F.coalesce(F.date_format("pickup_datetime", "yyyy-MM"), F.lit("none"))
    reports.profile_parts(rows, month).write.partitionBy("part").parquet(path)
    found = reports.merged_profile(spark.read.parquet(path))
    exact = reports.column_profile(rows).select("column", F.col("n_unique").alias("exact"))
    error = 4 * 1.04 / 2 ** (reports.SKETCH_BITS / 2)
    close = F.abs(F.col("n_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), F.lit(error) * F.col("exact"))
    return found.join(exact, "column").select("column", "dtype", "rows", "nulls", "null_pct", F.col("exact").alias("n_unique"), close.alias("close"))


@registered
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_trip_features(canonical(spark, sf_dir))
    return rounded(reports.describe(rows, DESCRIBED, [0.01, 0.05, 0.5, 0.95, 0.99]))


@registered
def describe_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = canonical(spark, sf_dir)
    return rounded(reports.describe(rows, [TARGET, DISTANCE], [0.95, 0.99, 0.995, 0.999]))


@registered
def describe_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = obt_rows(spark, sf_dir)
    return rounded(
        reports.describe(rows, [*NUMERIC_FEATURES, TARGET], [0.01, 0.05, 0.5, 0.95, 0.99])
    )


@registered
def fleet_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fleet_statistics(obt_rows(spark, sf_dir), [TARGET, DISTANCE, "passenger_count"])


@registered
def year_fleet_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.year_fleet_coverage(canonical(spark, sf_dir), FLEETS)


@registered
def target_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.target_comparison(canonical(spark, sf_dir)))


@registered
def post_trip_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.post_trip_charges(canonical(spark, sf_dir)))


@registered
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_trip_features(canonical(spark, sf_dir))
    return rounded(reports.correlations(rows, DESCRIBED))


@registered
def fare_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = canonical(spark, sf_dir)
    return rounded(reports.histogram(rows, [TARGET, DISTANCE], 50))


@registered
def cleaning_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = fn.exact_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    columns = {"trip_distance": F.col("trip_distance"), TARGET: F.col(TARGET), "trip_minutes": minutes}
    return rounded(reports.histogram(canonical(spark, sf_dir), columns, 60))


@registered
def fleet_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = obt_rows(spark, sf_dir)
    return rounded(reports.histogram(rows, [DISTANCE, TARGET, "passenger_count"], 40, ["trip_type"]))


@registered
def trips_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_trip_features(canonical(spark, sf_dir))
    return reports.counts_by(rows, "pickup_hour", "trip_type")


@registered
def trips_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.with_trip_features(canonical(spark, sf_dir))
    return reports.counts_by(rows, "pickup_dayofweek", "trip_type")


@registered
def trips_by_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by(obt_rows(spark, sf_dir), "vendor_id")


@registered
def trips_by_ratecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_by(obt_rows(spark, sf_dir), "ratecode_id")


@registered
def fare_box_by_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.candidate_trips(canonical(spark, sf_dir), SETTINGS.data_start, SETTINGS.data_end)
    return rounded(reports.box_plot(kept, TARGET, "passenger_count"))


@registered
def distance_box_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.box_plot(obt_rows(spark, sf_dir), DISTANCE, "pickup_hour"))


@registered
def distance_box_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.box_plot(obt_rows(spark, sf_dir), DISTANCE, "pickup_dayofweek"))


@registered
def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.column_roles(staged(spark, sf_dir))


@registered
def feature_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model features in order, their role and how many values each takes."""
    profile = reports.column_profile(features.prepare_features(staged(spark, sf_dir).select(*RAW_FEATURES)))
    return features.with_feature_role(profile).select("position", "column", "role", "n_unique")


@registered
def fleet_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.fleet_weights(splits.split(obt_rows(spark, sf_dir), "train", SETTINGS)))


@registered
def row_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the training split applied to all trips: their sum per split and fleet."""
    rows = splits.with_split(obt_rows(spark, sf_dir), SETTINGS)
    weights = reports.fleet_weight_map(rows.filter(F.col("split") == "train"))
    weighted = reports.with_fleet_weight(rows, weights)
    return rounded(
        weighted.groupBy("split", "trip_type").agg(F.sum("weight").alias("weight"), F.count("*").alias("rows")),
        6,
    )


# ---- windows, samples, previews ----


@registered
def month_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, "month")


@registered
def week_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, "week")


def _window_counts(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    first, last = SETTINGS.split_ranges["validation"]
    rows = splits.with_window(splits.split(obt_rows(spark, sf_dir), "validation", SETTINGS), first, last, grain)
    counts = rows.groupBy("window_start", "window_end").agg(F.count("*").alias("rows"))
    every = splits.windows(spark, first, last, grain)
    return every.join(counts, ["window_start", "window_end"], "left").na.fill(0, ["rows"])


@registered
def window_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of the first test window in pickup order."""
    first, last = SETTINGS.split_ranges["test"]
    month_end = first.replace(day=31)
    return rounded(splits.window_rows(obt_rows(spark, sf_dir), first, month_end))


@registered
def day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splits.days_of_month(obt_rows(spark, sf_dir), 8, 14))


@registered
def balanced_raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sampling.balanced_sample(canonical(spark, sf_dir), 5_001, SETTINGS))


@registered
def random_obt_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sampling.random_rows(obt_rows(spark, sf_dir), 2_000, SEED))


@registered
def fixed_size_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = splits.split(obt_rows(spark, sf_dir), "train", SETTINGS)
    return sampling.fixed_size_sample(rows, 3_000, SEED)


@registered
def stratified_train_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal shares of each training year and fleet; short strata come whole."""
    train = splits.split(obt_rows(spark, sf_dir), "train", SETTINGS)
    return rounded(sampling.stratified_train_sample(train, 10_000, SETTINGS))


@registered
def newest_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = obt_rows(spark, sf_dir).withColumn("trip_key", sampling.trip_key())
    return rounded(rows.orderBy(F.desc("pickup_datetime"), "trip_key").limit(10))


# ---- lookups and request checks ----


@registered
def zone_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.with_zone_labels(obt_rows(spark, sf_dir), zones(spark, sf_dir))
    return rows.groupBy("pickup_zone", "dropoff_zone").agg(F.count("*").alias("rows"))


@registered
def zone_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.with_zone_facts(obt_rows(spark, sf_dir), zones(spark, sf_dir))
    ends = ("pickup_borough", "dropoff_borough", "pickup_is_airport", "dropoff_is_airport")
    return rounded(rows.groupBy(*ends).agg(F.count("*").alias("rows"), F.sum(TARGET).alias("fares")), 6)


@registered
def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.with_code_labels(canonical(spark, sf_dir))
    return rows.groupBy("ratecode_label", "vendor_label").agg(F.count("*").alias("rows"))


@registered
def request_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = requests.check_requests(canonical(spark, sf_dir))
    return checked.groupBy(
        F.concat_ws(",", "errors").alias("errors"), F.concat_ws(",", "warnings").alias("warnings")
    ).agg(F.count("*").alias("rows"))


@registered
def valid_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = requests.valid_requests(requests.check_requests(canonical(spark, sf_dir)))
    return rounded(kept.select(*RAW_FEATURES))


# ---- scalar functions ----


@registered
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fn.calendar(F.col("pickup_datetime"))
    rows = canonical(spark, sf_dir).select(*[expr.alias(name) for name, expr in parts.items()])
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("rows"))


@registered
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fn.route(F.col("pickup_location_id"), F.col("dropoff_location_id"))
    rows = canonical(spark, sf_dir).withColumns(parts)
    return rounded(
        rows.groupBy("route_id", "same_zone").agg(
            F.count("*").alias("rows"), F.sum(F.log1p(DISTANCE)).alias("log_distance")
        )
    )


@registered
def parsed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and times out of text, NULL where the text is neither."""
    rows = canonical(spark, sf_dir).select(
        F.when(F.col("ratecode_id") == 99, "x1").otherwise(F.col("payment_type").cast("string")).alias("number"),
        F.when(F.col("vendor_id") == 1, "never")
        .otherwise(F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss"))
        .alias("time"),
    )
    parsed = rows.select(
        fn.number(F.col("number")).alias("number"), F.col("time").try_cast("timestamp_ntz").alias("time")
    )
    return parsed.groupBy("number").agg(
        F.count("*").alias("rows"), F.count("time").alias("times"), F.min("time").alias("first_time")
    )


# ---- files, audit, tables ----


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """The raw trips as monthly files, the way they arrive."""
    root = new_folder(spark, "landing")
    for fleet, rows in raw(spark, sf_dir).items():
        month = F.col("tpep_pickup_datetime" if fleet == "yellow" else "lpep_pickup_datetime")
        named = rows.withColumn("file", months.file_name(F.lit(fleet), month))
        # One file per month; months are spread over the tasks, a heavy one over several.
        named.repartition("file", F.pmod(F.hash("vendorid", month), F.lit(4))).write.partitionBy("file").parquet(
            f"{root}/{fleet}"
        )
    return root


@registered
def month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected monthly files and how many raw trips each month holds."""
    month = F.trunc(F.to_date("pickup_datetime"), "MM")
    held = (
        canonical(spark, sf_dir)
        .groupBy(months.file_name(F.col("trip_type"), month).alias("file_name"))
        .agg(F.count("*").alias("rows"))
    )
    return months.month_files(spark, SETTINGS).join(held, "file_name", "left").na.fill(0, ["rows"])


@registered
def loaded_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files loaded into the raw table, twice: the second load finds nothing to do."""
    landing, root = _landing(spark, sf_dir), new_folder(spark, "loaded")
    loaded = {}
    for fleet in FLEETS:
        for _ in range(2):
            raw_files.load_trip_files(spark, landing, f"{root}/{fleet}", f"{root}/audit", fleet)
        loaded[fleet] = raw_files.read_raw(spark, f"{root}/{fleet}", fleet)
    return rounded(canonical_trips(loaded, SETTINGS))


@registered
def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and span of pickups of the monthly files of one year, from the footers of their part files."""
    parts = catalogue.footers(spark, [_landing(spark, sf_dir)])
    held = catalogue.within(parts, date(1996, 1, 1), date(1996, 12, 31))
    return held.groupBy("file_name").agg(
        F.sum("rows").alias("rows"), F.min("first_pickup").alias("first_pickup"), F.max("last_pickup").alias("last_pickup")
    )


@registered
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit after two loads, the second of which repeats every file."""
    landing, root = _landing(spark, sf_dir), new_folder(spark, "audited")
    for fleet in FLEETS:
        for again in (False, True):
            raw_files.load_trip_files(spark, landing, f"{root}/{fleet}", f"{root}/audit", fleet, again)
    return audit.current_audit(spark, f"{root}/audit").select(
        "file_name", "trip_type", "period_label", "copy_status", "rows_loaded"
    )


@registered
def streamed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same raw table out of the file stream."""
    landing, root = _landing(spark, sf_dir), new_folder(spark, "streamed")
    loaded = {}
    for fleet in FLEETS:
        arrivals.stream_trip_files(
            spark, f"{landing}/{fleet}/*", f"{root}/{fleet}", f"{root}/audit", f"{root}/seen-{fleet}", fleet
        ).awaitTermination()
        loaded[fleet] = raw_files.read_raw(spark, f"{root}/{fleet}", fleet)
    return rounded(canonical_trips(loaded, SETTINGS))


def _audit_rounds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two rounds of audit rows per month: first staged, then copied where it has over 300 trips."""
    month = F.trunc(F.to_date("pickup_datetime"), "MM")
    name = months.file_name(F.col("trip_type"), month).alias("file_name")
    per_file = canonical(spark, sf_dir).groupBy("trip_type", name).agg(
        F.count("*").alias("rows"), F.min("pickup_datetime").alias("first"), F.max("pickup_datetime").alias("last")
    )
    first = per_file.select(
        "file_name", F.lit(audit.STAGED_ONLY).alias("copy_status"), F.lit(0).cast("bigint").alias("rows_loaded"),
        F.col("first").alias("loaded_at"),
    )
    second = per_file.filter(F.col("rows") > 300).select(
        "file_name", F.lit(audit.COPIED).alias("copy_status"), F.col("rows").alias("rows_loaded"),
        F.col("last").alias("loaded_at"),
    )
    return first, second


@registered
def audit_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _audit_rounds(spark, sf_dir)
    return audit.upsert(first, second, "file_name", "loaded_at")


@registered
def files_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _audit_rounds(spark, sf_dir)
    current = audit.upsert(first, second, "file_name", "loaded_at")
    return audit.not_yet_loaded(months.month_files(spark, SETTINGS), current)


@registered
def zone_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension written as quoted CSV and read back."""
    path = new_folder(spark, "zones")
    zones(spark, sf_dir).write.option("header", "true").option("quoteAll", "true").csv(path)
    return zone_source.read_zones(spark, path)


@registered
def stored_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers written as tables: which exist, and how many rows they hold."""
    root = new_folder(spark, "layers")
    build_layers(raw(spark, sf_dir), SETTINGS, root, store_splits=True)
    names = ["staging", "obt", "train", "validation", "test", "scored"]
    counts = tables.table_counts(spark, {name: f"{root}/{name}" for name in names})
    listed = [(name, counts[name] is not None, counts[name] or 0) for name in names]
    return spark.createDataFrame(listed, "layer string, present boolean, rows bigint")


@registered
def stored_obt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling table as stored, partitioned by pickup year."""
    root = new_folder(spark, "layers")
    return rounded(build_layers(raw(spark, sf_dir), SETTINGS, root)["obt"])


@registered
def layer_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and span of pickups by layer, split and fleet, noted while the layers were written."""
    root = new_folder(spark, "layers")
    build_layers(raw(spark, sf_dir), SETTINGS, root)
    return read_statistics(spark, root)


@registered
def incremental_obt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling table of a store that was built from part of the months and brought up to date twice."""
    root = new_folder(spark, "versions")
    month = F.date_format("pickup_datetime", "yyyy-MM")
    frames = {
        fleet: rows.withColumn("period_label", F.coalesce(F.date_format(rows[f"{prefix}_pickup_datetime"], "yyyy-MM"), F.lit("none")))
        for (fleet, rows), prefix in zip(raw(spark, sf_dir).items(), ("tpep", "lpep"))
    }
    seen = canonical(spark, sf_dir).select("trip_type", F.coalesce(month, F.lit("none")).alias("period_label")).distinct()
    loaded = seen.select("*", F.lit(audit.COPIED).alias("copy_status"), F.lit("2025-01-01").cast("timestamp").alias("loaded_at"))
    later = F.when(F.col("period_label") < "1996", F.lit("2025-02-01").cast("timestamp")).otherwise(F.col("loaded_at"))
    for audited in (loaded.filter("period_label < '1998'"), loaded, loaded.withColumn("loaded_at", later)):
        incremental.update_layers(frames, audited, SETTINGS, root)
    return rounded(incremental.read_layer(spark, root, "obt"))


@registered
def fleet_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existence and count probes per fleet, and for a fleet that has no trips."""
    rows = canonical(spark, sf_dir)
    probes = []
    for fleet in (*FLEETS, "blue"):
        found = rows.filter(F.col("trip_type") == fleet)
        probes.append((fleet, tables.has_rows(found), found.count()))
    return spark.createDataFrame(probes, "fleet string, present boolean, rows bigint")


# ---- preprocessing ----


@registered
def numeric_preprocessing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill value, mean and population std per numeric feature, on raw trips with gaps."""
    return rounded(preprocess.numeric_statistics(features.with_trip_features(canonical(spark, sf_dir))))


@registered
def category_preprocessing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.category_statistics(features.with_trip_features(canonical(spark, sf_dir)))


@registered
def category_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and dense id of every categorical value of the raw trips."""
    return preprocess.category_dictionary(features.with_trip_features(canonical(spark, sf_dir)))


@registered
def category_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation trips by the ids of their zones and route in a dictionary of the training trips; new values have none."""
    rows = obt_rows(spark, sf_dir)
    known = cut_lineage(preprocess.category_dictionary(splits.split(rows, "train", SETTINGS)))
    named = with_ids(splits.split(rows, "validation", SETTINGS), known, ["pickup_location_id", "dropoff_location_id", "route_id"])
    ids = [f"{name}_id" for name in ("pickup_location_id", "dropoff_location_id", "route_id")]
    return named.groupBy(*ids).agg(F.count("*").alias("rows"))


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split(obt_rows(spark, sf_dir), "train", SETTINGS)


@registered
def feature_matrix_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns and one-hot entries of the encoded training matrix."""
    train = _train(spark, sf_dir)
    vectors = preprocess.to_vectors(preprocess.fit_preprocessor(train), train)
    summary = vectors.agg(Summarizer.metrics("count", "numNonZeros").summary(F.col("features")).alias("s"))
    filled = vector_to_array("s.numNonZeros")
    one_hot = F.aggregate(F.slice(filled, len(NUMERIC_FEATURES) + 1, F.size(filled)), F.lit(0.0), lambda a, b: a + b)
    return summary.select(
        F.col("s.count").alias("rows"),
        F.size(filled).cast("bigint").alias("columns"),
        one_hot.cast("bigint").alias("one_hot_entries"),
    )


@registered
def unseen_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoder fitted on green trips: levels known, and yellow trips whose value it has not seen."""
    rows = obt_rows(spark, sf_dir)
    fitted = preprocess.fit_preprocessor(rows.filter(F.col("trip_type") == "green"))
    encoded = fitted.transform(rows.filter(F.col("trip_type") == "yellow"))
    names = ("trip_type", "pickup_location_id", "dropoff_location_id", "route_id")
    summary = encoded.agg(
        F.count("*").alias("rows"),
        *[Summarizer.numNonZeros(F.col(f"{name}_hot")).alias(name) for name in names],
    )

    def seen(name: str) -> Column:
        return F.aggregate(vector_to_array(name), F.lit(0.0), lambda a, b: a + b).cast("bigint")

    cells = [
        F.struct(
            F.lit(name).alias("column"),
            (F.col("rows") - seen(name)).alias("unseen_rows"),
            F.size(vector_to_array(name)).cast("bigint").alias("levels"),
        )
        for name in names
    ]
    return summary.select(F.inline(F.array(*cells)))


# ---- metrics on fixed predictors ----


def fixed_rate() -> Column:
    return F.lit(3.0) + F.lit(2.5) * F.col(DISTANCE)


class FixedRate:
    """A predictor without training: three dollars and 2.50 a mile."""

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", fixed_rate())


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.with_split(obt_rows(spark, sf_dir), SETTINGS).filter(F.col("split") != "train")


@registered
def fixed_rate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = FixedRate().transform(_held_out(spark, sf_dir))
    return rounded(metrics.regression_metrics(rows, by=["split"]))


@registered
def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.regression_metrics(FixedRate().transform(_held_out(spark, sf_dir))))


@registered
def metrics_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per evaluation window and fleet of the validation split."""
    first, last = SETTINGS.split_ranges["validation"]
    rows = splits.split(obt_rows(spark, sf_dir), "validation", SETTINGS)
    rows = splits.with_window(FixedRate().transform(rows), first, last, "month")
    return rounded(metrics.regression_metrics(rows, by=["window_start", "trip_type"]))


@registered
def metrics_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = SETTINGS.split_ranges["test"]
    rows = splits.split(obt_rows(spark, sf_dir), "test", SETTINGS)
    rows = splits.with_window(FixedRate().transform(rows), first, last, "week")
    return rounded(metrics.regression_metrics(rows, by=["window_start"]), 10)


@registered
def fleet_metrics_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.total_and_parts(FixedRate().transform(_held_out(spark, sf_dir)), "trip_type"))


@registered
def metrics_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five metrics by month, by fleet, by both and in all, of the validation split."""
    first, _ = SETTINGS.split_ranges["validation"]
    rows = FixedRate().transform(splits.split(obt_rows(spark, sf_dir), "validation", SETTINGS))
    rows = rows.withColumn("window_start", splits.window_start(first, SETTINGS.grain))
    grains = [[], ["window_start"], ["trip_type"], ["window_start", "trip_type"]]
    return rounded(metrics.metrics_by_grains(rows, grains))


@registered
def model_errors_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained model (ridge) by split, evaluation window and fleet."""
    preset = learners.CATALOG["ridge_regressor"]
    trained = training.train(_train(spark, sf_dir), preset, _preprocessor(spark, sf_dir, preset))
    return training.evaluate_by_grain(trained, obt_rows(spark, sf_dir), SETTINGS)


@registered
def versioned_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs added to the versioned ledger one after the other; the last run of each model counts."""
    root = new_folder(spark, "ledger")
    kinds = {field.name: field.dataType for field in ledger.ENTRIES if field.name not in ledger.RUNS.fieldNames()}
    runs = _closed_form_runs(spark, sf_dir).withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()})
    for run in (1, 2):
        ledger.append_entries(runs.filter(F.col("run") == run), root)
    current = ledger.current_entries(ledger.read_entries(spark, root))
    return rounded(current.select(*ledger.RUNS.fieldNames()))


@registered
def mean_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = learners.fit_mean(_train(spark, sf_dir))
    return rounded(metrics.regression_metrics(model.transform(_held_out(spark, sf_dir)), by=["split"]))


def _closed_form_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three predictors that need no learner, as ledger rows; the per-mile one is run twice."""
    rows = splits.with_split(obt_rows(spark, sf_dir), SETTINGS)
    train = rows.filter(F.col("split") == "train")
    mean = train.agg(F.avg(TARGET)).first()[0]
    by_code = train.groupBy("ratecode_id").agg(F.avg(TARGET).alias("code_mean"))  # six rate codes
    guesses = {
        ("mean", 1): F.lit(mean),
        ("ratecode_mean", 1): F.col("code_mean"),
        ("per_mile", 1): fixed_rate(),
        ("per_mile", 2): F.lit(2.5) + F.lit(3.0) * F.col(DISTANCE),
    }

    def rmse(part: str, guess: Column) -> Column:
        error = F.when(F.col("split") == part, F.col(TARGET) - guess)
        return F.sqrt(F.avg(error * error))

    line = rows.join(F.broadcast(by_code), "ratecode_id").agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("model"),
                    F.lit(run).cast("bigint").alias("run"),
                    F.count_if(F.col("split") == "train").alias("sample_rows"),
                    rmse("validation", guess).alias("val_rmse"),
                    rmse("test", guess).alias("test_rmse"),
                    F.lit(CONTRACT_VERSION).alias("contract_version"),
                )
                for (name, run), guess in guesses.items()
            ]
        ).alias("runs")
    )
    return line.select(F.inline("runs"))


@registered
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs appended to the ledger file one after the other; the last run of each model counts."""
    path = new_folder(spark, "ledger")
    runs = _closed_form_runs(spark, sf_dir)
    for run in (1, 2):
        ledger.append_runs(runs.filter(F.col("run") == run), path)
    return rounded(ledger.latest_runs(ledger.read_runs(spark, path)))


@registered
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.compare_models(ledger.latest_runs(_closed_form_runs(spark, sf_dir))))


@registered
def best_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_models(ledger.latest_runs(_closed_form_runs(spark, sf_dir)))


# ---- scoring ----


@registered
def scored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All valid requests scored with the fixed rate."""
    trips = canonical(spark, sf_dir).select(*RAW_FEATURES)
    return rounded(scoring.score_requests(FixedRate(), trips))


@registered
def scored_raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring straight from raw column names, without a fleet column."""
    yellow = raw(spark, sf_dir)["yellow"].select(
        "vendorid", "tpep_pickup_datetime", "passenger_count", "trip_distance", "ratecodeid", "pulocationid",
        "dolocationid",
    )
    return rounded(scoring.score(FixedRate(), yellow))


@registered
def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of the modelling table scored as a stream of files."""
    root = new_folder(spark, "stream")
    obt_rows(spark, sf_dir).select(*RAW_FEATURES).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")
    scoring.score_stream(FixedRate(), stream, f"{root}/out", f"{root}/seen").awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out"))


# ---- learners: trained on the whole training split, measured on the others ----

ROUNDS = 5  # trees of those ensembles that are not trained in full here; the catalog names the full numbers
_preprocessors: dict[tuple[str, str, int], PipelineModel] = {}


def _preprocessor(spark: SparkSession, sf_dir: str, preset: learners.Preset) -> PipelineModel:
    key = (spark.sparkContext.applicationId, sf_dir, preset.nominal_levels)
    if key not in _preprocessors:
        _preprocessors[key] = preprocess.fit_preprocessor(_train(spark, sf_dir), preset.nominal_levels)
    return _preprocessors[key]


def _errors(name: str, scored: DataFrame) -> DataFrame:
    error = F.col(TARGET) - F.col("prediction")
    return scored.groupBy("split").agg(
        F.lit(name).alias("model"),
        F.count("*").alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.stddev_pop(TARGET).alias("target_std"),
    )


def _learner(name: str, **sizes: float):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        preset = learners.CATALOG[name]
        preset = replace(preset, settings={**preset.settings, **sizes})
        trained = training.train(_train(spark, sf_dir), preset, _preprocessor(spark, sf_dir, preset))
        return _errors(name, trained.predict(_held_out(spark, sf_dir), "split", TARGET))

    query.__name__ = f"learner_{name}"
    return registered(query)


for _name in ("ridge_regressor", "sgd_regressor", "gradient_boosting", "hist_gradient_boosting", "xgboost", "catboost", "voting"):
    _learner(_name)
for _name in ("random_forest", "bagging", "pasting", "lightgbm", "adaboost"):
    _learner(_name, rounds=ROUNDS)


@registered
def continued_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting carried on from year and fleet to the next year and fleet."""
    preset = learners.CATALOG["xgboost"].sized(10)
    fitted = _preprocessor(spark, sf_dir, preset)
    rows = preprocess.to_vectors(fitted, _train(spark, sf_dir), TARGET, "pickup_year", "trip_type").persist()
    strata = [
        (F.col("pickup_year") == year) & (F.col("trip_type") == fleet)
        for year in range(SETTINGS.data_start.year, SETTINGS.train_end.year + 1)
        for fleet in SETTINGS.fleets
    ]
    model = learners.fit_continued(rows, preset, strata)
    rows.unpersist()
    held_out = preprocess.to_vectors(fitted, _held_out(spark, sf_dir), "split", TARGET)
    return _errors("continued_boosting", model.transform(held_out))


@registered
def model_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog entries side by side, best validation error first."""
    return training.benchmark(obt_rows(spark, sf_dir), SETTINGS)


@registered
def production_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, evaluate, store and reload the production model; its facts and its scores' mean."""
    root = new_folder(spark, "production")
    rows = obt_rows(spark, sf_dir)
    training.train_production(rows, SETTINGS, root)
    scored = scoring.score(training.load_model(f"{root}/model"), splits.split(rows, "test", SETTINGS).select(*RAW_FEATURES))
    return training.model_facts(spark, root).withColumn(
        "mean_score", F.lit(scored.agg(F.avg("estimated_fare_amount")).first()[0])
    )
