"""Data-quality and exploratory reports, each one grouped pass over the trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.contract import DISTANCE, TARGET, lists_of
from faremill.functions import rules
from faremill.functions.rules import Rule
from faremill.operators.canonical import normalise_frame
from faremill.operators.cleaning import candidate_mask, with_trip_diagnostics
from faremill.operators.quantiles import exact_percentiles, long_values, medians, summaries
from faremill.operators.splits import split_label
from faremill.settings import Settings


def unpivot(row: DataFrame, name: str, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn a one-row frame into (name, value) rows."""
    pairs = [
        F.struct(F.lit(column).alias(name), F.col(column).alias(value)) for column in columns or row.columns
    ]
    return row.select(F.inline(F.array(*pairs)))


# ---- rule reports ----


def rule_diagnostics(df: DataFrame, settings: Settings) -> DataFrame:
    """How many rows pass each diagnostic rule, and all of them, in one scan."""
    counts = [F.count_if(rule.holds(settings)).alias(rule.name) for rule in rules.DIAGNOSTIC]
    every = F.count_if(rules.all_hold(rules.DIAGNOSTIC, settings)).alias("rows_passing_all")
    return df.agg(F.count("*").alias("raw_total"), *counts, every)


def rule_pass_table(df: DataFrame, settings: Settings, reported: Sequence[Rule] = rules.REPORTED) -> DataFrame:
    names = [rule.name for rule in reported]
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(rule.holds(settings)).alias(rule.name) for rule in reported],
    )
    pairs = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(name).alias("rows_passing"),
            F.round(F.col(name) * F.lit(100.0) / F.col("_rows"), 2).alias("pass_pct"),
        )
        for name in names
    ]
    return counts.select(F.inline(F.array(*pairs)))


def quality_checks(df: DataFrame) -> DataFrame:
    fare, distance, riders = F.col(TARGET), F.col(DISTANCE), F.col("passenger_count")
    checks = {
        "rows": F.lit(True),
        "fare_not_positive": fare <= 0,
        "fare_over_maximum": fare > rules.FARE_RANGE[1],
        "fare_below_minimum": fare < rules.FARE_RANGE[0],
        "distance_not_positive": distance <= 0,
        "distance_over_maximum": distance > rules.DISTANCE_RANGE[1],
        "passengers_out_of_range": (riders < rules.PASSENGER_RANGE[0]) | (riders > rules.PASSENGER_RANGE[1]),
        "pickup_zone_missing": F.col("pickup_location_id").isNull(),
        "dropoff_zone_missing": F.col("dropoff_location_id").isNull(),
        "yellow_rows": F.col("trip_type") == "yellow",
        "green_rows": F.col("trip_type") == "green",
    }
    row = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return unpivot(row, "check", "value")


def layer_counts(canonical: DataFrame, settings: Settings) -> DataFrame:
    """Rows of every layer from one scan of the raw trips."""
    kept = F.coalesce(rules.all_hold(rules.STRICT, settings), F.lit(False))
    rows = with_trip_diagnostics(canonical).select(
        "trip_type",
        kept.alias("staged"),
        (kept & (F.col("trip_duration_min") > 0)).alias("modelled"),
        split_label(settings).alias("split"),
    )
    layers = {
        "raw_yellow": F.col("trip_type") == "yellow",
        "raw_green": F.col("trip_type") == "green",
        "staging": F.col("staged"),
        "obt": F.col("modelled"),
        "train": F.col("modelled") & (F.col("split") == "train"),
        "validation": F.col("modelled") & (F.col("split") == "validation"),
        "test": F.col("modelled") & (F.col("split") == "test"),
    }
    row = rows.agg(*[F.count_if(condition).alias(name) for name, condition in layers.items()])
    return unpivot(row, "layer", "rows")


def retention_by_fleet(df: DataFrame, settings: Settings) -> DataFrame:
    return (
        df.groupBy("trip_type")
        .agg(
            F.count("*").alias("total"),
            F.count_if(rules.all_hold(rules.RETENTION, settings)).alias("passing"),
        )
        .withColumn("retention_pct", F.round(F.col("passing") * F.lit(100.0) / F.col("total"), 1))
    )


def raw_against_candidate(df: DataFrame, first: date, last: date) -> DataFrame:
    """Row counts and means before and after the candidate rules, from one pass."""
    trips = normalise_frame(df)
    columns = (TARGET, DISTANCE, "passenger_count")
    trips = trips.select(*columns, candidate_mask(trips, first, last).alias("kept"))
    sums = trips.agg(
        F.count("*").alias("rows"),
        F.count_if("kept").alias("kept_rows"),
        *[F.avg(name).alias(f"{name}_raw") for name in columns],
        *[F.avg(F.when(F.col("kept"), F.col(name))).alias(f"{name}_kept") for name in columns],
    )

    def line(label: str, rows: str, suffix: str) -> Column:
        means = [F.col(f"{name}_{suffix}").alias(f"{name}_mean") for name in columns]
        return F.struct(F.lit(label).alias("dataset"), F.col(rows).alias("rows"), *means)

    return sums.select(
        F.inline(F.array(line("raw", "rows", "raw"), line("candidate", "kept_rows", "kept")))
    )


# ---- column reports ----


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, NULLs and distinct values (NULL counts as one) of every column.

    Values are first combined per (column, value), so a column with one dominant value costs no
    more than any other.
    """
    kinds = dict(df.dtypes)

    def text(name: str) -> Column:
        value = F.col(name)
        if kinds[name] in ("double", "float"):
            value = value + F.lit(0.0)  # -0.0 and 0.0 are one value
        return value.cast("string")

    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.lit(kinds[name]).alias("dtype"), text(name).alias("value"))
            for name in columns or df.columns
        ]
    )
    counted = df.select(F.inline(cells)).groupBy("column", "dtype", "value").agg(F.count("*").alias("n"))
    return (
        counted.groupBy("column", "dtype")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("*").alias("n_unique"),
        )
        .withColumn("null_pct", F.round(F.col("nulls") * F.lit(100.0) / F.col("rows"), 2))
    )


def approximate_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_profile`` with sketched distinct counts: no shuffle of values at all."""
    names = list(columns or df.columns)
    row = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}__nulls") for name in names],
        *[F.approx_count_distinct(name).alias(f"{name}__unique") for name in names],
    )
    kinds = dict(df.dtypes)
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kinds[name]).alias("dtype"),
            F.col("_rows").alias("rows"),
            F.col(f"{name}__nulls").alias("nulls"),
            (F.col(f"{name}__unique") + (F.col(f"{name}__nulls") > 0).cast("int")).alias("n_unique"),
            F.round(F.col(f"{name}__nulls") * F.lit(100.0) / F.col("_rows"), 2).alias("null_pct"),
        )
        for name in names
    ]
    return row.select(F.inline(F.array(*cells)))


#: log2 of the size of a distinct-count sketch; the relative standard error is 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 14


def _profile_value(name: str, kind: str) -> Column:
    value = F.col(name) + F.lit(0.0) if kind in ("double", "float") else F.col(name)  # -0.0 and 0.0 are one value
    return F.when(F.col(name).isNotNull(), F.xxhash64(value))


def profile_parts(df: DataFrame, part: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per part (a month, say) and column: rows, NULLs and a sketch of the distinct values.

    One pass; what moves is one small row per task, part and column. Kept as a table partitioned by ``part``, a new month adds its own rows.
    """
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    sums = [F.count("*").alias("_rows")]
    for i, name in enumerate(names):
        sums += [F.count(name).alias(f"_n{i}"), F.hll_sketch_agg(_profile_value(name, kinds[name]), F.lit(SKETCH_BITS)).alias(f"_s{i}")]
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kinds[name]).alias("dtype"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
            F.col(f"_s{i}").alias("sketch"),
        )
        for i, name in enumerate(names)
    ]
    return df.groupBy(part.alias("part")).agg(*sums).select("part", F.inline(F.array(*cells)))


def merged_profile(parts: DataFrame) -> DataFrame:
    """``column_profile`` with estimated distinct values, from stored parts alone: the trips are not read again."""
    merged = parts.groupBy("column", "dtype").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch")
    )
    distinct = F.hll_sketch_estimate("sketch") + (F.col("nulls") > 0).cast("int")
    return merged.select(
        "column", "dtype", "rows", "nulls", distinct.alias("n_unique"), F.round(F.col("nulls") * F.lit(100.0) / F.col("rows"), 2).alias("null_pct")
    )


def describe(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """count, mean, std, min, max and exact percentiles per column; a column without values has count 0."""

    def sums(value: Column) -> dict[str, Column]:
        return {"mean": F.avg(value), "std": F.stddev_samp(value), "min": F.min(value), "max": F.max(value)}

    points = [F.col("quantiles")[i].alias(percentile_name(p)) for i, p in enumerate(probabilities)]
    made = summaries(df, columns, probabilities, by, sums)
    return made.select(*by, "column", F.col("n").alias("count"), "mean", "std", "min", "max", *points)


def percentile_name(probability: float) -> str:
    return "p" + f"{probability * 100:g}".replace(".", "_")


def fleet_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    made = summaries(df, columns, [0.5], ["trip_type"], lambda value: {"mean": F.avg(value), "std": F.stddev_samp(value)})
    median = F.col("quantiles")[0].alias("median")
    return made.select("trip_type", "column", F.round("mean", 3).alias("mean"), F.round(median, 3).alias("median"), F.round("std", 3).alias("std"))


def year_fleet_coverage(df: DataFrame, fleets: Sequence[str]) -> DataFrame:
    counts = df.groupBy(F.year("pickup_datetime").alias("pickup_year")).pivot("trip_type", list(fleets)).count()
    return counts.na.fill(0, list(fleets))


def target_comparison(df: DataFrame) -> DataFrame:
    """Fare against total amount: mean, median, correlation with the fare."""
    sums = df.agg(
        F.avg("fare_amount").alias("fare_mean"),
        F.avg("total_amount").alias("total_mean"),
        F.corr("fare_amount", "total_amount").alias("together"),
    )
    lines = sums.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("fare_amount").alias("column"),
                    F.col("fare_mean").alias("mean"),
                    F.lit(1.0).alias("correlation_with_fare"),
                ),
                F.struct(
                    F.lit("total_amount").alias("column"),
                    F.col("total_mean").alias("mean"),
                    F.col("together").alias("correlation_with_fare"),
                ),
            )
        )
    )
    return lines.join(F.broadcast(medians(df, ["fare_amount", "total_amount"])), "column")


def post_trip_charges(df: DataFrame) -> DataFrame:
    """Description of what is added to the fare after the trip."""
    charge = F.col("total_amount") - F.col("fare_amount")
    return describe(df, {"total_minus_fare": charge}, [0.25, 0.5, 0.75])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlation matrix, long form, one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])

    def cell(a: str, b: str) -> Column:
        if a == b:
            value = F.lit(1.0)
        else:
            value = F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")
        return F.struct(F.lit(a).alias("column"), F.lit(b).alias("other"), value.alias("correlation"))

    return row.select(F.inline(F.array(*[cell(a, b) for a in columns for b in columns])))


# ---- distributions ----


def histogram(
    df: DataFrame, columns: Sequence[str] | Mapping[str, Column], bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins between each column's (and group's) own extremes; empty bins included.

    The broadcast side has one row per column and group; ``by`` has few values.
    """
    keys = [*by, "column"]
    values = long_values(df, columns, by)
    spread = F.max("value") > F.min("value")
    edges = values.groupBy(*keys).agg(
        (F.min("value") - F.when(spread, 0.0).otherwise(0.5)).alias("low"),
        (F.max("value") + F.when(spread, 0.0).otherwise(0.5)).alias("high"),
        F.count("*").alias("total"),
    )
    place = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    filled = (
        values.join(F.broadcast(edges), keys)
        .withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("n"))
    )
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / bins
    rows = F.coalesce(F.col("n"), F.lit(0))
    return every.join(filled, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("low") + width * F.col("bin")).alias("bin_low"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("bin_high"),
        rows.alias("rows"),
        (rows / (F.col("total") * width)).alias("density"),
    )


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))


def box_plot(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 box lengths) and outliers per group.

    ``by`` has few values: passenger count, hour or weekday.
    """
    boxes = exact_percentiles(df, [column], [0.25, 0.5, 0.75], [by]).select(
        by,
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    value = F.col(column).cast("double")
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return (
        df.select(by, column)
        .filter(F.col(column).isNotNull())
        .join(F.broadcast(boxes), by)
        .groupBy(by)
        .agg(
            F.count("*").alias("rows"),
            F.any_value("q1").alias("q1"),
            F.any_value("median").alias("median"),
            F.any_value("q3").alias("q3"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


# ---- roles and weights ----


def column_role(name: str) -> str:
    if name == TARGET:
        return "TARGET"
    for kind, role in (("leakage_columns", "LEAKAGE"), ("model_feature_columns", "FEATURE")):
        if kind in lists_of(name):
            return role
    if name in ("pickup_datetime", "dropoff_datetime", "trip_type"):
        return "CONTROL"
    return "RAW"


def column_roles(df: DataFrame) -> DataFrame:
    """Role of every column, with how many of its values are present."""
    row = df.agg(*[F.count(F.col(name)).alias(name) for name in df.columns])
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(column_role(name)).alias("role"),
            F.col(name).alias("values"),
        )
        for name in df.columns
    ]
    return row.select(F.inline(F.array(*cells)))


def fleet_weights(df: DataFrame) -> DataFrame:
    """Inverse-frequency weight per fleet; the mean weight over all rows is 1."""
    counts = df.groupBy(F.lower("trip_type").alias("trip_type")).agg(F.count("*").alias("rows"))
    whole = Window.partitionBy()  # over one row per fleet
    return counts.withColumn(
        "weight",
        F.sum("rows").over(whole) / (F.count("*").over(whole) * F.col("rows")).cast("double"),
    )


def fleet_weight_map(df: DataFrame) -> dict[str, float]:
    return {row["trip_type"]: row["weight"] for row in fleet_weights(df).collect()}


def with_fleet_weight(df: DataFrame, weights: Mapping[str, float] | None, name: str = "weight") -> DataFrame:
    """Attach each row's weight; 1.0 for an unknown fleet, no column without weights or fleets."""
    if not weights or "trip_type" not in df.columns:
        return df
    table = F.create_map(*[F.lit(part) for pair in weights.items() for part in pair])
    found = F.try_element_at(table, F.coalesce(F.lower("trip_type"), F.lit("")))
    return df.withColumn(name, F.coalesce(found, F.lit(1.0)))


