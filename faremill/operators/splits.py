"""Time splits and evaluation windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.rules import within_days
from faremill.settings import Settings


def split_label(settings: Settings) -> Column:
    pickup = F.col("pickup_datetime")
    label = F.lit(None).cast("string")
    for name, (first, last) in reversed(settings.split_ranges.items()):
        label = F.when(within_days(pickup, first, last), F.lit(name)).otherwise(label)
    return label


def with_split(df: DataFrame, settings: Settings) -> DataFrame:
    labelled = df.withColumn("split", split_label(settings))
    return labelled.filter(F.col("split").isNotNull())


def split(df: DataFrame, name: str, settings: Settings) -> DataFrame:
    first, last = settings.split_ranges[name]
    rows = df.filter(within_days(F.col("pickup_datetime"), first, last))
    if "pickup_year" in df.columns:  # lets a table partitioned by year skip whole directories
        rows = rows.filter(F.col("pickup_year").between(first.year, last.year))
    return rows


def split_frames(df: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    return {name: split(df, name, settings) for name in settings.split_ranges}


def _window_start(day: Column, first: Column, grain: str) -> Column:
    if grain == "week":  # seven-day steps counted from the first day, whatever weekday that is
        return F.date_sub(day, F.pmod(F.date_diff(day, first), F.lit(7)))
    return F.greatest(F.trunc(day, "MM"), first)


def window_start(first: date, grain: str) -> Column:
    """First day of the evaluation window of a trip, of those counted from ``first``."""
    return _window_start(F.to_date("pickup_datetime"), F.lit(first), grain)


def _window_end(start: Column, last: Column, grain: str) -> Column:
    end = F.date_add(start, 6) if grain == "week" else F.last_day(start)
    return F.least(end, last)


def with_window(df: DataFrame, first: date, last: date, grain: str) -> DataFrame:
    """Each row's evaluation window, computed from its date alone: no join, no shuffle."""
    start = _window_start(F.to_date("pickup_datetime"), F.lit(first), grain)
    return df.withColumn("window_start", start).withColumn(
        "window_end", _window_end(F.col("window_start"), F.lit(last), grain)
    )


def windows(spark: SparkSession, first: date, last: date, grain: str) -> DataFrame:
    """All windows of a range, including those without a single trip."""
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )
    start = _window_start(F.col("day"), F.lit(first), grain)
    return (
        days.filter(start == F.col("day"))
        .select(F.col("day").alias("window_start"))
        .withColumn("window_end", _window_end(F.col("window_start"), F.lit(last), grain))
    )


def window_rows(df: DataFrame, first: date, last: date) -> DataFrame:
    """One window's trips, ordered by pickup within each partition: no shuffle, as batches are read one by one."""
    return df.filter(within_days(F.col("pickup_datetime"), first, last)).sortWithinPartitions("pickup_datetime", *sorted(df.columns))


def days_of_month(df: DataFrame, first_day: int, last_day: int) -> DataFrame:
    return df.filter(F.dayofmonth("pickup_datetime").between(first_day, last_day))


def split_summary(df: DataFrame, settings: Settings) -> DataFrame:
    return (
        with_split(df, settings)
        .groupBy("split")
        .agg(
            F.count("*").alias("rows"),
            F.min("pickup_datetime").alias("min_pickup"),
            F.max("pickup_datetime").alias("max_pickup"),
        )
    )


def splits_are_disjoint(summary: DataFrame) -> bool:
    """True when no split starts before the previous one ends (three rows at most)."""
    spans = sorted((row.min_pickup, row.max_pickup) for row in summary.collect())
    return all(before[1] < after[0] for before, after in zip(spans, spans[1:]))
