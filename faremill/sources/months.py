"""Monthly file names of a date window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.settings import Settings


def file_name(fleet: Column, month: Column) -> Column:
    return F.format_string("%s_tripdata_%s.parquet", fleet, F.date_format(month, "yyyy-MM"))


def month_files(spark: SparkSession, settings: Settings) -> DataFrame:
    """One row per enabled fleet and calendar month touched by the window."""
    first, last = F.lit(settings.data_start), F.lit(settings.data_end)
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    listed = spark.range(1).select(
        F.explode(F.array(*[F.lit(fleet) for fleet in settings.fleets])).alias("trip_type"),
        months.alias("months"),
    )
    listed = listed.select("trip_type", F.explode("months").alias("month"))
    return listed.select(
        "trip_type",
        F.date_format("month", "yyyy-MM").alias("period_label"),
        file_name(F.col("trip_type"), F.col("month")).alias("file_name"),
    )
