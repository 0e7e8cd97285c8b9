"""Raw trips derived from the ``lineitem`` table, in the raw schema of each fleet."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.contract import RAW_SCHEMAS
from faremill.operators.canonical import canonical_trips
from faremill.operators.cleaning import staging
from faremill.operators.features import obt
from faremill.session import new_folder
from faremill.settings import Settings

SETTINGS = Settings(
    data_start=date(1995, 1, 1),
    train_end=date(1999, 12, 31),
    val_end=date(2000, 12, 31),
    data_end=date(2001, 12, 31),
)


def _nullable(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def trips_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order, part, nth = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber").cast("bigint")
    pickup = F.timestamp_add("SECOND", (order * 7919 + nth * 104729) % 86400, F.col("l_shipdate"))
    fare = (
        F.when(part % 83 == 0, F.lit(-5.0))
        .when(part % 79 == 0, F.lit(450.0))
        .otherwise(F.lit(2.5) + F.col("l_quantity") + F.col("l_extendedprice") / F.lit(10000.0))
    )
    trips = line.select(
        F.when(F.col("l_suppkey") % 10 == 0, "green").otherwise("yellow").alias("fleet"),
        (1 + nth % 2).alias("vendorid"),
        pickup.alias("pickup"),
        F.timestamp_add("SECOND", (part * 37 + nth * 11) % 3600 - 60, pickup).alias("dropoff"),
        _nullable(part % 71 == 0, nth).alias("passenger_count"),
        F.when(part % 97 == 0, F.lit(0.0))
        .when(part % 89 == 0, F.lit(200.0))
        .otherwise(F.col("l_quantity") * F.lit(0.4))
        .alias("trip_distance"),
        F.when(part % 67 == 0, F.lit(99).cast("bigint")).otherwise(1 + order % 6).alias("ratecodeid"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        _nullable(order % 61 == 0, 1 + part % 265).alias("pulocationid"),
        (1 + (part + order % 5) % 265).alias("dolocationid"),
        (1 + order % 4).alias("payment_type"),
        fare.alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_tax").alias("tax"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("airport_fee"),
        F.lit(None).cast("double").alias("ehail_fee"),
        F.lit("1").alias("trip_type"),
    )
    tip = F.col("tax") * F.col("fare_amount")
    charges = F.lit(0.5) + F.lit(0.5) + F.lit(0.0) + F.lit(0.3) + F.lit(2.5)
    return trips.withColumn("tip_amount", tip).withColumn(
        "total_amount", F.col("fare_amount") + F.col("tip_amount") + charges
    )


_written: dict[tuple[str, str], str] = {}
ROWS_PER_TASK = 1_000_000


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    """The raw layer as a table in the shared folder, written once per session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        trips = trips_from_lineitem(spark, sf_dir)
        # A file may hold all its rows in one row group, which one task reads: the rows are spread out
        # over tasks whose number grows with the rows, so no task sorts and writes the whole input.
        rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        workers = spark.sparkContext.defaultParallelism
        trips = trips.repartition(max(workers, -(-rows // ROWS_PER_TASK)))
        path = new_folder(spark, "raw")
        trips.write.partitionBy("fleet").parquet(path)
        _written[key] = path
    return _written[key]


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    path = raw_path(spark, sf_dir)
    frames = {}
    for fleet, prefix in (("yellow", "tpep"), ("green", "lpep")):
        trips = spark.read.parquet(f"{path}/fleet={fleet}").withColumnsRenamed(
            {"pickup": f"{prefix}_pickup_datetime", "dropoff": f"{prefix}_dropoff_datetime"}
        )
        frames[fleet] = trips.select(*RAW_SCHEMAS[fleet].fieldNames())
    return frames


def canonical(spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS) -> DataFrame:
    return canonical_trips(raw(spark, sf_dir), settings)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(canonical(spark, sf_dir), SETTINGS)


def obt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obt(staged(spark, sf_dir))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension: one zone per part, promotional ones being airports; trips use the first 265 ids."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(
        (F.col("p_partkey") + 1).cast("bigint").alias("location_id"),
        F.col("p_brand").alias("borough"),
        F.col("p_name").alias("zone"),
        F.when(F.col("p_type") == "PROMO", "Airports").otherwise(F.col("p_type")).alias("service_zone"),
    )


