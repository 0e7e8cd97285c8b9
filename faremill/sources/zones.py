"""The zone dimension from its CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faremill.contract import ZONES


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header. "N/A" and "Unknown" are names here, not missing values."""
    return (
        spark.read.schema(ZONES)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .option("enforceSchema", "true")
        .csv(path)
    )
