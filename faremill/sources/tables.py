"""Writing layers as tables and probing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace a table from a query that does not read the same table."""
    spark = df.sparkSession
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


def replace_observed(df: DataFrame, path: str, partition_by: Sequence[str], metrics: Sequence[Column]) -> tuple[DataFrame, dict[str, object]]:
    """``replace_table`` with aggregates over the rows, taken while they are written: no further read.

    The rows must come without a shuffle or limit after the observed point, as each written row is then counted once,
    whichever tasks are tried again.
    """
    seen = Observation()
    return replace_table(df.observe(seen, *metrics), path, partition_by), seen.get


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write the partitions that occur in ``df`` and leave the others: a repeated load changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        return len(spark.read.parquet(path).columns) > 0
    except AnalysisException:
        return False


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def table_counts(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, int | None]:
    """Rows per table, None for one that is missing (counts come from the file footers)."""
    return {
        name: spark.read.parquet(path).count() if table_exists(spark, path) else None
        for name, path in tables.items()
    }
