"""Dense ids for the values of columns, however many there are.

Distinct values are dealt by range, so every task numbers its own run of them; what the runs before it hold is added as an offset.
The dictionary is a table that is joined: no column's values meet in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.session import cut_lineage


def dense_ids(values: DataFrame, parts: int | None = None) -> DataFrame:
    """``values`` (column, value, ...), each pair once, with ``id``: the place of the value among its column's, from 0.

    ``parts`` is the number of runs (the session's shuffle partitions). Only one count for each run and column is gathered.
    """
    parts = parts or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = values.repartitionByRange(parts, "column", "value").withColumn("run", F.spark_partition_id())
    ranged = cut_lineage(ranged)  # the number of a run must not change between the two reads
    runs = ranged.groupBy("column", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("column").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("column", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("column", "run").orderBy("value"))
    numbered = ranged.withColumn("place", place).join(offsets, ["column", "run"])
    return numbered.withColumn("id", F.col("offset") + F.col("place") - 1).drop("run", "place", "offset")


def with_ids(rows: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_id`` beside each column: null for a value that the dictionary does not have."""
    for name in columns:
        known = dictionary.filter(F.col("column") == name).select(F.col("value").alias(f"{name}_value"), F.col("id").alias(f"{name}_id"))
        rows = rows.join(known, F.col(name).cast("string") == F.col(f"{name}_value"), "left").drop(f"{name}_value")
    return rows
