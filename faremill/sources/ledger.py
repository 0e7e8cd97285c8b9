"""Ledger of model runs: one current row per model, appended run by run.

The versioned ledger keeps every append as a part of its own under a new version; of two writers at once the slower
one takes its turn on the newer version, so no run is lost. The CSV ledger is a plain file for reading elsewhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.sources import snapshots
from faremill.sources.audit import upsert

RUNS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("run", T.LongType()),
        T.StructField("sample_rows", T.LongType()),
        T.StructField("val_rmse", T.DoubleType()),
        T.StructField("test_rmse", T.DoubleType()),
        T.StructField("contract_version", T.StringType()),
    ]
)

#: A run with its circumstances, as the versioned ledger keeps it.
ENTRIES = T.StructType(
    [
        *RUNS,
        T.StructField("status", T.StringType()),
        T.StructField("training_strategy", T.StringType()),
        T.StructField("trip_types", T.StringType()),
        T.StructField("trip_type_weights", T.StringType()),
        T.StructField("zone_lookup_enabled", T.BooleanType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)


def append_entries(entries: DataFrame, root: str) -> int:
    """Add runs to the versioned ledger; returns the version that first has them."""
    spark = entries.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    entries.select(*ENTRIES.fieldNames()).write.parquet(f"{root}/{folder}")
    return snapshots.change(spark, root, lambda parts: {**parts, folder: folder})


def read_entries(spark: SparkSession, root: str) -> DataFrame:
    """All runs of the newest version."""
    _, parts = snapshots.latest(spark, root)
    if not parts:
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(*[f"{root}/{folder}" for folder in sorted(parts.values())])


def current_entries(entries: DataFrame) -> DataFrame:
    """The last run of every model, best validation error first."""
    return upsert(entries.limit(0), entries, "model", "run").orderBy("val_rmse")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists_csv(spark, path):
        return spark.createDataFrame([], RUNS)
    return spark.read.schema(RUNS).option("header", "true").option("mode", "FAILFAST").csv(path)


def table_exists_csv(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def append_runs(runs: DataFrame, path: str) -> None:
    runs.select(*RUNS.fieldNames()).write.mode("append").option("header", "true").csv(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of every model, best validation error first."""
    return upsert(runs.limit(0), runs, "model", "run").orderBy("val_rmse")


def is_recorded(runs: DataFrame, model: str) -> bool:
    return not runs.filter(F.col("model") == model).isEmpty()
