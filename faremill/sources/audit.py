"""The load audit: one current row per source file.

Loads are appended as events; the current row of a file is its latest event. Appending needs no
rewrite of the table that is being read, so a lost job cannot lose the audit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.contract import LOAD_AUDIT
from faremill.sources.tables import table_exists

COPIED = "COPIED"
STAGED_ONLY = "STAGED_ONLY"


def upsert(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of ``current`` with those of ``changes`` put in their place; the latest version wins."""
    rest = [name for name in current.columns if name != key]
    both = current.unionByName(changes)
    latest = both.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("latest"))
    return latest.select(key, "latest.*").select(*current.columns)


def load_events(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], LOAD_AUDIT)
    return spark.read.schema(LOAD_AUDIT).parquet(path)


def current_audit(spark: SparkSession, path: str) -> DataFrame:
    events = load_events(spark, path)
    return upsert(events.limit(0), events, "file_name", "loaded_at")


def record(events: DataFrame, path: str) -> None:
    events.select(*LOAD_AUDIT.fieldNames()).write.mode("append").parquet(path)


def not_yet_loaded(files: DataFrame, audit: DataFrame) -> DataFrame:
    """Files without a completed copy; one audit row per file, so the planner may broadcast it."""
    return files.join(audit.filter(F.col("copy_status") == COPIED), "file_name", "left_anti")
