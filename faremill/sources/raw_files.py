"""Monthly trip files into the raw layer.

A file is ``{fleet}_tripdata_YYYY-MM.parquet``, either a single file or a folder of part files.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.contract import RAW_SCHEMAS
from faremill.functions.trip import month_of_file
from faremill.session import cut_lineage
from faremill.sources import audit, catalogue
from faremill.sources.catalogue import file_of
from faremill.sources.tables import replace_partitions

def named_files(paths: DataFrame) -> DataFrame:
    """``path`` of part or whole files to ``file_name``, ``trip_type``, ``period_label``, ``local_path``."""
    named = paths.select(
        file_of(F.col("path")).alias("file_name"),
        F.regexp_extract("path", r"^(.*?[a-z]+_tripdata_\d{4}-\d{2}\.parquet)", 1).alias("local_path"),
    )
    return (
        named.filter(F.col("file_name") != "")
        .distinct()
        .withColumn("trip_type", F.regexp_extract("file_name", r"^([a-z]+)_", 1))
        .withColumn("period_label", month_of_file(F.col("file_name")))
    )


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """The trip files under a folder. Only the listing is used; no contents are read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(landing)
    )
    return named_files(listing.select("path"))


def _fitted(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The target columns, matched by name whatever the case, and cast to the target type."""
    present = {field.name.lower(): field for field in df.schema}
    out = []
    for field in schema:
        found = present.get(field.name)
        if found is None:
            value = F.lit(None)
        elif isinstance(field.dataType, T.LongType) and isinstance(found.dataType, (T.DoubleType, T.FloatType)):
            value = F.round(F.col(found.name))
        else:
            value = F.col(found.name)
        out.append(value.cast(field.dataType).alias(field.name))
    return out


def read_trip_files(spark: SparkSession, paths: Sequence[str], fleet: str, files: DataFrame | None = None) -> DataFrame:
    """Files of one fleet in the raw schema, with ``file_name``; any unreadable file is an error.

    Published months differ in column case and in integer or floating types, and so may the part files of one month,
    which one scan cannot reconcile: there is one scan for each physical schema in the catalogue ``files``
    (``catalogue.footers`` of the paths, read here if it is not given).
    """
    by_schema: dict[str, list[str]] = defaultdict(list)
    for row in catalogue.scans(catalogue.footers(spark, paths) if files is None else files).collect():
        by_schema[row["schema"]].append(row["path"])
    if not by_schema:
        raise ValueError(f"no part files in {', '.join(paths)}")
    frames = []
    for same in by_schema.values():
        files = spark.read.option("ignoreCorruptFiles", "false").parquet(*same)
        name = file_of(F.col("_metadata.file_path")).alias("file_name")
        frames.append(files.select(*_fitted(files, RAW_SCHEMAS[fleet]), name))
    return reduce(DataFrame.unionByName, frames)


def load_listed(
    spark: SparkSession, files: Sequence[Row], raw_path: str, audit_path: str, fleet: str
) -> None:
    """Load whole files into the raw table and note them in the audit.

    A file fills exactly one month of the raw table, so loading it twice, or again after a job
    that died before it wrote its audit, replaces the month instead of doubling it. Trips are read once: the
    rows of a file are those that its footers state.
    """
    paths = [row["local_path"] for row in files]
    parts = cut_lineage(catalogue.footers(spark, paths))
    trips = read_trip_files(spark, paths, fleet, parts)
    month = month_of_file(F.col("file_name")).alias("period_label")
    replace_partitions(trips.select("*", month).drop("file_name"), raw_path, ["period_label"])

    counts = parts.groupBy("file_name").agg(F.sum("rows").alias("rows_loaded"))
    events = spark.createDataFrame(files).join(counts, "file_name", "left").select(
        "file_name",
        "trip_type",
        "period_label",
        "local_path",
        F.lit(audit.COPIED).alias("copy_status"),
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        F.current_timestamp().alias("loaded_at"),
    )
    audit.record(events, audit_path)


def load_trip_files(
    spark: SparkSession, landing: str, raw_path: str, audit_path: str, fleet: str, again: bool = False
) -> list[str]:
    """Load the landed files of a fleet that are not loaded yet (``again``: all); returns their names."""
    files = landed_files(spark, landing).filter(F.col("trip_type") == fleet)
    if not again:
        files = audit.not_yet_loaded(files, audit.current_audit(spark, audit_path))
    todo = files.collect()  # one row per calendar month at most
    if todo:
        load_listed(spark, todo, raw_path, audit_path, fleet)
    return sorted(row["file_name"] for row in todo)


def read_raw(spark: SparkSession, raw_path: str, fleet: str) -> DataFrame:
    return spark.read.schema(T.StructType([*RAW_SCHEMAS[fleet], T.StructField("period_label", T.StringType())])).parquet(
        raw_path
    )
