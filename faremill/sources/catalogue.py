"""A catalogue of part files, read from their footers inside tasks.

One row a part file: the month's file it belongs to, its physical schema, its rows, and the span of its pickup times as the row
groups' statistics give it. No data page is opened and no footer passes through the driver. Loads take scans by
schema and row counts from it; with ``within``, files that lie outside a date range are not opened at all.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from datetime import date, datetime, time, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTERS = "path string, file_name string, schema string, rows bigint, first_pickup timestamp_ntz, last_pickup timestamp_ntz"
_NAME = r"([a-z]+_tripdata_\d{4}-\d{2}\.parquet)"
_PICKUPS = ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime")


def file_of(path: Column) -> Column:
    """Name of the month's file that a path is, or is a part of."""
    return F.regexp_extract(path, _NAME, 1)


def _open(path: str) -> pq.ParquetFile:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pq.ParquetFile("/" + rest.lstrip("/"))
    files, where = fs.FileSystem.from_uri("s3:" + rest if scheme in ("s3a", "s3n") else path)
    return pq.ParquetFile(files.open_input_file(where))


def _pickup_span(footer: pq.FileMetaData) -> tuple[datetime | None, datetime | None]:
    """Least and greatest pickup time; both unknown unless every row group with rows has statistics."""
    names = [footer.schema.column(i).path.lower() for i in range(footer.num_columns)]
    at = next((names.index(name) for name in _PICKUPS if name in names), None)
    if at is None:
        return None, None
    found = []
    for group in (footer.row_group(i) for i in range(footer.num_row_groups)):
        statistics = group.column(at).statistics
        if group.num_rows and statistics is not None and statistics.null_count == group.num_rows:
            continue
        if group.num_rows:
            if statistics is None or not statistics.has_min_max or not isinstance(statistics.min, datetime):
                return None, None
            found.append((statistics.min.replace(tzinfo=None), statistics.max.replace(tzinfo=None)))
    return (min(low for low, _ in found), max(high for _, high in found)) if found else (None, None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schemas, rows, firsts, lasts = [], [], [], []
        for path in batch.column(0).to_pylist():
            with _open(path) as file:
                schemas.append(json.dumps([[field.name, str(field.type)] for field in file.schema_arrow]))
                rows.append(file.metadata.num_rows)
                first, last = _pickup_span(file.metadata)
            firsts.append(first)
            lasts.append(last)
        made = [pa.array(schemas, pa.string()), pa.array(rows, pa.int64())]
        made += [pa.array(times, pa.timestamp("us")) for times in (firsts, lasts)]
        names = ["path", "file_name", "schema", "rows", "first_pickup", "last_pickup"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names)


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The catalogue of the part files in ``paths`` (files or folders of part files); an unreadable file is an error."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    parts = listing.load(list(paths)).select("path", file_of(F.col("path")).alias("file_name"))
    return parts.mapInArrow(_read, FOOTERS)


def scans(files: DataFrame) -> DataFrame:
    """(schema, path) to read: a month whose parts agree is one folder, the parts of any other month stand alone."""
    folder = F.regexp_extract("path", r"^(.*?[a-z]+_tripdata_\d{4}-\d{2}\.parquet)", 1)
    months = files.withColumn("folder", folder)
    kinds = months.groupBy("folder").agg(F.min("schema").alias("least"), F.max("schema").alias("greatest"))
    mixed = F.col("least") != F.col("greatest")
    return months.join(kinds, "folder").select("schema", F.when(mixed, F.col("path")).otherwise(F.col("folder")).alias("path")).distinct()


def within(files: DataFrame, first: date, last: date) -> DataFrame:
    """The files that may hold pickups of the days from ``first`` to ``last``; a file of unknown span stays."""
    begin, end = datetime.combine(first, time()), datetime.combine(last + timedelta(days=1), time())
    outside = (F.col("last_pickup") < F.lit(begin).cast("timestamp_ntz")) | (F.col("first_pickup") >= F.lit(end).cast("timestamp_ntz"))
    return files.filter(~F.coalesce(outside, F.lit(False)))
