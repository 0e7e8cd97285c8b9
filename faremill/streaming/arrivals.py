"""File arrival as a stream that feeds the same raw table and audit as the batch load.

The stream carries only the paths of arrived files; its checkpoint remembers which were taken.
Every micro-batch loads the files it names as a whole, so a month that arrives in several part
files, or a batch that is run again after a failure, ends in the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faremill.sources.raw_files import load_listed, named_files

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_trip_files(
    spark: SparkSession, landing: str, raw_path: str, audit_path: str, checkpoint: str, fleet: str
) -> StreamingQuery:
    """Take in every file under the ``landing`` glob that is new since the last run, then stop."""
    arrived = spark.readStream.format("binaryFile").schema(_LISTING).load(landing).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        files = named_files(batch).filter(F.col("trip_type") == fleet).collect()  # one row per month
        if files:
            load_listed(batch.sparkSession, files, raw_path, audit_path, fleet)

    return (
        arrived.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
