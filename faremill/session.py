"""Local session for tests and benchmarks, and the shared scratch folder of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "faremill", **conf: object) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="faremill-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


#: For tables of rows of several MB each. Left alone, the writer looks at its buffers after a hundred rows at the earliest,
#: and a reader takes a whole row group at once; with these, a row group holds the rows of some 8 MB, or one larger row.
LARGE_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


#: For tables that are read many times over: tasks may be as small as 8 MB of the files.
SMALL_GROUPS = {"parquet.block.size": 8 << 20}
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of the batches that go to Python, where the session leaves them open: rows may be very large."""
    name, unset = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 30
    if int(spark.conf.get(name, str(2**31 - 1)).rstrip("b")) > unset:
        spark.conf.set(name, str(BATCH_BYTES))


def new_folder(spark: SparkSession, label: str) -> str:
    """A path for one run's output; never reused, so nothing is ever cleared."""
    return f"{shared_folder(spark)}/faremill/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, **options: object) -> DataFrame:
    """Write the rows to the shared folder and read them back, so a lost executor costs a re-read. ``options`` go to the writer."""
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
