"""What the operators share: tables, held-out rows, document keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.session import BATCH_BYTES, bounded_batches  # noqa: F401  the operators take them from here

HELD_OUT_OF = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder by five; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == 0


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def document_key(doc_id: Column, text: Column) -> Column:
    """A digest of id and text: rows that repeat both are one document to every operator."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), text_or_empty(text)))


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores before it until no given column has it."""
    lower = {one.lower() for one in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
