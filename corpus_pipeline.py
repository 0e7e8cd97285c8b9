"""The corpus pipeline: documents to a deduplicated, mixed and tokenised corpus.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``. Null and empty texts,
ties, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import bpe, language, lines, mixing, near_dedup
from faremill.llm.common import bounded_batches, held_out, table
from faremill.llm.queries import MIX_WEIGHTS, TOKENIZER
from faremill.session import cut_lineage

LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language; those without a letter, or of no language by half the probability, go."""
    model = language.train(docs.filter(~held_out(F.col("doc_id"))))
    made = docs.withColumn("_made", language.predict(spark, model, F.col("text")))
    sure = (F.col("_made.lang_pred") != language.UNKNOWN) & (F.col("_made.score") >= LEAST_SCORE)
    return made.filter(sure).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier text or line has; ``n_chars`` follows the text."""
    cut = lines.without_repeats(docs)
    return cut.select(*[F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    mixed = mixing.mix(docs, MIX_WEIGHTS).filter("repeats > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "repeats"))).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text they decode to."""
    bounded_batches(spark)
    both = bpe.encode_decode(F.col("text"), TOKENIZER)
    made = docs.select("doc_id", "lang", "source", both.alias("made"))
    return made.select("doc_id", "lang", "source", F.size("made.ids").cast("bigint").alias("n_tokens"), "made.ids", "made.decoded")


#: The stages in order.
STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated lines", drop_repeated_lines),
    ("source mixing", mix_sources),
    ("BPE encoding", tokenise),
]

#: SQL cannot express the aligned similarity of near duplicates nor the classifier; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
