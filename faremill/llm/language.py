"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of every labelled row inside the tasks; only one row of counts for each
language and slice of buckets leaves a task, and Spark adds them up. The model is a matrix of
log-probabilities (buckets x languages), whose size is bounded by ``MAX_LANGUAGES`` and broadcast.
Scoring gathers the matrix rows of a batch of texts and sums them text by text.

N-grams run over code points of the lower-cased text with one space at either end. A text that is null
or has no letter is ``und`` with score 0, and such rows are not learnt from. Null labels are not learnt from.
Without any labelled row every text is ``und``. Ties go to the language that sorts first. Very long
texts are read in pieces that overlap by two code points, so every n-gram of the whole text counts once, wherever the cuts are. Rows that
repeat a labelled text are learnt from each time, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SLICE = 1 << 10
SMOOTHING = 0.5
MAX_LANGUAGES = 1000
PIECE_CHARS = 1 << 19
UNKNOWN = "und"
_MIX = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray  # log-probability of each language
    weights: np.ndarray  # BUCKETS + 1 rows; the last is for n-grams across two texts and holds zeros


def _pieces(texts: pa.Array, languages: int = 1) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Text numbers, lower-cased pieces and the overlap at the beginning of each, about PIECE_CHARS characters at a time; fewer for many languages."""
    chars = min(PIECE_CHARS, max(1 << 12, 8 * PIECE_CHARS // languages))
    overlap = max(ORDERS) - 1
    rows: list[int] = []
    parts: list[str] = []
    skips: list[int] = []
    size = 0
    for row, one in enumerate(texts):
        text = f" {(one.as_py() or '').lower()} "
        for begin in range(0, len(text), chars):
            part = text[max(0, begin - overlap) : begin + chars]
            rows.append(row)
            parts.append(part)
            skips.append(min(begin, overlap))
            size += len(part)
            if size >= chars:
                yield rows, parts, skips
                rows, parts, skips, size = [], [], [], 0
    if rows:
        yield rows, parts, skips


def _buckets(parts: list[str], skips: list[int]) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """For each order the bucket at every code point; where pieces begin.

    The bucket is BUCKETS where the n-gram would cross a piece's end, or lies in the overlap with the piece before.
    """
    code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    stops = np.cumsum([len(part) for part in parts])
    starts = np.r_[0, stops[:-1]]
    skipped = np.array(skips)

    def by_order() -> Iterator[np.ndarray]:
        hashed = np.zeros(len(code), np.uint32)
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        for order in range(1, max(ORDERS) + 1):
            ahead = np.zeros(len(code), np.uint32)
            ahead[: len(code) - order + 1] = code[order - 1 :]
            hashed = (hashed ^ ahead) * _MIX
            hashed ^= hashed >> np.uint32(15)
            if order in ORDERS:
                bucket = ((hashed * _MIX) >> shift).astype(np.int32)
                for back in range(1, order):
                    bucket[np.maximum(stops - back, 0)] = BUCKETS
                # of the overlap only n-grams that end behind it are new
                for place in range(max(ORDERS) - order):
                    bucket[starts[skipped - order + 1 > place] + place] = BUCKETS
                yield bucket

    return by_order(), starts


def train(rows: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Fit on all rows with a label and a letter in the text."""
    bounded_batches(rows.sparkSession)
    used = rows.select(F.col(label).cast("string").alias("_label"), F.col(text).alias("_text")).filter(
        F.col("_label").isNotNull() & F.col("_text").rlike(r"\p{L}")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for numbers, parts, skips in _pieces(batch.column(1)):
                kinds = [labels[number] for number in numbers]
                names = sorted(set(kinds))
                if len(counts) + len(names) > 2 * MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
                kind = np.repeat([names.index(k) for k in kinds], [len(part) for part in parts])
                total = np.zeros(len(names) * (BUCKETS + 1), np.int64)
                for bucket in _buckets(parts, skips)[0]:
                    total += np.bincount(kind * (BUCKETS + 1) + bucket, minlength=len(total))
                for name, row in zip(names, total.reshape(len(names), -1), strict=True):
                    counts[name] = counts.get(name, 0) + row[:BUCKETS]
            for name in labels:
                seen[name] = seen.get(name, 0) + 1
        for name, row in counts.items():
            for at in range(0, BUCKETS, SLICE):
                yield pa.RecordBatch.from_pydict(
                    {
                        "language": [name],
                        "slice": pa.array([at // SLICE], pa.int32()),
                        "texts": [seen[name] if at == 0 else 0],
                        "counts": pa.array([row[at : at + SLICE].tolist()], pa.list_(pa.int64())),
                    }
                )

    schema = "language string, slice int, texts long, counts array<long>"
    parts = used.mapInArrow(count, schema).select("language", "slice", "texts", F.posexplode("counts").alias("at", "n"))
    added = parts.groupBy("language", "slice", "at").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    # a row for each language and slice reaches the driver: at most MAX_LANGUAGES x BUCKETS counts, however many rows
    model_rows = (
        added.groupBy("language", "slice")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("counts"), F.max("texts").alias("texts"))
        .select("language", "slice", "texts", F.col("counts.n").alias("counts"))
        .toArrow()
    )
    languages = sorted(set(model_rows["language"].to_pylist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(languages), BUCKETS))
    texts = np.zeros(len(languages))
    # counts stay in Arrow and numpy: a Python object for each would not fit the driver
    values = model_rows["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, SLICE)
    at = np.searchsorted(languages, model_rows["language"].to_pylist())
    for row, (nth, part) in enumerate(zip(at.tolist(), model_rows["slice"].to_pylist(), strict=True)):
        counts[nth, part * SLICE : (part + 1) * SLICE] = values[row]
    np.add.at(texts, at, model_rows["texts"].to_numpy())
    smooth = counts + SMOOTHING
    weights = np.zeros((BUCKETS + 1, len(languages)), np.float32)
    weights[:BUCKETS] = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T
    return LanguageModel(languages, np.log((texts + 1) / (texts + 1).sum()), weights)


def predict(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """A struct of the most likely language and its posterior probability."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def posterior(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        n = len(fitted.languages)
        if not n:
            return pa.StructArray.from_arrays(
                [pa.array([UNKNOWN] * len(texts)), pa.array([0.0] * len(texts))], ["lang_pred", "score"]
            )
        total = np.tile(fitted.prior, (len(texts), 1))
        for rows, parts, skips in _pieces(texts, n):
            by_order, starts = _buckets(parts, skips)
            for bucket in by_order:
                sums = np.add.reduceat(fitted.weights[bucket], starts, axis=0, dtype=np.float64)
                np.add.at(total, rows, sums)
        total -= total.max(axis=1, keepdims=True)
        share = np.exp(total)
        share /= share.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        names = pa.array(fitted.languages, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(share[np.arange(len(best)), best])], ["lang_pred", "score"])

    made = posterior(text)
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(F.coalesce(text, F.lit("")).rlike(r"\p{L}"), made).otherwise(unknown)
