"""The corpus queries: each operator over its whole table, with the columns its contract names."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm import (
    bpe,
    embed_dedup,
    hnsw,
    language,
    lexical,
    lines,
    mixing,
    near_dedup,
    periodic,
    sentence_pieces,
    suffix_dedup,
    toxicity,
    urls,
)
from faremill.llm.common import bounded_batches, held_out, table
from faremill.session import cut_lineage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LLM_QUERIES: dict[str, object] = {}


def registered(query):
    LLM_QUERIES[query.__name__] = query
    return query


@registered
def op1_bpe(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Digests of the token ids of every whole text and of the text they decode to."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        words = bpe.tokenizer(tokenizer)
        decimal = {number: str(number).encode() for number in words.tokens}
        rows: list[tuple[int, str, str]] = []
        for part in bpe.slices(texts):
            for raw in words.encode_batch(part):
                ids = np.frombuffer(raw, np.int32)
                written = b" ".join(map(decimal.__getitem__, ids.tolist()))
                decoded = words.decode_one(ids).encode()
                rows.append((len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        kinds = (pa.int64(), pa.string(), pa.string())
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    bounded_batches(spark)
    return table(spark, sf_dir, "documents").select("doc_id", digests("text").alias("made")).select("doc_id", "made.*")


#: Fixed values of the URL rules: verdict, host, start of the path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: The list of URLs to block: those of pages whose text says such a word, whatever their hosts.
LISTED_WORDS = r"(?i)(worthless|idiot|casino)"


@registered
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule and verdict; without a rule, pages with a listed canonical URL are blocked."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    flagged = table(spark, sf_dir, "pages").filter(F.col("html").rlike(LISTED_WORDS))
    listed = flagged.select(urls.canonical(F.col("url")).alias("canonical"))
    judged = urls.with_listed(pages, listed).select(
        "page_id", urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path"), "listed"
    )
    ruled = judged.withColumn("fits", urls.rule_for(F.col("host"), F.col("path"), URL_RULES))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "fits.rule", F.coalesce("fits.verdict", by_list).alias("verdict"))


MIX_WEIGHTS = (3.0, 1.0, 2.0)


@registered
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources are mixed 3:1:2 to 150 % of all words, two epochs at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, MIX_WEIGHTS).select(
        "doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken")
    )


@registered
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = language.train(docs.filter(~F.col("held_out")))
    made = docs.select("doc_id", "held_out", language.predict(spark, model, F.col("text")).alias("made"))
    return made.select("doc_id", "held_out", "made.lang_pred", "made.score")


@registered
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near duplicates of every document; one document of each group stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.groups(docs).select("doc_id", "group_id", "group_size", "kept")


@registered
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of every whole text: how many spans, where (character offsets), and the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = lines.with_repeats(docs)
    written = F.transform("repeats.removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    kept = F.coalesce("repeats.kept", F.lit(""))
    return cut.select(
        "doc_id",
        F.size("repeats.removed").cast("bigint").alias("n_removed"),
        F.array_join(written, ",").alias("removed"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
        kept.alias("text"),
    )


@registered
def op8_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


NEAREST, EVERY = 20, 20


@registered
def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found by inner product for every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    built = cut_lineage(hnsw.index(rows, NEAREST))
    return hnsw.search(built, rows.filter(F.col("vec_id") % EVERY == 0), NEAREST)


@registered
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.score(spark, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@registered
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every whole text that lie in a 400-byte string found elsewhere too, and what is left without them."""
    cut = suffix_dedup.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.length(F.coalesce("text", F.lit("")).cast("binary")).cast("bigint")
    return cut.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.length("cut.kept")).alias("n_removed"),
        F.coalesce(F.size("cut.spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.sha2("cut.kept", 256).alias("kept_sha256"),
        # a character that a span cuts in two is shown as U+FFFD
        F.make_valid_utf8(F.col("cut.kept").cast("string")).alias("text"),
    )


#: Every tenth document by the digest of its id is given a loop of words, so that the operator has runs of every period to find.
LOOPED_OF = 10


def looped(doc_id: Column, text: Column) -> Column:
    """The text with words in a loop where the id's crc32 leaves no remainder by ten (a null id counts as the empty text)."""

    @F.arrow_udf("string")
    def with_loop(texts: pa.Array, crcs: pa.Array) -> pa.Array:
        out: list[bytes | None] = []
        for one, crc in zip(texts, crcs, strict=True):
            words = periodic.split_words(one.as_py())
            if words:
                n, g = len(words), crc.as_py() // LOOPED_OF
                first = g % n
                period = 1 + (n - first) // (3 + g % 8)
                words[first:] = [words[first + i % period] for i in range(n - first)]
            out.append(b" ".join(words))
        return pa.array(out, pa.binary()).cast(pa.string())

    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    chosen = crc % LOOPED_OF == 0
    return F.when(chosen, with_loop(F.when(chosen, text), crc)).otherwise(text)


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every whole text, and the digest of the text without the repeated periods."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    made = docs.select("doc_id", periodic.runs(F.col("text")).alias("made")).select("doc_id", "made.*")
    written = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    # greatest length, then smallest start, then smallest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("period"))))
    return made.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-longest["before"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["period"]).alias("period"),
        F.floor(F.lit(1000) * longest["length"] / -longest["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", written).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@registered
def op12_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    """Digests of the piece ids of every whole text and of the text they decode to."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pa.Array) -> pa.Array:
        pieces = sentence_pieces.model(model)
        decimal = [str(number).encode() for number in range(pieces.size)]
        rows: list[tuple[int, str, str]] = []
        for part in bpe.slices(texts):
            for raw in pieces.encode_batch(part):
                ids = np.frombuffer(raw, np.int32)
                written = b",".join(map(decimal.__getitem__, ids.tolist()))
                decoded = pieces.decode_one(ids).encode()
                rows.append((len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        kinds = (pa.int64(), pa.string(), pa.string())
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])

    bounded_batches(spark)
    return table(spark, sf_dir, "documents").select("doc_id", digests("text").alias("made")).select("doc_id", "made.*")


FOUND_PER_ITEM = 50


@registered
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents of highest score for every benchmark item."""
    built = lexical.index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(built, table(spark, sf_dir, "benchmark").select("item_id", "text"), FOUND_PER_ITEM)
