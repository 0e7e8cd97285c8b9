"""URL filters: host and path rules, and a blocked Bloom filter of listed canonical URLs.

Listed URLs are put into a blocked Bloom filter kept as a table: one row for each block of 512 bits
(eight 64-bit words), every URL setting one bit in each word of a single block. It has ``BITS_EACH`` bits a URL and at most
``MAX_BLOCKS`` blocks (9 MB), so it is sent to every executor whatever the size of the list, and pages are tested where they are read.
Pages whose eight bits are not all set are not listed. Only the others, possible hits, go to an exact join with the listed canonical
URLs, which removes the false positives: about one page in several hundred, more where the list outgrows the largest filter.
All of it is DataFrame expressions.

The canonical form: host in lower case without a leading ``www.`` or ``m.`` and default port; path without
a trailing slash; the fragment and tracking parameters (utm_*, ref) dropped and the rest sorted.
Null URLs, empty ones and URLs without ``://`` have an empty host and path and never hit; very long ones are read whole. Repeated rows are each judged.
An empty list lists nothing, empty pages give no rows. Names of our own give way to those of given columns; ``listed`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import free_name
from faremill.session import cut_lineage

BITS_EACH = 16
WORDS = 8
MAX_BLOCKS = 1 << 17
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The canonical URL; null where there is no host."""
    name = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)$", ""), r"^(www|m)\.", "")
    query = F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|ref)(=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(name != "", F.concat(name, F.regexp_replace(path(url), r"/+$", ""), tail))


def rule_for(hosts: Column, paths: Column, rules: list[tuple[str, str, str]]) -> Column:
    """A struct (rule, verdict) of the longest rule (verdict, host, path) that fits; null if none does."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((hosts == name) | hosts.endswith(f".{name}")) & paths.startswith(start)
        chosen = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _bits(url: Column) -> list[Column]:
    """The bit that a URL sets in each word of its block."""
    mixed = F.xxhash64(url, F.lit("bits"))
    return [F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_blocks(listed: DataFrame, blocks: int, url: str = "canonical") -> DataFrame:
    """The filter as a table (block, w0..w7) of the non-empty blocks of ``blocks``."""
    one = F.lit(1).cast("bigint")
    words = [F.call_function("shiftleft", one, bit).alias(f"w{i}") for i, bit in enumerate(_bits(F.col(url)))]
    placed = listed.filter(F.col(url).isNotNull()).select(_block(F.col(url), blocks).alias("block"), *words)
    return placed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible_hits(rows: DataFrame, listed: DataFrame, url: str, made: str) -> DataFrame:
    """``rows`` with a column ``made``: false where the filter of the distinct ``listed`` says that ``url`` is not in it."""
    needed = -(-listed.count() * BITS_EACH // (64 * WORDS)) or 1
    blocks = min(needed, MAX_BLOCKS)
    taken = [*rows.columns, made]
    key = free_name("block", taken)
    words = [free_name(f"w{i}", taken) for i in range(WORDS)]
    table = cut_lineage(bloom_blocks(listed, blocks))
    probe = table.select(F.col("block").alias(key), *[F.col(f"w{i}").alias(word) for i, word in enumerate(words)])
    one, hit = F.lit(1).cast("bigint"), F.col(url).isNotNull()
    for word, bit in zip(words, _bits(F.col(url)), strict=True):
        hit = hit & (F.col(word).bitwiseAND(F.call_function("shiftleft", one, bit)) != 0)
    # at most MAX_BLOCKS rows of nine numbers
    tested = rows.withColumn(key, _block(F.col(url), blocks)).join(F.broadcast(probe), key, "left")
    return tested.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(made))


def with_listed(pages: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with a column ``listed``: whether the canonical URL is in ``listed`` (column ``canonical``)."""
    kept = [name for name in pages.columns if name.lower() != "listed"]
    key, possible = free_name("canonical_url", pages.columns), free_name("possible", pages.columns)
    distinct = cut_lineage(listed.select(F.col("canonical").alias(key)).filter(F.col(key).isNotNull()).distinct())
    rows = pages.select(*kept).withColumn(key, canonical(F.col(url)))
    tested = possible_hits(rows, distinct.withColumnRenamed(key, "canonical"), key, possible)
    others = tested.filter(~F.col(possible)).select(*kept, F.lit(False).alias("listed"))
    exact = distinct.withColumn("listed", F.lit(True))
    hits = tested.filter(possible).join(exact, key, "left")
    return others.union(hits.select(*kept, F.coalesce("listed", F.lit(False)).alias("listed")))
