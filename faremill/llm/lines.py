"""Substring deduplication by hashing lines and the pieces of lines.

A unit is a line of a text, cut further after anchor words: those whose own digest begins with a small byte (about one word in
eleven) and those of more than LONG_WORD characters. Anchors depend on the words alone, so a passage is cut alike wherever it stands,
also where it begins and ends inside a line. Words are runs without white space, and end after full stops and
commas of unspaced scripts, whose clauses so count as words.

What is compared are windows: from every unit on, and back from the end of every line, the fewest consecutive units of at
least LEAST_CHARS characters, words lower-cased and joined by one space. Windows are grouped by digest over the whole corpus, short units so take part beside
others and never alone. The occurrence with the smallest rank - (null id last, doc_id, digest of the text, number of the first unit) - stays;
a unit goes if a later occurrence covers it. Every unit that goes has an equal one of smaller rank, so by that order one of them stays:
nothing is lost altogether. A passage keeps its words before its first border and some behind its last one.

Spans removed are character offsets of the original text: from the first word to the next word that stays, but a line break after
a span that began inside a line stays.

Counting by digest is combined before the shuffle, and the join back to the occurrences is an ordinary
equi-join that the adaptive planner splits where one window is very common.

Null texts count as empty and stay null. A text may lose all its units and become empty; its row stays.
Repeated windows within one text count as occurrences. Rows that repeat id and text are one document and lose
the same units. Columns besides id and text pass through; names of our own give way to given ones. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, document_key, free_name, text_or_empty
from faremill.session import cut_lineage

LEAST_CHARS = 120
#: Words whose md5 begins with a smaller byte end a unit, and so do longer words.
ANCHOR_BELOW = 24
LONG_WORD = 24
_GAP = "\x09-\x0d\x20\xa0　"
_STOPS = "。！？，、"
_WORD = re.compile(f"([^{_GAP}{_STOPS}]+[{_STOPS}]*|[{_STOPS}]+)([{_GAP}]*)")
_KNOWN_WORDS = 200_000
_anchors: dict[str, bool] = {}


def _anchor(word: str) -> bool:
    """Whether a lower-cased word ends a unit; digests of the latest words are kept."""
    known = _anchors.get(word)
    if known is None:
        if len(_anchors) >= _KNOWN_WORDS:
            _anchors.clear()
        known = len(word) > LONG_WORD or hashlib.md5(word.encode("utf-8", "surrogatepass")).digest()[0] < ANCHOR_BELOW
        _anchors[word] = known
    return known


class Units:
    """The units of a text: characters [start, stop) of each, the place of the next word, and the normalised words."""

    def __init__(self, text: str):
        self.start, self.stop, self.next, self.opens, self.breaks, self.size, self.norm = [], [], [], [], [], [], []
        words: list[str] = []
        size, opens = 0, True
        for found in _WORD.finditer(text):
            if not words:
                self.start.append(found.start())
                self.opens.append(opens)
            word, gap = found.group(1), found.group(2)
            lower = word.lower()
            words.append(lower)
            size += len(word) + 1
            opens = "\n" in gap
            if opens or _anchor(lower) or found.end() == len(text):
                self.stop.append(found.end(1))
                self.next.append(found.end())
                self.breaks.append(opens)
                self.size.append(size)
                self.norm.append(" ".join(words))
                words, size = [], 0

    def windows(self, least: int) -> Iterator[tuple[int, int, bytes]]:
        """(first unit, last unit, digest) of the shortest windows of ``least`` characters from every unit on, and up to the ends of lines."""
        ends = np.cumsum(self.size)
        begins = ends - self.size
        found = set(enumerate(np.searchsorted(ends, begins + least).tolist()))
        closing = [nth for nth, breaks in enumerate(self.breaks) if breaks or nth == len(ends) - 1]
        found.update(zip((np.searchsorted(begins, ends[closing] - least, "right") - 1).tolist(), closing, strict=True))
        for first, last in sorted(found):
            if first >= 0 and last < len(ends):
                words = " ".join(self.norm[first : last + 1])
                yield first, last, hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def spans(self, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The characters that go with units [first, last] of every range, in order."""
        edge = np.zeros(len(self.start) + 1, np.int64)
        for first, last in ranges:
            edge[first] += 1
            edge[last + 1] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        steps = np.diff(np.r_[0, gone, 0])
        out = []
        for first, behind in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist(), strict=True):
            last = behind - 1
            keeps_break = self.breaks[last] and not self.opens[first]
            out.append((self.start[first], self.stop[last] if keeps_break else self.next[last]))
        return out


def units(docs: DataFrame, text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """(key, doc_id, first, last, digest) of the windows of every text."""
    key = F.unhex(document_key(F.col("doc_id"), F.col(text)))
    rows = docs.select(key.alias("key"), "doc_id", text_or_empty(F.col(text)).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, firsts, lasts, digests = [], [], [], []
            for at, one in enumerate(batch.column(2)):
                for first, last, digest in Units(one.as_py()).windows(least):
                    row.append(at)
                    firsts.append(first)
                    lasts.append(last)
                    digests.append(digest)
            take = pa.array(row, pa.int64())
            columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], ["key", "doc_id", "first", "last", "digest"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(read, f"key binary, doc_id {kind}, first int, last int, digest binary")


def repeats(docs: DataFrame, text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """(key, ranges): the units to remove of each document, as an array of (first, last)."""
    found = cut_lineage(units(docs, text, least))
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key", "first")
    many = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(rank).alias("earliest")).filter("n > 1").drop("n")
    # written first: the join then has a shuffle of its own on either side, of which a hot digest's part is split
    both = found.drop("doc_id").join(cut_lineage(many), "digest")
    later = both.filter((F.col("earliest.key") != F.col("key")) | (F.col("earliest.first") != F.col("first")))
    ranges = later.select("key", F.struct("first", "last").alias("range"))
    return ranges.groupBy("key").agg(F.collect_set("range").alias("ranges"))  # units of one text


def _cut(text: Column, ranges: Column) -> Column:
    @F.arrow_udf("struct<removed:array<struct<start:int,stop:int>>,kept:string>")
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        removed, kept = [], []
        for one, gone in zip(texts, lists, strict=True):
            value, spans = one.as_py(), []
            if value is not None and gone.is_valid:
                spans = Units(value).spans([(r["first"], r["last"]) for r in gone.as_py()])
                borders = [0, *(place for span in spans for place in span), len(value)]
                value = "".join(value[a:b] for a, b in zip(borders[::2], borders[1::2], strict=True))
            removed.append([{"start": a, "stop": b} for a, b in spans])
            kept.append(value)
        places = pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
        return pa.StructArray.from_arrays([places, pa.array(kept, pa.string())], ["removed", "kept"])

    # texts without a repeat do not go to Python
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    return F.when(ranges.isNull(), F.struct(nothing.alias("removed"), text.alias("kept"))).otherwise(cut(F.when(ranges.isNotNull(), text), ranges))


def with_repeats(docs: DataFrame, text: str = "text", least: int = LEAST_CHARS, made: str = "repeats") -> DataFrame:
    """The rows of ``docs`` with a further column ``made``: the spans removed (start, stop), and the text that is kept.

    ``made`` must not be a column of ``docs``.
    """
    bounded_batches(docs.sparkSession)
    key, ranges = free_name("key", docs.columns), free_name("ranges", docs.columns)
    gone = cut_lineage(repeats(docs, text, least)).select(F.col("key").alias(key), F.col("ranges").alias(ranges))
    keyed = docs.withColumn(key, F.unhex(document_key(F.col("doc_id"), F.col(text))))
    return keyed.join(gone, key, "left").select(*docs.columns, _cut(F.col(text), F.col(ranges)).alias(made))


def without_repeats(docs: DataFrame, text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """The rows of ``docs`` with repeated units cut out of the text."""
    made = free_name("repeats", docs.columns)
    cut = with_repeats(docs, text, least, made)
    return cut.select(*[F.col(made)["kept"].alias(name) if name == text else F.col(name) for name in docs.columns])
