"""Exact removal of long repeated byte strings by sorted suffixes.

A byte goes if a ``LENGTH``-byte string that covers it also starts somewhere else, in the same text or in another.

1. Sieve. Every ``LENGTH``-byte string holds a least ``GRAM``-byte string (by a rolling digest, the leftmost
   of equals). Equal strings have equal anchors, so only stretches of starts whose anchor occurs twice in the
   corpus can repeat; counting anchors is combined before the shuffle. No repeat is lost.
2. Regions. The bytes that such a stretch needs are cut out; equal regions are collapsed to one with a count, so a passage
   that millions of texts share is one row.
   The regions of an anchor that hold more than ``ANCHOR_BYTES`` are refined: a window that starts at most b and at least a
   bytes before its anchor holds the a bytes before it and the LENGTH - GRAM - b bytes behind it, so windows are dealt by the two halves of
   that range and by a digest of the bytes they must hold. Equal windows stay together, parts that stand alone go, and equal
   parts are collapsed; this goes on until every group fits. A range of one place leaves only equal windows, which are one row.
3. Suffixes. Regions are dealt to shards by anchor. The suffixes of a shard are sorted by external induced sorting with common-prefix
   values (``induced``): a start whose neighbour in that order shares ``LENGTH`` bytes with it repeats. A shard's regions
   are streamed to the task's own disk, where text and queues are, so a shard may be far larger than memory.
4. The covered runs go back to every occurrence of a region and are cut out of the texts.

Shards are sized by bytes; the regions of one anchor, or of one part of a refined anchor, stay together. Null and empty texts have no
bytes; texts shorter than ``LENGTH`` lose nothing. Rows that repeat id and text are two texts, which remove each other. Very long
texts are sieved in overlapping slices. Judged on the input, not on what is left.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm import induced
from faremill.llm.common import bounded_batches, free_name, text_or_empty
from faremill.llm.near_dedup import mix
from faremill.session import cut_lineage

LENGTH = 400
GRAM = 200
SLICE = 1 << 21
SHARD_BYTES = 4 << 20
ANCHOR_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 23) - 1)
_ROWS = 1 << 16


@functools.cache
def _powers(base: int) -> np.ndarray:
    powers = np.empty(SLICE + LENGTH + 1, np.uint64)
    powers[0], done = 1, 1
    step = np.uint64(base)
    while done < len(powers):
        more = min(done, len(powers) - done)
        powers[done : done + more] = powers[:more] * step
        done += more
        step = np.uint64(int(step) * int(step) & (1 << 64) - 1)
    return powers


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of starts with one anchor: first start, last start, place and digest of the anchor. ``data`` has LENGTH bytes at least."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE)[:n], out=sums[1:])
    count = n - GRAM + 1
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * _powers(pow(_BASE, -1, 1 << 64))[:count])
    width = LENGTH - GRAM + 1
    packed = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, np.uint64)
    packed[:count] = (grams & ~_PLACE) | np.arange(count, dtype=np.uint64)
    blocks = packed.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - LENGTH + 1
    place = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return first, np.r_[first[1:], starts] - 1, place[first], grams[place[first]].view(np.int64)


def _sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, firsts, lasts, places, anchors = [], [], [], [], []
        for row, one in enumerate(batch.column(2)):
            data = np.frombuffer(one.as_py(), np.uint8)
            for begin in range(0, len(data) - LENGTH + 1, SLICE):
                first, last, place, anchor = _anchors(data[begin : begin + SLICE + LENGTH - 1])
                rows.append(np.full(len(first), row))
                firsts.append(first + begin)
                lasts.append(last + begin)
                places.append(place + begin)
                anchors.append(anchor)
        if rows:
            take = pa.array(np.concatenate(rows))
            made = [pa.array(np.concatenate(x)) for x in (firsts, lasts, places, anchors)]
            names = ["k1", "k2", "first", "last", "place", "anchor"]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *made], names)


class _Shard:
    """The regions of one shard, in the order in which they come; their bytes go to the task's own disk beyond ``induced.IN_MEMORY``."""

    def __init__(self, shard: int):
        self.shard, self.regions, self.lengths, self.shared = shard, [], [], []
        self.data = tempfile.SpooledTemporaryFile(induced.IN_MEMORY)

    def add(self, rows: pa.RecordBatch) -> None:
        self.regions += rows["region"].to_pylist()
        self.shared += [n > 1 for n in rows["copies"].to_pylist()]
        for one in rows["bytes"]:
            self.lengths.append(self.data.write(one.as_buffer()))

    def covered(self) -> Iterator[pa.RecordBatch]:
        """Runs of bytes of every region that lie in a string of LENGTH bytes that starts twice."""
        count = len(self.lengths)
        # every region ends with a symbol of its own, the last one with 0
        text = induced.room(sum(self.lengths) + count, np.int32)
        at = 0
        self.data.seek(0)
        for i, length in enumerate(self.lengths, 1):
            np.add(np.frombuffer(self.data.read(length), np.uint8), np.int32(count), out=text[at : at + length])
            at += length + 1
            text[at - 1] = i % count
        places, common = induced.sorted_suffixes(text, count + 256, LENGTH)
        twice = induced.room(len(text), np.bool_)
        for begin in range(0, len(text), induced.BLOCK):
            slots = begin + np.flatnonzero(common[begin : begin + induced.BLOCK] >= LENGTH)
            twice[places[slots]] = True
            twice[places[slots - 1]] = True
        rows, begins, stops, at = [], [], [], 0
        for region, length, shared in zip(self.regions, self.lengths, self.shared, strict=True):
            if shared:
                rows.append(region)
                begins.append(0)
                stops.append(length)
            else:
                starts = np.flatnonzero(twice[at : at + length - LENGTH + 1])
                if len(starts):
                    gaps = np.flatnonzero(np.diff(starts) > LENGTH)
                    rows += [region] * (len(gaps) + 1)
                    begins += [int(starts[0]), *starts[gaps + 1].tolist()]
                    stops += [*(starts[gaps] + LENGTH).tolist(), int(starts[-1]) + LENGTH]
            at += length + 1
        for i in range(0, len(rows), _ROWS):
            made = [pa.array(rows[i : i + _ROWS], pa.string()), *(pa.array(x[i : i + _ROWS], pa.int64()) for x in (begins, stops))]
            yield pa.RecordBatch.from_arrays(made, ["region", "begin", "stop"])


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered runs, shard by shard; rows come sorted by shard."""
    now = None
    for batch in batches:
        shards = batch["shard"].to_numpy()
        edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for begin, stop in zip(edges[:-1], edges[1:], strict=True):
            if begin == stop:
                continue
            if now is None or now.shard != shards[begin]:
                if now is not None:
                    yield from now.covered()
                now = _Shard(shards[begin])
            now.add(batch.slice(begin, stop - begin))
    if now is not None:
        yield from now.covered()


def _keys(docs: DataFrame, text: str) -> list[Column]:
    return [F.xxhash64(F.col("doc_id"), F.lit("id")).alias("k1"), F.xxhash64(text_or_empty(F.col(text))).alias("k2")]


def _regions(docs: DataFrame, text: str) -> DataFrame:
    """(k1, k2, first, anchor, at, bytes, region) of the stretches whose anchor occurs twice; ``at`` is the anchor's place in the bytes."""
    data = text_or_empty(F.col(text)).cast("binary")
    keyed = docs.select(*_keys(docs, text), data.alias("bytes"))
    schema = "k1 long, k2 long, first long, last long, place long, anchor long"
    stretches = cut_lineage(keyed.mapInArrow(_sieve, schema))
    twice = stretches.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    held = stretches.join(cut_lineage(twice), "anchor")
    stretch = F.struct("first", "last", "place", "anchor")
    wanted = cut_lineage(held.groupBy("k1", "k2").agg(F.collect_set(stretch).alias("stretches")))  # of one text
    cut = keyed.join(wanted, ["k1", "k2"]).select("k1", "k2", "bytes", F.explode("stretches").alias("s"))
    size = (F.col("s.last") - F.col("s.first") + LENGTH).cast("int")
    piece = F.substring(F.col("bytes"), (F.col("s.first") + 1).cast("int"), size)
    at = (F.col("s.place") - F.col("s.first")).cast("int")
    regions = cut.select("k1", "k2", F.col("s.first").alias("first"), F.col("s.anchor").alias("anchor"), at.alias("at"), piece.alias("bytes"))
    return cut_lineage(regions.withColumn("region", F.md5("bytes")))


def _distinct(regions: DataFrame) -> DataFrame:
    alike = F.first("bytes").alias("bytes"), F.first("at").alias("at"), F.count("*").alias("copies")
    return cut_lineage(regions.groupBy("anchor", "region").agg(*alike))


def _halves(rows: DataFrame) -> DataFrame:
    """Parts of regions whose starts lie ``low`` to ``high`` bytes before the anchor, by the halves of that range."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.array(F.struct(F.col("low").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("high").alias("b")))
    halved = rows.withColumn("half", F.explode(both)).withColumns({"a": F.col("half.a"), "b": F.col("half.b")})
    farthest = F.least("b", "at")
    nearest = F.greatest(F.col("a"), F.col("at") - F.length("bytes") + LENGTH)
    placed = halved.withColumns({"far": farthest, "near": nearest}).filter("far >= near")
    skipped = F.col("at") - F.col("far")
    piece = F.substring(F.col("bytes"), skipped + 1, F.col("far") - F.col("near") + LENGTH)
    core = F.substring(F.col("bytes"), F.col("at") - F.col("a") + 1, F.col("a") - F.col("b") + LENGTH)
    return placed.select(
        F.xxhash64("anchor", F.md5(core), "a", "b").alias("anchor"),
        "region",
        (F.col("shift") + skipped).alias("shift"),
        piece.alias("bytes"),
        F.col("far").alias("at"),
        "copies",
        F.col("a").alias("low"),
        F.col("b").alias("high"),
    ).withColumn("part", F.md5("bytes"))


def _fitting(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups that fit, (anchor, part, bytes, copies), and where the parts lie, (region, part, shift)."""
    rows = distinct.withColumns(
        {"part": F.col("region"), "shift": F.lit(0), "low": F.lit(0), "high": F.lit(LENGTH - GRAM)}
    )
    parts, ready, places = rows, [], []
    while True:
        size = F.sum(F.length("bytes")).alias("size")
        sizes = parts.groupBy("anchor").agg(size, F.min("low").alias("low"), F.max("high").alias("high"))
        large = cut_lineage(sizes.filter((F.col("size") > ANCHOR_BYTES) & (F.col("low") < F.col("high"))).select("anchor"))
        last = large.isEmpty()
        fits, fit_rows = (x if last else x.join(large, "anchor", "left_anti") for x in (parts, rows))
        ready.append(fits.select("anchor", "part", "bytes", "copies"))
        places.append(fit_rows.select("region", "part", "shift"))
        if last:
            return functools.reduce(DataFrame.union, ready), functools.reduce(DataFrame.union, places)
        halves = cut_lineage(_halves(rows.join(large, "anchor")))
        shared = halves.groupBy("anchor").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor")
        rows = cut_lineage(halves.join(cut_lineage(shared), "anchor"))
        alike = F.first("bytes").alias("bytes"), F.sum("copies").alias("copies"), F.first("low").alias("low"), F.first("high").alias("high")
        parts = cut_lineage(rows.groupBy("anchor", "part").agg(*alike))


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, spans): byte runs (begin, stop) to remove from each text that has any; they may overlap."""
    regions = _regions(docs, text)
    groups, places = _fitting(_distinct(regions))
    total = groups.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    dealt = groups.withColumnRenamed("part", "region").withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard")
    found = dealt.mapInArrow(_covered, "region string, begin long, stop long").withColumnRenamed("region", "part")
    found = cut_lineage(found.distinct().groupBy("part").agg(F.collect_list(F.struct("begin", "stop")).alias("runs")))

    def moved(by: str) -> Column:
        return F.transform("runs", lambda r: F.struct((r["begin"] + F.col(by)).alias("begin"), (r["stop"] + F.col(by)).alias("stop")))

    whole = places.distinct().join(found, "part").select("region", moved("shift").alias("runs"))
    runs = cut_lineage(whole.groupBy("region").agg(F.flatten(F.collect_list("runs")).alias("runs")))
    # distinct: rows that repeat id and text have the same places
    hits = regions.select("k1", "k2", "first", "region").distinct().join(runs, "region")
    return hits.groupBy("k1", "k2").agg(F.flatten(F.collect_list(moved("first"))).alias("spans"))


def with_spans(docs: DataFrame, text: str = "text", made: str = "cut") -> DataFrame:
    """The rows of ``docs`` with a column ``made``: ``spans`` (null: nothing to remove), maximal runs of bytes in order, and ``kept``, the bytes left.

    ``made`` must not be a column of ``docs``; other names of our own give way to given ones.
    """
    bounded_batches(docs.sparkSession)
    one, two, raw, given = (free_name(name, docs.columns) for name in ("k1", "k2", "bytes", "given"))
    spans = cut_lineage(repeated_spans(docs, text)).select(F.col("k1").alias(one), F.col("k2").alias(two), F.col("spans").alias(given))
    k1, k2 = _keys(docs, text)
    keyed = docs.withColumns({one: k1, two: k2, raw: text_or_empty(F.col(text)).cast("binary")})
    joined = keyed.join(spans, [one, two], "left")

    @F.arrow_udf("spans array<struct<begin:bigint,stop:bigint>>, kept binary")
    def cut_out(texts: pa.Array, lists: pa.Array) -> pa.Array:
        kept, merged = [], []
        for whole, gone in zip(texts, lists, strict=True):
            data, left, at, runs = whole.as_py(), [], 0, []
            for begin, stop in sorted((g["begin"], g["stop"]) for g in gone.as_py() or []):
                if runs and begin <= runs[-1]["stop"]:
                    runs[-1]["stop"] = max(runs[-1]["stop"], stop)
                else:
                    runs.append({"begin": begin, "stop": stop})
            for run in runs:
                left.append(data[at : run["begin"]])
                at = run["stop"]
            kept.append(b"".join([*left, data[at:]]) if data is not None else None)
            merged.append(runs)
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(merged, kind), pa.array(kept, pa.binary())], ["spans", "kept"])

    # texts that lose nothing do not go to Python
    some = F.col(given).isNotNull()
    cut = F.when(some, cut_out(F.when(some, F.col(raw)), given))
    out = joined.select(*docs.columns, raw, cut.alias(given))
    return out.select(*docs.columns, F.struct(F.col(given)["spans"].alias("spans"), F.coalesce(F.col(given)["kept"], raw).alias("kept")).alias(made))
