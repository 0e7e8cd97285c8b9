"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is its sequence of five-word shingles (words: runs of letters, digits and underscores, in
lower case; a text of fewer words is one shingle). Shingles are labelled by how often they stood before
in the text, so repeats count. Each of ``SKETCHES`` sketches takes the ``MINIMA`` smallest labelled shingles under its own
hash and keeps their text order; equal sketches make two documents candidates. A candidate pair is a link
if the aligned similarity is at least ``SIMILARITY``: words matched in order, over words of either text. The alignment is
the longest common subsequence of words, sought only within the band of shifts that such a similarity allows.

Documents of the same words form one class, and only classes are compared. First, all classes of each bucket of
equal sketches are compared with its centre: the class whose sketches are shared most. Then every pair of
classes that shares a bucket and is not yet connected is verified, in the first sketch that it shares. For that, the members
of a bucket outside of its largest component are cut into blocks and compared with each other and with the
blocks of the largest component. Every pair of blocks is one unit of work, so no group is gathered in one task; a unit returns a
spanning forest of its links, not its pairs. Inside a unit, a pair whose classes are connected by then is passed over, and
common words are counted for many pairs at once before any is aligned.

Null and empty texts, and texts without a word, are never grouped. Rows that repeat id and text are one
document. A group's id is its smallest doc_id (a null id comes last); the row that stays is the first by id, then
digest of the text. An empty table gives no groups. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches, document_key, text_or_empty
from faremill.llm.components import components
from faremill.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 20
MINIMA = 3
BLOCK = 512
BLOCK_BYTES = 4 << 20
_WORD = re.compile(r"\w+")
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _P[1]
    x = (x ^ (x >> np.uint64(27))) * _P[2]
    return x ^ (x >> np.uint64(31))


_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _P[0])


def word_codes(text: str) -> np.ndarray:
    words = _WORD.findall(text.lower())
    return np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def labelled(digests: np.ndarray) -> np.ndarray:
    """Digests made distinct by the number of equal ones before them."""
    n = len(digests)
    order = np.argsort(digests, kind="stable")
    ordered = digests[order]
    at = np.arange(n)
    first = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]][:n], at, 0))
    nth = np.empty(n, np.uint64)
    nth[order] = (at - first).astype(np.uint64)
    return mix(digests + nth * _P[0])


def labelled_shingles(codes: np.ndarray) -> np.ndarray:
    """Digests of the shingles in text order, each made distinct by the number of equal ones before it."""
    n = max(1, len(codes) - SHINGLE + 1) if len(codes) else 0
    digests = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(codes))):
        digests = mix(digests + codes[i : i + n] + _P[0])
    return labelled(digests)


def sketch(labelled: np.ndarray) -> np.ndarray:
    """For each sketch the digest of its smallest labelled shingles, taken in text order."""
    values = mix(labelled[None, :] ^ _SEEDS[:, None])
    if values.shape[1] > MINIMA:
        at = np.sort(np.argpartition(values, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
        values = np.take_along_axis(values, at, axis=1)
    key = _SEEDS.copy()
    for i in range(values.shape[1]):
        key = mix(key + values[:, i] + _P[0])
    return key


def banded_matches(left: np.ndarray, right: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence over matches that are shifted by ``band`` places at most.

    One bit a place of ``right``, cleared where a match makes the subsequence longer; a whole row of the table is one
    addition of long integers. Rows go in blocks of ``band``, and only the places that a block can reach are held.
    """
    step = max(band, 64)
    places = right.tolist()
    found, begin, stop, row = 0, 0, 0, 0
    for at in range(0, len(left), step):
        low, high = max(0, at - band), min(len(places), at + step + band)
        if low >= high:
            break
        dropped = low - begin
        found += dropped - (row & ((1 << dropped) - 1)).bit_count()
        row = (row >> dropped) | (((1 << (high - stop)) - 1) << (stop - low))
        begin, stop = low, high
        where: dict[int, int] = {}
        for place in range(low, high):
            where[places[place]] = where.get(places[place], 0) | (1 << (place - low))
        held = (1 << (high - low)) - 1
        for code in left[at : at + step].tolist():
            met = row & where.get(code, 0)
            if met:
                row = ((row + met) | (row - met)) & held
    return found + (stop - begin) - row.bit_count()


def aligned_similarity(left: np.ndarray, right: np.ndarray, at_least: float = SIMILARITY) -> float:
    """Words matched in order over words of either text; 0 where ``at_least`` is out of reach.

    With similarity s, at most (1 - s) / (1 + s) of all words are unmatched, which bounds the shift of any match: the band.
    Equal beginnings and ends are matched first, which no alignment can better.
    """
    total, shorter = len(left) + len(right), min(len(left), len(right))
    need = at_least / (1 + at_least) * total
    if not shorter or shorter < need - 1e-9:
        return 0.0
    differs = np.flatnonzero(left[:shorter] != right[:shorter])
    head = int(differs[0]) if len(differs) else shorter
    left, right, shorter = left[head:], right[head:], shorter - head
    differs = np.flatnonzero(left[::-1][:shorter] != right[::-1][:shorter])
    tail = int(differs[0]) if len(differs) else shorter
    left, right = left[: len(left) - tail], right[: len(right) - tail]
    matched = head + tail
    if len(left) and len(right):
        matched += banded_matches(left, right, int(total - 2 * need + 1e-9))
    return matched / (total - matched) if matched >= need - 1e-9 else 0.0


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, key, class, sketch) of every row; class and sketch are null for texts without a word."""
    rows = docs.select("doc_id", document_key(F.col("doc_id"), F.col(text)).alias("key"), text_or_empty(F.col(text)).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes: list[bytes | None] = []
            sketches: list[list[int] | None] = []
            for one in batch.column(2):
                codes = word_codes(one.as_py())
                classes.append(hashlib.blake2b(codes.tobytes(), digest_size=16).digest() if len(codes) else None)
                sketches.append(sketch(labelled_shingles(codes)).view(np.int64).tolist() if len(codes) else None)
            made = [pa.array(classes, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "key", "class", "sketch"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(read, f"doc_id {kind}, key string, class binary, sketch array<bigint>")


def _word_table(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(class, words) of the classes in ``wanted`` (class, key); words as bytes of 32-bit codes."""
    keyed = docs.select(document_key(F.col("doc_id"), F.col(text)).alias("key"), text_or_empty(F.col(text)).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [word_codes(one.as_py()).astype(np.uint32).tobytes() for one in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["class", "words"])

    chosen = keyed.join(wanted, "key").select("class", "text").mapInArrow(read, "class binary, words binary")
    return chosen.groupBy("class").agg(F.first("words").alias("words"))  # rows that repeat id and text


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) whose aligned similarity reaches the threshold."""
    left = words.select(F.col("class").alias("a"), F.col("words").alias("left"))
    right = words.select(F.col("class").alias("b"), F.col("words").alias("right"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                aligned_similarity(np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32)) >= SIMILARITY
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(check, "a binary, b binary")


def _pairs(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Distinct pairs of members with the new centre of their bucket, beyond the centre's component."""
    met = members.join(centres, "bucket").filter(F.col("component") != F.col("centre.component"))
    return met.select(F.col("class").alias("a"), F.col("centre.class").alias("b")).distinct()


def _unit_links(bucket: int, sides: np.ndarray, both: bool, labels: np.ndarray, keys: np.ndarray, texts: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links in a unit, beyond ``labels``; pairs of one side count only with ``both``."""
    sizes = np.array([len(x) for x in texts])
    begins = np.cumsum(sizes) - sizes
    # words labelled by occurrence: no alignment matches more of them than two texts share
    kinds, inverse = np.unique(np.concatenate([labelled(x.astype(np.uint64)) for x in texts]), return_inverse=True)
    share = SIMILARITY / (1 + SIMILARITY)
    component = np.unique(labels, return_inverse=True)[1]
    within, out = np.zeros(len(kinds), bool), []
    for x in range(len(texts) - 1):
        y = np.arange(x + 1, len(texts))
        y = y[(component[y] != component[x]) & (both | (sides[y] != sides[x]))]
        need = share * (sizes[y] + sizes[x]) - 1e-9
        able = np.minimum(sizes[y], sizes[x]) >= need
        y, need = y[able], need[able]
        same = keys[y] == keys[x]
        first = keys[x][same.argmax(axis=1)] == bucket
        y, need = y[first], need[first]
        if not len(y):
            continue
        own = inverse[begins[x] : begins[x] + sizes[x]]
        within[own] = True
        ends = np.cumsum(sizes[y])
        places = np.arange(ends[-1]) + np.repeat(begins[y] - (ends - sizes[y]), sizes[y])
        common = np.add.reduceat(within[inverse[places]].astype(np.int64), ends - sizes[y])
        within[own] = False
        for other in y[common >= need].tolist():
            if component[other] != component[x] and aligned_similarity(texts[x], texts[other]) >= SIMILARITY:
                component[component == component[other]] = component[x]
                out.append((x, other))
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, unit by unit; rows come sorted by unit."""
    names = ["a", "b"]

    def forest(rows: pa.Table) -> pa.RecordBatch:
        # units whose digests collide are told apart by their buckets
        pairs: list[tuple[bytes, bytes]] = []
        buckets = rows["bucket"].to_numpy()
        for bucket in np.unique(buckets).tolist():
            part = rows.filter(pa.array(buckets == bucket))
            labels = part["component"].to_pylist()
            keys = part["sketch"].combine_chunks().flatten().to_numpy().reshape(part.num_rows, -1)
            texts = [np.frombuffer(x, np.uint32) for x in part["words"].to_pylist()]
            both = part["one_block"][0].as_py()
            found = _unit_links(bucket, part["side"].to_numpy(), both, np.array(labels, object), keys, texts)
            pairs += [(labels[x], labels[y]) for x, y in found]
        made = [pa.array([pair[i] for pair in pairs], pa.binary()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(made, names)

    held: list[pa.Table] = []
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        unit = rows["unit"].to_numpy()
        edges = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]).tolist() if len(unit) else []
        for begin, stop in zip(edges, [*edges[1:], len(unit)], strict=True):
            if held and held[0]["unit"][0].as_py() != unit[begin]:
                yield forest(pa.concat_tables(held))
                held = []
            held.append(rows.slice(begin, stop - begin))
    if held:
        yield forest(pa.concat_tables(held))


def _units(members: DataFrame) -> DataFrame:
    """(unit, bucket, side, one_block, class, component): the blocks to compare of buckets of several components.

    ``members`` are (bucket, class, component, bytes). Sides below 0 are blocks of the bucket's largest component.
    """
    by_component = members.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    plan = by_component.groupBy("bucket").agg(
        F.count("*").alias("components"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.max(F.struct("n", "component", "bytes")).alias("head"),
    )

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("bigint")

    plan = plan.filter("components > 1").select(
        "bucket",
        F.col("head.component").alias("head"),
        blocks(F.col("head.n"), F.col("head.bytes")).alias("heads"),
        blocks(F.col("n") - F.col("head.n"), F.col("bytes") - F.col("head.bytes")).alias("others"),
    )
    met = members.join(cut_lineage(plan), "bucket")
    hashed = F.xxhash64("class")
    of_head = F.col("component") == F.col("head")
    side = F.when(of_head, -1 - F.pmod(hashed, F.col("heads"))).otherwise(F.pmod(hashed, F.col("others")))
    first = F.when(of_head, F.lit(0)).otherwise(-F.col("heads")).cast("bigint")
    spread = met.withColumn("side", side).withColumn("other", F.explode(F.sequence(first, F.col("others") - 1)))
    unit = F.xxhash64("bucket", F.least("side", "other"), F.greatest("side", "other"))
    return spread.select(unit.alias("unit"), "bucket", "side", (F.col("side") == F.col("other")).alias("one_block"), "class", "component")


def _links(docs: DataFrame, classes: DataFrame, text: str) -> DataFrame:
    """(node, component) over classes that share a sketch."""
    placed = classes.select("class", F.explode("sketch").alias("bucket")).distinct()
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = cut_lineage(placed.join(shared, "bucket"))
    score = members.groupBy("class").agg(F.round(F.sum(F.log("n")), 6).alias("score"))
    members = cut_lineage(members.join(score, "class").select("bucket", "class", "score"))
    words = cut_lineage(_word_table(docs, score.join(classes, "class").select("class", "key"), text))
    now = members.withColumn("component", F.col("class"))
    centres = cut_lineage(now.groupBy("bucket").agg(F.max(F.struct("score", "class", "component")).alias("centre")))
    edges = cut_lineage(_verified(_pairs(now, centres), words))
    labels = cut_lineage(components(edges)).withColumnRenamed("node", "class")
    sizes = words.select("class", F.length("words").cast("bigint").alias("bytes"))
    known = cut_lineage(sizes.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class")))
    units = _units(cut_lineage(members.select("bucket", "class").join(known, "class")))
    full = units.join(words.join(classes.select("class", "sketch"), "class"), "class")
    work = full.repartition("unit").sortWithinPartitions("unit", "class")
    fresh = cut_lineage(work.mapInArrow(_compared, "a binary, b binary"))
    joined = cut_lineage(components(fresh)).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return known.join(joined, "component", "left").select(F.col("class").alias("node"), F.coalesce("whole", "component").alias("component"))


def groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, key, group_id, group_size, kept) of every row: near duplicates share a group id."""
    bounded_batches(docs.sparkSession)
    # several jobs read the fingerprints
    prints = cut_lineage(fingerprints(docs, text))
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")
    classes = cut_lineage(
        prints.filter("class is not null")
        .groupBy("class")
        .agg(F.min(rank).alias("rank"), F.first("sketch").alias("sketch"), F.count("*").alias("rows"))
        .withColumn("key", F.col("rank.key"))
    )
    found = _links(docs, classes, text).withColumnRenamed("node", "class")
    labelled = classes.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    heads = labelled.groupBy("component").agg(F.min("rank").alias("head"), F.sum("rows").alias("group_size"))
    by_class = labelled.select("class", "component").join(heads, "component").select("class", "head", "group_size")
    joined = prints.select("doc_id", "key", "class").join(by_class, "class", "left")
    alone = F.col("head").isNull()
    return joined.select(
        "doc_id",
        "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("group_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("head.key") == F.col("key"))).alias("kept"),
    )


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """The first document of each group, with the columns of ``docs``; rows that repeat id and text stay once."""
    stay = groups(docs, text).filter("kept").select(F.col("key").alias("_key"))
    keyed = docs.withColumn("_key", document_key(F.col("doc_id"), F.col(text)))
    return keyed.join(stay.distinct(), "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
