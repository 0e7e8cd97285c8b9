"""Embedding near-duplicates by p-stable hashing with exact cosine checks.

Equal vectors of one label are first collapsed to one with a count. Each normalised vector gets ``TABLES``
keys; a key joins ``PROJECTIONS`` Gaussian projections, shifted at random and cut into cells of ``WIDTH``.
At cosine 0.93 (distance 0.374) two vectors share a cell with probability 0.85, a key with 0.10 and at
least one of 32 keys with 0.97; the chance grows quickly with the cosine. Vectors that share a key and a label
are compared in double precision.

Buckets are cut into blocks of about ``BLOCK`` vectors and every pair of blocks is one unit of work, so
that a hot bucket is spread and no unit is unbounded. Pairs are compared in numpy and not emitted: a unit
returns each vector's number of links and a spanning forest of the links it found. A pair that shares
several keys counts in the first of them only.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with nothing.
Vectors of different lengths are not compared. Repeated rows count as other vectors. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches
from faremill.llm.components import components
from faremill.llm.near_dedup import mix
from faremill.session import cut_lineage

SIMILARITY = 0.93
TABLES = 32
PROJECTIONS = 14
WIDTH = 2.0
BLOCK = 512


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the norm
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def hash_keys(vectors: np.ndarray) -> np.ndarray:
    """One key for each vector (row) and table."""
    dim = vectors.shape[1]
    rng = np.random.default_rng(dim)
    directions = rng.standard_normal((dim, TABLES * PROJECTIONS))
    shifts = rng.uniform(0, WIDTH, TABLES * PROJECTIONS)
    cells = np.floor((_unit(vectors) @ directions + shifts) / WIDTH).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(vectors), TABLES, PROJECTIONS)
    key = np.broadcast_to(np.arange(TABLES, dtype=np.uint64) + np.uint64(dim << 16), cells.shape[:2]).copy()
    for i in range(PROJECTIONS):
        key = mix(key + cells[:, :, i] + np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _matrix(lists: pa.Array, kind: type) -> np.ndarray:
    """Rows of lists of one length."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), -1)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        lengths = vectors.value_lengths().to_numpy()
        for length in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == length))
            if rows.num_rows:
                keys = hash_keys(_matrix(rows.column("vector"), np.float64))
                offsets = pa.array(np.arange(0, keys.size + 1, TABLES, dtype=np.int32))
                made = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*rows.columns, made], [*rows.schema.names, "keys"])


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes with an edge and the least node each is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of units of work; rows come sorted by unit."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        unit = rows.column("unit").to_numpy()
        cut = int(np.searchsorted(unit, unit[-1])) if np.all(unit[:-1] <= unit[1:]) else 0
        if cut:
            yield from _links(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest is not None and rest.num_rows:
        yield from _links(rest)


def _links(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    rows = rows.combine_chunks()
    unit, side, table = (rows.column(name).to_numpy() for name in ("unit", "side", "nth"))
    copies = rows.column("copies").to_numpy()
    both = rows.column("one_block").to_numpy(zero_copy_only=False).astype(bool)
    vectors = _unit(_matrix(rows.column("vector").chunk(0), np.float64))
    keys = _matrix(rows.column("keys").chunk(0), np.int64)
    n, shift = len(unit), 1
    counts = np.zeros(n, np.int64)
    lefts, rights = [], []
    while True:
        i = np.flatnonzero(unit[:-shift] == unit[shift:]) if shift < n else np.empty(0, np.int64)
        if not len(i):
            break
        i = i[both[i] | (side[i] != side[i + shift])]
        for part in np.array_split(i, len(i) // 20_000 + 1):
            near = part[np.einsum("ij,ij->i", vectors[part], vectors[part + shift]) >= SIMILARITY]
            if len(near):
                first = (keys[near] == keys[near + shift]).argmax(axis=1)
                near = near[first == table[near]]
                np.add.at(counts, near, copies[near + shift])
                np.add.at(counts, near + shift, copies[near])
                lefts.append(near)
                rights.append(near + shift)
        shift += 1
    if not lefts:
        return
    ids = rows.column("id").chunk(0)
    node, root = _forest(np.concatenate(lefts), np.concatenate(rights), n)
    linked = np.flatnonzero(counts)
    links = np.concatenate([counts[linked], np.zeros(len(node), np.int64)])
    other = pa.concat_arrays([pa.nulls(len(linked), ids.type), ids.take(pa.array(root))])
    yield pa.RecordBatch.from_arrays(
        [ids.take(pa.array(np.concatenate([linked, node]))), other, pa.array(links)], ["a", "b", "links"]
    )


def near_vectors(rows: DataFrame, vector: str = "embedding", name: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = rows.sparkSession
    bounded_batches(spark)
    given = rows.select(F.col(name).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    fits = usable(F.col("vector")) & F.col("label").isNotNull()
    ident = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.col("vector").cast("array<string>")))
    named = cut_lineage(given.select("vec_id", "label", "vector", F.when(fits, ident).alias("id")))
    distinct = (
        named.filter("id is not null")
        .groupBy("id")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    )
    kind = dict(named.dtypes)
    schema = f"id string, label {kind['label']}, vector {kind['vector']}, copies bigint, least {kind['vec_id']}, keys array<bigint>"
    hashed = cut_lineage(distinct.mapInArrow(_hashed, schema))
    placed = hashed.select("id", "label", F.posexplode("keys").alias("nth", "key"))
    bucket = F.xxhash64("label", "nth", "key")
    placed = placed.select("id", "nth", bucket.alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    sized = placed.join(cut_lineage(sizes), "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("bigint"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    spread = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    units = spread.select(
        "id",
        "nth",
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        F.col("own").cast("int").alias("side"),
        (F.col("own") == F.col("other")).alias("one_block"),
    )
    full = units.join(hashed.select("id", "vector", "copies", "keys"), "id")
    work = full.repartition("unit").sortWithinPartitions("unit", "id")
    found = cut_lineage(work.mapInArrow(_compared, "a string, b string, links bigint"))
    links = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    labelled = hashed.select("id", "copies", "least").join(joined, "id", "left").join(links, "id", "left")
    labelled = cut_lineage(labelled.withColumn("component", F.coalesce("component", "id")))
    heads = cut_lineage(labelled.groupBy("component").agg(F.min("least").alias("head")))
    by_id = labelled.join(heads, "component").select(
        "id", "head", (F.coalesce("links", F.lit(0).cast("bigint")) + F.col("copies") - 1).alias("n_links")
    )
    result = named.select("vec_id", "id").join(cut_lineage(by_id), "id", "left")
    component = F.coalesce("head", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
