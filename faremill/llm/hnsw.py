"""Approximate nearest neighbours by inner product: a navigable small-world graph for each shard.

Distinct vectors are dealt to shards of about ``SHARD`` by a hash, so a shard's size does not depend on the table's. Each
shard becomes one row of flat arrays: ids, vectors, levels and the neighbours at every level (-1: none).
Vectors get one more component that makes their lengths equal, so that the largest inner product is
the nearest neighbour. Nodes are inserted and queries searched in batches: one step of the beam search
expands the best nodes of all queries of a batch at once. Neighbours are chosen for diversity.

A stated query set is compared with all shards: each shard's arrays go to one task, which streams the queries past them, ``QUERIES``
at a time; every shard returns its best and the results are merged, at most ``k`` rows for a query and shard. Fewer and larger
shards (``size`` of ``index``) make fewer copies of the queries. Only the search within a shard is approximate;
scores are exact inner products of the original vectors in double precision.

Equal vectors are one node that carries its ``k`` + 1 smallest ids, which is all that a result can need.
Vectors that are null, empty, zero or hold null or non-finite components, rows without an id, and vectors of another length than the
query's take no part. Ties go to the smaller id. If an id repeats, its smallest vector is the query, and all rows are candidates but
those of the query's id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faremill.llm.embed_dedup import usable
from faremill.session import cut_lineage

SHARD = 4096
QUERIES = 1024
DEGREE = 16  # neighbours on the upper levels; twice as many on the lowest
EF_BUILD = 64
EF_SEARCH = 96
EXPANDED = 4
BATCH = 512


class Graph:
    """Vectors of equal length with their neighbour arrays, levels downwards from the highest."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, neighbours: list[np.ndarray]):
        self.vectors, self.levels, self.neighbours = vectors, levels, neighbours

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        n = len(vectors)
        squared = np.einsum("ij,ij->i", vectors, vectors)
        lifted = np.c_[vectors, np.sqrt(np.maximum(squared.max() - squared, 0))]
        rng = np.random.default_rng(n)
        levels = (-np.log(1 - rng.random(n)) / np.log(DEGREE)).astype(np.int32)
        order = rng.permutation(n)
        top = order[np.argmax(levels[order])]
        order = np.r_[top, order[order != top]]
        neighbours = [np.full((n, DEGREE * (2 if level == 0 else 1)), -1, np.int32) for level in range(levels[top] + 1)]
        graph = cls(lifted.astype(np.float32), levels, neighbours)
        done, size = 1, 32
        while done < n:
            graph._insert(order[done : done + size], order[0])
            done += size
            size = min(2 * size, BATCH)
        return graph

    def _insert(self, new: np.ndarray, entry: int) -> None:
        found = np.full((len(new), 1), entry, np.int64)
        for level in range(len(self.neighbours) - 1, -1, -1):
            found, near = self._beam(self.vectors[new], found, level, EF_BUILD if level == 0 else DEGREE)
            here = np.flatnonzero(self.levels[new] >= level)
            if not len(here):
                continue
            among = self.vectors[new[here]] @ self.vectors[new[here]].T
            np.fill_diagonal(among, -np.inf)
            width = min(len(here) - 1, DEGREE)
            best = np.argpartition(-among, width - 1, axis=1)[:, :width] if width else np.empty((len(here), 0), np.int64)
            ids = np.concatenate([found[here], new[here][best]], axis=1)
            near_all = np.concatenate([near[here], np.take_along_axis(among, best, axis=1)], axis=1)
            chosen = self._diverse(ids, near_all, self.neighbours[level].shape[1] // (2 if level == 0 else 1))
            self.neighbours[level][new[here], : chosen.shape[1]] = chosen
            source = np.repeat(new[here], chosen.shape[1])
            target = chosen.ravel()
            self._link_back(level, target[target >= 0], source[target >= 0])

    def _link_back(self, level: int, target: np.ndarray, source: np.ndarray) -> None:
        """Add edges target -> source; full lists are chosen anew."""
        table = self.neighbours[level]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        at = np.arange(len(target))
        nth = at - np.maximum.accumulate(np.where(np.r_[True, target[1:] != target[:-1]], at, 0)) if len(target) else at
        for begin in range(0, int(nth.max()) + 1 if len(nth) else 0, DEGREE):
            now = (nth >= begin) & (nth < begin + DEGREE)
            nodes, row = np.unique(target[now], return_inverse=True)
            more = np.full((len(nodes), DEGREE), -1, np.int64)
            more[row, nth[now] - begin] = source[now]
            ids = np.concatenate([table[nodes], more], axis=1)
            near = np.einsum("ijk,ik->ij", self.vectors[ids], self.vectors[nodes])
            near[ids < 0] = -np.inf
            chosen = self._diverse(ids, near, table.shape[1])
            table[nodes] = -1
            table[nodes, : chosen.shape[1]] = chosen

    def _diverse(self, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` of the candidates: nearer to the node than to any chosen one first, then the nearest left."""
        order = np.argsort(-near, axis=1, kind="stable")
        ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
        valid = (ids >= 0) & np.isfinite(near)
        picked = np.zeros(ids.shape, bool)
        closest = np.full(ids.shape, -np.inf, np.float32)  # to a chosen one
        points = self.vectors[ids]
        for j in range(ids.shape[1]):
            take = valid[:, j] & (near[:, j] > closest[:, j]) & (picked.sum(axis=1) < most)
            picked[:, j] = take
            rows = np.flatnonzero(take)
            if len(rows):
                to_it = np.einsum("ijk,ik->ij", points[rows], points[rows, j])
                closest[rows] = np.maximum(closest[rows], to_it)
        rank = np.argsort(np.where(picked, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
        chosen = np.take_along_axis(ids, rank, axis=1)
        return np.where(np.take_along_axis(valid, rank, axis=1), chosen, -1)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, level: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ef nearest nodes met by every query (id, nearness), nearest first; -1 and -inf where there are fewer."""
        rows = np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), len(self.vectors) + 1), bool)  # the last column stands for -1
        seen[:, -1] = True
        ids = np.full((len(queries), ef), -1, np.int64)
        near = np.full((len(queries), ef), -np.inf, np.float32)
        width = min(ef, entry.shape[1])
        ids[:, :width] = entry[:, :width]
        near[:, :width] = np.einsum("ijk,ik->ij", self.vectors[ids[:, :width]], queries)
        near[ids < 0] = -np.inf
        seen[rows, ids] = True
        open_ = ids >= 0
        table = self.neighbours[level]
        while open_.any():
            take = np.argsort(np.where(open_, -near, np.inf), axis=1, kind="stable")[:, :EXPANDED]
            usable_ = np.take_along_axis(open_, take, axis=1)
            np.put_along_axis(open_, take, False, axis=1)
            nodes = np.where(usable_, np.take_along_axis(ids, take, axis=1), -1)
            met = np.where(nodes[:, :, None] >= 0, table[nodes], -1).reshape(len(queries), -1)
            met = np.sort(met, axis=1)
            met[:, 1:][met[:, 1:] == met[:, :-1]] = -1
            met = np.where(seen[rows, met], -1, met)
            seen[rows, met] = True
            fresh = np.einsum("ijk,ik->ij", self.vectors[met], queries)
            fresh[met < 0] = -np.inf
            all_ids = np.concatenate([ids, met], axis=1)
            all_near = np.concatenate([near, fresh], axis=1)
            all_open = np.concatenate([open_, met >= 0], axis=1)
            best = np.argsort(-all_near, axis=1, kind="stable")[:, :ef]
            ids, near = np.take_along_axis(all_ids, best, axis=1), np.take_along_axis(all_near, best, axis=1)
            open_ = np.take_along_axis(all_open, best, axis=1) & (near > -np.inf)
        return ids, near

    def search(self, queries: np.ndarray, ef: int) -> np.ndarray:
        """The nodes found for every query, nearest first; -1 where there are fewer."""
        lifted = np.c_[queries, np.zeros(len(queries))].astype(np.float32)
        top = int(np.argmax(self.levels))
        found = np.full((len(queries), 1), top, np.int64)
        for level in range(len(self.neighbours) - 1, -1, -1):
            found, _ = self._beam(lifted, found, level, ef if level == 0 else EXPANDED)
        return found


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def index(rows: DataFrame, k: int, vector: str = "embedding", name: str = "vec_id", size: int = SHARD) -> DataFrame:
    """One row a shard: (shard, dim, ids, vectors, levels, neighbours, sizes), the arrays as bytes."""
    given = rows.select(F.col(name).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    given = given.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    named = given.withColumn("node", F.md5(F.col("vector").cast("string")))
    first = F.row_number().over(W.partitionBy("node").orderBy("id"))
    distinct = cut_lineage(
        named.withColumn("nth", first)
        .filter(F.col("nth") <= k + 1)
        .groupBy("node")
        .agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("dim", F.size("vector"))
    )
    counts = distinct.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("bigint").alias("shards"))
    dealt = distinct.join(counts, "dim").withColumn(
        "shard", F.concat_ws("-", "dim", F.pmod(F.xxhash64("node"), F.col("shards")))
    )

    def build(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        vectors = _matrix(part["vector"])
        graph = Graph.build(vectors)
        sizes = part["ids"].combine_chunks().value_lengths().to_numpy().astype(np.int32)
        ids = part["ids"].combine_chunks().flatten().to_numpy().astype(np.int64)
        row = {
            "shard": [part["shard"][0].as_py()],
            "dim": pa.array([vectors.shape[1]], pa.int32()),
            "ids": [ids.tobytes()],
            "sizes": [sizes.tobytes()],
            "vectors": [vectors.tobytes()],
            "levels": [graph.levels.tobytes()],
            "neighbours": pa.array([[level.tobytes() for level in graph.neighbours]], pa.list_(pa.binary())),
        }
        return pa.table(row)

    schema = "shard string, dim int, ids binary, sizes binary, vectors binary, levels binary, neighbours array<binary>"
    return dealt.select("shard", "node", "vector", "ids").groupBy("shard").applyInArrow(build, schema)


ARRAYS = ["dim", "ids", "sizes", "vectors", "levels", "neighbours"]


class _Stored:
    """A shard's graph from its row of flat arrays, with the ids of every node."""

    def __init__(self, row: dict):
        self.vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
        squared = np.einsum("ij,ij->i", self.vectors, self.vectors)
        lifted = np.c_[self.vectors, np.sqrt(np.maximum(squared.max() - squared, 0))].astype(np.float32)
        tables = [np.frombuffer(x, np.int32).reshape(len(self.vectors), -1) for x in row["neighbours"]]
        self.graph = Graph(lifted, np.frombuffer(row["levels"], np.int32), tables)
        self.sizes = np.frombuffer(row["sizes"], np.int32)
        self.ids, self.starts = np.frombuffer(row["ids"], np.int64), np.r_[0, np.cumsum(self.sizes)]

    def nearest(self, own: np.ndarray, points: np.ndarray, k: int) -> pa.RecordBatch:
        """(query_id, vec_id, score) of the k nearest found for every query, without the query's own id."""
        nodes = self.graph.search(points, max(EF_SEARCH, 2 * k))
        which = np.repeat(np.arange(len(points)), nodes.shape[1])
        node = nodes.ravel()
        which, node = which[node >= 0], node[node >= 0]
        score = np.einsum("ij,ij->i", self.vectors[node], points[which])
        sizes = self.sizes[node]
        member = np.repeat(np.arange(len(node)), sizes)
        vec = self.ids[np.repeat(self.starts[node], sizes) + np.arange(len(member)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        which, score = which[member], score[member]
        other = vec != own[which]
        which, score, vec = which[other], score[other], vec[other]
        order = np.lexsort((vec, -score, which))
        which, score, vec = which[order], score[order], vec[order]
        at = np.arange(len(which))
        nth = at - np.maximum.accumulate(np.where(np.r_[True, which[1:] != which[:-1]][: len(at)], at, 0))
        keep = nth < k
        made = [pa.array(own[which[keep]], pa.int64()), pa.array(vec[keep], pa.int64()), pa.array(score[keep], pa.float64())]
        return pa.RecordBatch.from_arrays(made, ["query_id", "vec_id", "score"])


def search(built: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", name: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every query row, without rows of the query's own id."""
    given = queries.select(F.col(name).alias("query_id"), F.col(vector).cast("array<double>").alias("vector"))
    given = given.filter(F.col("query_id").isNotNull() & usable(F.col("vector")))
    asked = cut_lineage(given.groupBy("query_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector")))
    shards = built.select(F.col("shard").alias("part"), F.col("dim").alias("length"))
    arrays = F.struct(*(F.col(one) for one in ARRAYS)).alias("arrays")
    none = F.lit(None)
    stored = built.select(F.col("shard").alias("part"), arrays, none.cast("bigint").alias("query_id"), none.cast("array<double>").alias("vector"))
    met_by = asked.join(shards, F.col("dim") == F.col("length"))
    asking = met_by.select("part", none.cast(stored.schema["arrays"].dataType).alias("arrays"), F.col("query_id").cast("bigint"), "vector")
    # a shard's arrays come before its queries
    work = stored.unionByName(asking).repartition(max(1, built.count()), "part").sortWithinPartitions("part", F.col("arrays").isNull())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            holds = batch["arrays"].is_valid().to_numpy(zero_copy_only=False)
            edges = sorted({0, *np.flatnonzero(holds).tolist(), *(np.flatnonzero(holds) + 1).tolist(), len(holds)})
            for begin, stop in zip(edges[:-1], edges[1:], strict=True):
                if holds[begin]:
                    shard = _Stored(batch["arrays"][begin].as_py())
                    continue
                for at in range(begin, stop, QUERIES):
                    part = batch.slice(at, min(QUERIES, stop - at))
                    yield shard.nearest(part["query_id"].to_numpy(), _matrix(part["vector"]), k)

    found = work.mapInArrow(look, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
