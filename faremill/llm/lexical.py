"""Ranked lexical search by best positions.

The index holds shards: rows of terms with their documents and counts as flat arrays, made where the texts are read, so building
it moves nothing over the network. Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with only A-Z lower-cased.
Its own sums give the number of documents N, of terms L and of documents with each term.

A search takes queries in blocks of bounded size to the shards (a narrow step over the index, whose arrays stay where they are). In a shard every term has an
impact list in falling order. All lists of a query are read side by side; a document met in one is looked up in the others, and the
places found there count as seen too. The best position of a list ends its unbroken seen part. No document unseen so far has more than the sum of the
impacts at the first places behind the best positions, which is less than at the last-read ones; reading stops when that sum is strictly below the k-th score, so that all
ties with it have been seen. The k best of each shard are merged.

Scores are integers: a document of n terms has m = 50 + 50 n N div L, and a term of weight w and count tf adds
w * (10^9 tf div (1000 tf + 20 m)), w = floor(1000 ln((2N + 2) / (2 df + 1))).

Null and empty texts have no term: they are neither counted nor found. Equal scores are ordered by ascending id, null ids last. Rows that
repeat id and text are documents of their own, found one after another. Queries of one id (null included) are one query with the terms of all its rows,
each once. Empty tables give no rows. A shard holds SHARD_WORDS words or one longer text. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches
from faremill.session import LARGE_ROWS, cut_lineage

SHARD_WORDS = 2_000_000
#: Bytes of query terms that go to the shards at once.
BLOCK_BYTES = 8 << 20
_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c).isalnum() and c < 0x80 or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _shard(ids: list, sizes: list[int], numbers: list[np.ndarray], terms: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
    """One index row: terms, documents of each, and for every pair the document's number in the shard and the count."""
    doc = np.repeat(np.arange(len(ids)), sizes)
    pairs, counts = np.unique(np.concatenate(numbers).astype(np.int64) << 32 | doc, return_counts=True)
    held = np.bincount(pairs >> 32, minlength=len(terms))
    columns = {
        "n_docs": pa.array([len(ids)], pa.int64()),
        "n_terms": pa.array([sum(sizes)], pa.int64()),
        "doc_ids": pa.array([ids], pa.list_(kind)),
        "sizes": pa.array([sizes], pa.list_(pa.int64())),
        "terms": pa.array([terms], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
        "held": pa.array([held], pa.list_(pa.int32())),
        "docs": pa.array([(pairs & 0xFFFFFFFF).astype(np.int32).tobytes()], pa.binary()),
        "counts": pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The shards of all documents, written to the shared folder."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    bounded_batches(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, numbers, words, kind = [], [], [], 0, pa.null()
        number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        for batch in batches:
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                found = terms_of(text.as_py())
                if not found:
                    continue
                if words and words + len(found) > SHARD_WORDS:
                    yield _shard(ids, sizes, numbers, list(number), kind)
                    ids, sizes, numbers, words = [], [], [], 0
                    number = defaultdict(itertools.count().__next__)
                ids.append(key.as_py())
                sizes.append(len(found))
                numbers.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                words += len(found)
        if ids:
            yield _shard(ids, sizes, numbers, list(number), kind)

    kind = dict(rows.dtypes)["doc_id"]
    schema = f"n_docs long, n_terms long, doc_ids array<{kind}>, sizes array<bigint>, terms array<string>, held array<int>, docs binary, counts binary"
    return cut_lineage(rows.mapInArrow(build, schema), **LARGE_ROWS)


def asked_terms(queries: DataFrame, query_id: str = "item_id", text: str = "text") -> DataFrame:
    """(query, term) of every query, each once."""
    rows = queries.select(F.col(query_id).alias("query"), F.col(text).alias("text"))

    @F.arrow_udf("array<string>")
    def listed(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(terms_of(t.as_py()))) for t in texts], pa.list_(pa.binary())).cast(pa.list_(pa.string()))

    return rows.select("query", F.explode(listed("text")).alias("term")).distinct()


def term_weights(built: DataFrame, asked: DataFrame, n_docs: int) -> DataFrame:
    """(query, term, weight) of the asked terms that a document holds and that weigh something."""
    each = built.select(F.explode(F.arrays_zip("terms", "held")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.held").alias("held"))
    frequent = each.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("held").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    return asked.join(frequent, "term").select("query", "term", weight.alias("weight")).filter("weight > 0")


class Impacts:
    """One term's list of a shard: documents in order of number, their impacts, and the order of falling impact."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray):
        self.docs, self.impacts = docs, impacts
        self.order = np.argsort(-impacts, kind="stable")
        self.place = np.empty(len(docs), np.int64)
        self.place[self.order] = np.arange(len(docs))


def best_positions(lists: list[tuple[int, Impacts]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that may be among the k best of (weight, list) pairs, their scores, and the depth read."""
    met, score = np.zeros(n_docs, bool), np.zeros(n_docs, np.int64)
    seen = [np.zeros(len(one.docs) + 1, bool) for _, one in lists]  # the place behind the last one is never seen
    best = [0] * len(lists)
    depth, step = 0, k
    while True:
        fresh = np.zeros(n_docs, bool)
        for _, one in lists:
            fresh[one.docs[one.order[depth : depth + step]]] = True
        fresh &= ~met
        met |= fresh
        new = np.flatnonzero(fresh)
        bound = 0
        for nth, (weight, one) in enumerate(lists):
            at = np.minimum(np.searchsorted(one.docs, new), len(one.docs) - 1)
            hit = one.docs[at] == new
            at = at[hit]
            score[new[hit]] += weight * one.impacts[at]
            seen[nth][one.place[at]] = True
            best[nth] += int(np.argmin(seen[nth][best[nth] :]))
            if best[nth] < len(one.docs):
                bound += weight * int(one.impacts[one.order[best[nth]]])
        depth, step = depth + step, 2 * step
        found = np.flatnonzero(met)
        if bound == 0 or (len(found) >= k and np.partition(score[found], len(found) - k)[len(found) - k] > bound):
            return found, score[found], depth


def search(built: DataFrame, queries: DataFrame, k: int, query_id: str = "item_id", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score) of the k best documents of every query, best first."""
    total = built.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 1
    weights = cut_lineage(term_weights(built, asked_terms(queries, query_id, text), n_docs))
    size = weights.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    kinds = dict(weights.dtypes)["query"], dict(built.dtypes)["doc_ids"].removeprefix("array<")[:-1]
    schema = f"query {kinds[0]}, doc_id {kinds[1]}, score long"

    def block(nth: int) -> DataFrame:
        part = weights if blocks == 1 else weights.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == nth)
        table = part.toArrow()  # at most about BLOCK_BYTES by the count above
        return built.mapInArrow(lambda batches: _search_shards(batches, table, k, n_docs, n_terms), schema)

    found = reduce(DataFrame.union, [block(nth) for nth in range(blocks)])
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_id), "rank", F.col("doc_id").alias(doc_id), "score")


def _search_shards(batches: Iterator[pa.RecordBatch], asked: pa.Table, k: int, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    vocabulary = pc.unique(asked["term"].combine_chunks())
    term = pc.index_in(asked["term"], vocabulary).to_numpy()
    weight = asked["weight"].to_numpy()
    coded = asked["query"].combine_chunks().dictionary_encode(null_encoding="encode")
    query, names = coded.indices.to_numpy(), coded.dictionary
    order = np.argsort(query, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0]) if len(order) else np.empty(0, np.int64)
    wanted = [(int(query[part[0]]), part) for part in np.split(order, starts[1:]) if len(part)]
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("doc_ids")[row].values
            held = batch.column("held")[row].values.to_numpy()
            stops = np.cumsum(held, dtype=np.int64)
            at = pc.index_in(vocabulary, batch.column("terms")[row].values).to_pylist()
            docs = np.frombuffer(batch.column("docs")[row].as_py(), np.int32)
            counts = np.frombuffer(batch.column("counts")[row].as_py(), np.int32)
            m = 50 + 50 * batch.column("sizes")[row].values.to_numpy().astype(np.int64) * n_docs // n_terms
            lists: dict[int, Impacts] = {}
            for number, place in enumerate(at):
                if place is not None:
                    part = slice(stops[place] - held[place], stops[place])
                    tf = counts[part].astype(np.int64)
                    lists[number] = Impacts(docs[part], 1_000_000_000 * tf // (1000 * tf + 20 * m[docs[part]]))
            by_id = np.empty(len(ids), np.int64)
            by_id[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            out_query, out_doc, out_score = [], [], []
            for number, part in wanted:
                mine = [(int(weight[i]), lists[term[i]]) for i in part.tolist() if term[i] in lists]
                if not mine:
                    continue
                found, score, _ = best_positions(mine, len(ids), k)
                top = np.lexsort((by_id[found], -score))[:k]
                top = top[score[top] > 0]
                out_query.append(np.full(len(top), number))
                out_doc.append(found[top])
                out_score.append(score[top])
            if out_query:
                columns = [names.take(pa.array(np.concatenate(out_query))), ids.take(pa.array(np.concatenate(out_doc))), pa.array(np.concatenate(out_score))]
                yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])
