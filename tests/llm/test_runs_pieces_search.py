"""Periodic runs, SentencePiece and ranked search against brute force and libraries, and on odd rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

from faremill.llm import lexical, periodic, sentence_pieces
from faremill.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, runs int, made int, query string, terms int, score int"
LONG = " ".join(random.Random(4).choice("abcdefgh") * 3 for _ in range(80_000))
TEXTS = [None, "", " \n\t ", "!!!", "a", "a b a b a b a b", "a b a b a b a b", LONG, "x" * 5000, "Ünïcode İ Σς 日本語", "\x00\x1c x\x85y", " " * 700]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like inner ones."""
    rows = [(i, t, i, i, str(i), i, i) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "a b a b a b a b", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            stop = i
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop - i + q
            if stop > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = stop + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def random_words(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
    if n > 10 and rng.random() < 0.6:
        first, period = rng.randrange(n), rng.randint(1, 15)
        words[first:] = [words[first + i % period] if first + period <= n else words[first + i] for i in range(n - first)]
    return words


def listed(runs):
    return sorted(map(tuple, runs.tolist()))


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        words = random_words(rng, rng.randint(0, 90))
        assert listed(periodic.find_runs(np.array(words, np.int32))) == brute_runs(words), words


def test_runs_of_long_texts_in_slices_equal_brute_force(monkeypatch):
    monkeypatch.setattr(periodic, "GRID_WORDS", 12)
    monkeypatch.setattr(periodic, "GRID_SLICE", 64)
    rng = random.Random(12)
    for _ in range(40):
        words = random_words(rng, rng.randint(13, 400))
        assert listed(periodic.find_runs(np.array(words, np.int32))) == brute_runs(words)


def test_extensions_equal_plain_comparison():
    rng = random.Random(13)
    for _ in range(60):
        words = np.array(random_words(rng, rng.randint(2, 150)), np.int32)
        made = periodic.Extensions(words)
        pairs = np.array([(i, j) for i in range(len(words)) for j in range(i + 1, len(words) + 1)])
        plain = [next((k for k in range(len(words) - j) if words[i + k] != words[j + k]), len(words) - j) for i, j in pairs]
        assert made.common(pairs[:, 0], pairs[:, 1]).tolist() == plain


def test_runs_of_odd_rows(spark, odd):
    for row in odd.select("*", periodic.runs(F.col("text")).alias("found")).collect():
        words = (row.text or "").encode().split()
        want = brute_runs(words) if len(words) < 1000 else listed(periodic.find_runs(periodic.numbered(words)))
        assert sorted((r.start, r.length, r.period) for r in row.found.runs) == want
        gone = {i for start, length, q in want for i in range(start + q, start + length)}
        assert row.found.collapsed == b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        assert row.found.n_words == len(words)
    assert odd.limit(0).select(periodic.runs(F.col("text"))).collect() == []


def test_one_run_may_hold_a_whole_long_text():
    assert listed(periodic.find_runs(np.arange(200_000, dtype=np.int32) % 7)) == [(0, 200_000, 7)]


def test_pieces_equal_the_library(spark, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for row in odd.select("text", sentence_pieces.encode_decode(F.col("text"), PIECES).alias("m"), sentence_pieces.encode(F.col("text"), PIECES).alias("ids")).collect():
        assert row.m.ids == row.ids == library.encode(row.text or "")
        assert row.m.decoded == library.decode(row.ids)
    assert odd.limit(0).select(sentence_pieces.encode(F.col("text"), PIECES)).collect() == []


def test_piece_merges_equal_the_library_on_random_texts(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CUT_CHARS", 40)
    library, ours, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.PieceBPE(PIECES), random.Random(14)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    texts = [" " * n for n in range(70)] + ["", "a" + " " * 500 + "b", "ab" * 900]
    for _ in range(700):
        alphabet = rng.choice(["abc", "abcdefghij ▁", "  \n\tx", "日本語é😀ü\x00 "])
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))))
        texts.append(rng.choice(pieces) * rng.randint(1, 9) + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))))
    for text, raw in zip(texts, ours.encode_batch(texts), strict=True):
        ids = library.encode(text)
        assert np.frombuffer(raw, np.int32).tolist() == ids, text
        assert ours.decode_one(np.array(ids, np.int32)) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(spark):
    library, ours, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.PieceBPE(PIECES), random.Random(15)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(190, 250), rng.randrange(3)]) for _ in range(rng.randint(0, 10))]
        assert ours.decode_one(np.array(ids, np.int32)) == library.decode(ids), ids
    frame = spark.createDataFrame([(None,), ([],), ([1, 15043, 3186],)], "ids array<int>")
    assert [r[0] for r in frame.select(sentence_pieces.decode(F.col("ids"), PIECES)).collect()] == ["", "", library.decode([1, 15043, 3186])]


def test_digests_of_the_piece_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = LLM_QUERIES["op12_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def brute_search(docs, queries, k):
    """docs: (id, text) rows; queries: (id, text) rows."""
    counts = [(i, Counter(lexical.terms_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for key, text in queries:
        asked.setdefault(key, set()).update(lexical.terms_of(text))
    out = []
    for key, terms in asked.items():
        scored = []
        for (doc, c), n in zip(counts, sizes, strict=True):
            m = 50 + (50 * n * n_docs) // max(n_terms, 1)
            score = 0
            for t in terms & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(key, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def prose(rng, n):
    return " ".join(f"W{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(n))


@pytest.mark.parametrize("words", [60, 3000])
def test_search_equals_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(lexical, "SHARD_WORDS", words)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 3000)
    rng = random.Random(16)
    docs = [(i, prose(rng, rng.randint(0, 40))) for i in range(300)]
    docs += [docs[7], docs[7], (None, docs[8][1]), (None, None), (400, ""), (401, "w1-W2,é日本_x"), (9, docs[10][1])]
    queries = [(i, prose(rng, 12)) for i in range(12)] + [(3, "w2 é日本"), (None, "w1 w5"), (50, None), (51, "nowhere"), (3, "w2")]
    built = lexical.index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    found = lexical.search(built, spark.createDataFrame(queries, "item_id long, text string"), 5)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_search(docs, queries, 5)


def test_search_of_odd_and_empty_tables(spark, odd):
    queries = odd.select(F.col("doc_id").alias("item_id"), "text")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    got = lexical.search(lexical.index(odd), queries, 4)
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, docs, 4)
    assert lexical.search(lexical.index(odd.limit(0)), queries, 4).collect() == []
    assert lexical.search(lexical.index(odd), queries.limit(0), 4).collect() == []


def test_best_positions_stop_early_with_the_right_scores():
    rng = np.random.default_rng(17)
    n, lists = 5000, []
    for _ in range(4):
        docs = np.sort(rng.choice(n, 3000, replace=False)).astype(np.int32)
        impacts = (1e6 * rng.pareto(1.5, 3000)).astype(np.int64)
        lists.append((int(rng.integers(1, 9)), lexical.Impacts(docs, impacts)))
    full = np.zeros(n, np.int64)
    for weight, one in lists:
        full[one.docs] += weight * one.impacts
    found, score, depth = lexical.best_positions(lists, n, 10)
    assert depth < 1500
    assert (score == full[found]).all()
    assert sorted(score)[-10:] == sorted(full)[-10:]


def test_a_row_group_of_the_index_holds_few_shards(spark, monkeypatch):
    """One task makes many shards where its rows are many; neither the writer nor a reader may hold them all."""
    monkeypatch.setattr(lexical, "SHARD_WORDS", 50_000)
    rng = np.random.default_rng(18)
    docs = [(i, " ".join(map(str, rng.integers(1 << 50, 1 << 60, 50_000)))) for i in range(24)]
    built = lexical.index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    footers = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in built.inputFiles()]
    groups = [one.row_group(i) for one in footers for i in range(one.num_row_groups)]
    assert sum(group.num_rows for group in groups) == 24
    assert max(group.total_byte_size for group in groups) < 16 << 20
    assert max(group.num_rows for group in groups) < 24
