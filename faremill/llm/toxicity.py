"""Toxicity by weak supervision.

Voters are lexicon entries and patterns: a starter lexicon, words and word beginnings that labelled toxic rows share and
clean ones lack (picked one after another by the toxic rows that no earlier voter covers), a text written
mostly in capitals, and one that votes clean where no listed entry occurs. A generative label model
then treats the class as hidden: expectation maximisation estimates how often each voter fires in
either class (a voter that does not fire abstains), and the correlation of voters within a class discounts voters that repeat each other. A linear
classifier (logistic regression on the presence of words and word beginnings) is trained on the posterior
labels, so that it also learns entries that no voter lists. Labels only serve to list entries and to start the class balance.

The fit uses a bounded sample: the ``TRAIN_ROWS`` labels of smallest digest of their id, in one
task; of documents that repeat an id, the text of smallest digest is learnt from. Scoring covers whole texts of all rows; the model is at most ``FEATURES`` weights.

Null and empty texts get the score of a text without any feature. Rows without a label are not learnt
from. Without a toxic or a clean labelled row the score is the share of toxic labels (0 without labels). Repeated rows are scored each; repeated labels and ids are learnt from once.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.common import bounded_batches
from faremill.session import cut_lineage

TRAIN_ROWS = 6000
BEGINNINGS = (4, 6)
FEATURES = 2000
VOTERS = 40
LEAST_ROWS = 3
CACHED_WORDS = 50_000
PIECE_CHARS = 1 << 20
#: A starter lexicon of common English insults; each is a voter where it occurs.
INSULTS = ("clown", "disgusting", "dumb", "fool", "idiot", "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
_WORD = re.compile(r"\w+")


def _words(text: str) -> set[str]:
    """Distinct lower-case words, read piece by piece (a word across a cut counts as two)."""
    found: set[str] = set()
    for begin in range(0, len(text), PIECE_CHARS):
        found.update(_WORD.findall(text[begin : begin + PIECE_CHARS].lower()))
    return found


def _features(words: set[str]) -> set[str]:
    found = {f"{word}$" for word in words}
    for length in BEGINNINGS:
        found.update(word[:length] for word in words if len(word) >= length)
    return found


def _capitals(text: str) -> bool:
    letters = sum(map(str.isalpha, text))
    return letters > 20 and sum(map(str.isupper, text)) > 0.6 * letters


def pick_voters(rows: list[set[str]], toxic: np.ndarray) -> list[str]:
    """Entries of the lexicon voters: each covers the most toxic rows left, among entries hardly seen in clean rows."""
    seen = Counter(f for row, label in zip(rows, toxic, strict=True) if label for f in row)
    some = {f for f, n in seen.items() if n >= LEAST_ROWS}
    clean = Counter(f for row, label in zip(rows, toxic, strict=True) if not label for f in row & some)
    rate = max(1, int(toxic.sum())) / max(1, int((~toxic).sum()))
    good = {f for f in some if clean[f] * rate <= 0.005 * seen[f]}
    left = [row & good for row, label in zip(rows, toxic, strict=True) if label]
    picked: list[str] = []
    while left and len(picked) < VOTERS:
        counts = Counter(f for row in left for f in row)
        if not counts:
            break
        best = min(counts, key=lambda f: (-counts[f], -len(f), f))
        if counts[best] < LEAST_ROWS:
            break
        picked.append(best)
        left = [row for row in left if best not in row]
    picked += [f"{word}$" for word in INSULTS if f"{word}$" not in picked and any(f"{word}$" in row for row in rows)]
    # a second round over all toxic rows adds entries that overlap, whose correlation the model estimates
    more = sorted(good - set(picked), key=lambda f: (-seen[f], -len(f), f))
    return picked + more[: max(0, VOTERS - len(picked))]


def label_model(votes: np.ndarray, against: np.ndarray, balance: float, rounds: int = 60) -> np.ndarray:
    """Posterior of the hidden class. votes: row x voter, whether it fired; against: voters for the other class."""
    fires = votes.astype(float)
    on = np.where(against, 0.1, 0.5)
    off = np.where(against, 0.9, 0.02)
    prior = min(max(balance, 0.01), 0.99)
    together = np.eye(votes.shape[1])
    for _ in range(rounds):
        ratio = (fires / np.maximum(fires @ together, 1)) @ np.log(on / off)
        post = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + ratio, -30, 30)))
        total = max(post.sum(), 1e-9), max((1 - post).sum(), 1e-9)
        on = (post @ fires + 0.5) / (total[0] + 1)
        off = ((1 - post) @ fires + 0.5) / (total[1] + 1)
        prior = min(max(post.mean(), 0.01), 0.99)
        together = np.zeros((votes.shape[1],) * 2)
        for share, mean, n in ((post, on, total[0]), (1 - post, off, total[1])):
            apart = fires - mean
            cov = (apart * share[:, None]).T @ apart / n
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            together += np.maximum(cov / np.outer(sd, sd), 0) / 2
        np.fill_diagonal(together, 1)  # a vote counts less by the correlated voters that fire with it
    return post


def fit_linear(rows: list[set[str]], post: np.ndarray, rounds: int = 150) -> tuple[dict[str, float], float]:
    """Weights of the most telling features and the intercept, by logistic regression on soft labels."""
    n, mass, total = Counter(), Counter(), post.sum()
    for row, share in zip(rows, post, strict=True):
        n.update(row)
        for feature in row:
            mass[feature] += share
    kept = sorted((f for f, count in n.items() if count >= LEAST_ROWS))
    if not kept:
        share = min(max(total / max(len(rows), 1), 1e-6), 1 - 1e-6)
        return {}, float(np.log(share / (1 - share)))
    count = np.array([n[f] for f in kept], float)
    hot = np.array([mass[f] for f in kept])
    expected = count * total / len(rows)
    spread = np.sqrt(np.maximum(expected * (1 - total / len(rows)), 1e-9))
    order = np.argsort(-np.abs(hot - expected) / spread, kind="stable")[:FEATURES]
    names = [kept[i] for i in order.tolist()]
    number = {f: i for i, f in enumerate(names)}
    columns = [sorted(number[f] for f in row if f in number) for row in rows]
    at = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
    col = np.fromiter((i for c in columns for i in c), np.int64, len(at))
    weights, bias = np.zeros(len(names)), float(np.log((total + 0.5) / (len(rows) - total + 0.5)))
    squares, bias_square = np.full(len(names), 1e-6), 1e-6
    for _ in range(rounds):  # full-batch gradient steps scaled by each weight's own history
        margin = np.bincount(at, weights[col], len(rows)) + bias
        off = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - post
        step = np.bincount(col, off[at], len(names)) + 0.02 * weights
        squares += step * step
        bias_square += off.sum() ** 2
        weights -= 0.5 * step / np.sqrt(squares)
        bias -= 0.5 * off.sum() / np.sqrt(bias_square)
    return dict(zip(names, weights.tolist(), strict=True)), bias


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> dict:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); the model is a dict of weights and bias."""
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic is not null and id is not null")
    chosen = known.distinct().orderBy(F.xxhash64("id"), "id", "toxic").limit(TRAIN_ROWS)  # 12 bytes a row: below 200 KB
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    # one text for each label, combined before the shuffle: a hot id is one row, whichever of its rows come first
    single = rows.groupBy("id", "toxic").agg(F.min_by("text", F.md5("text")).alias("text"))
    sample = cut_lineage(single.select("id", "text", "toxic")).coalesce(1)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for ident, one, label in zip(*batch.columns, strict=True):
                value = one.as_py()
                found.append((ident.as_py(), sorted(_features(_words(value))), _capitals(value), label.as_py() == 1))
        found.sort()
        sets = [set(row[1]) for row in found]
        toxic = np.array([row[3] for row in found], bool)
        if not len(found) or toxic.all() or not toxic.any():
            model = {"weights": {}, "bias": None, "share": float(toxic.mean()) if len(found) else 0.0}
        else:
            entries = pick_voters(sets, toxic)
            fired = np.array([[e in row for e in entries] for row in sets], bool).reshape(len(sets), len(entries))
            votes = np.c_[fired, [row[2] for row in found], ~fired.any(axis=1)]
            against = np.r_[np.zeros(votes.shape[1] - 1, bool), True]
            post = label_model(votes, against, float(toxic.mean()))
            weights, bias = fit_linear(sets, post)
            model = {"weights": weights, "bias": bias, "voters": entries}
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(model)]})

    fitted = sample.mapInArrow(fit, "model string").first()  # FEATURES weights at most
    return json.loads(fitted[0]) if fitted else {"weights": {}, "bias": None, "share": 0.0}


def score(spark: SparkSession, model: dict, text: Column) -> Column:
    """Probability that a text is toxic."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        if fitted["bias"] is None:
            return pa.array([fitted["share"]] * len(texts), pa.float64())
        weights = fitted["weights"]
        cache: dict[str, tuple[str, ...]] = fitted.setdefault("cache", {})
        margins = np.empty(len(texts))
        for row, one in enumerate(texts):
            words = _words(one.as_py() or "")
            if len(cache) >= CACHED_WORDS:
                cache.clear()
            for word in words - cache.keys():
                cache[word] = tuple(f for f in _features({word}) if f in weights)
            present = set().union(*map(cache.__getitem__, words))
            margins[row] = fitted["bias"] + sum(sorted(map(weights.__getitem__, present)))
        return pa.array(1 / (1 + np.exp(-np.clip(margins, -700, 700))))

    return probability(text)
