"""Gradient boosting on distributed histograms of gradients and hessians.

Rows are binned once into blocks of small integers, a table in the shared folder. Every level of a tree is one job: the
tasks find each row's node in the tree so far, add up gradient, hessian and count per (node, feature, bin), and send one
array a feature and task; the arrays are added up by feature, where the best split of every node is found. Only those
splits come to the driver. Gradients lie on a binary grid on which their sums are exact, so trees do not depend on the
order of tasks. Predictions of finished trees are written into the blocks every ``REFRESH`` trees and computed in
passing until then, so a job depends on a table and on a few trees alone. The blocks are dealt to ``TASKS_PER_CORE`` tasks a
core, each taking them one after the other, so that the arrays to be added up do not grow in number with the rows.

Blocks of at most ``ONE_TASK_BYTES`` in all go to one task, which takes the same steps without a job for each: the trees are the same.

Gain and leaf values are of second order: with gradient sum G, hessian sum H and penalty l2, a leaf is worth
G^2 / (H + l2) and predicts -G / (H + l2). Children need ``leaf`` rows and ``child_weight`` hessian. Rows and columns are drawn per
tree, rows by a hash of their values. Three ways to grow:

* ``level``: every node of a level is split at its best place;
* ``leaves``: the leaf of greatest gain is split next, up to ``leaves`` leaves. A node's best split does not depend on the
  others, so all levels are grown and the tree is cut back to the splits that would have come first;
* ``symmetric``: all nodes of a level share the split of greatest total gain.

Nominal features (by the vector's metadata) are split into sets of levels, ordered by gradient over hessian.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.session import LARGE_ROWS, bounded_batches, cut_lineage

BINS = 256
BLOCK_ROWS = 1 << 16
REFRESH = 10
LEAST_GAIN = 1e-9
TASKS_PER_CORE = 3
ONE_TASK_BYTES = 64 << 20
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@dataclass(frozen=True)
class Growth:
    """How trees grow; see the module's text."""

    rounds: int
    depth: int
    rate: float
    way: str = "level"
    l2: float = 0.0
    leaf: int = 1
    child_weight: float = 0.0
    leaves: int = 0
    rows: float = 1.0
    columns: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1 and 2i + 2): feature or -1, codes that go left, value of the node."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[int | list[int]] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def table(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature of every node, and whether a code below ``width`` goes left there."""
        left = np.zeros((len(self.feature), width), bool)
        for node, goes in enumerate(self.left):
            if isinstance(goes, list):
                left[node, [c for c in goes if c < width]] = True
            else:
                left[node, : goes + 1] = True
        return np.array(self.feature), left

    def nodes(self, codes: np.ndarray, table: tuple[np.ndarray, np.ndarray] | None = None, at: np.ndarray | None = None) -> np.ndarray:
        """The node that each row (a column of ``codes``) ends in, going on from ``at``."""
        at, rows = np.zeros(codes.shape[1], np.int64) if at is None else at, np.arange(codes.shape[1])
        feature, left = table or self.table(int(codes.max(initial=0)) + 1)
        while True:
            split = feature[at]
            inner = split >= 0
            if not inner.any():
                return at
            at = np.where(inner, 2 * at + 2 - left[at, codes[split, rows]], at)

    def predict(self, codes: np.ndarray, table: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        return np.array(self.value)[self.nodes(codes, table)]

    def grow(self, node: int, feature: int, left: int | list[int], values: tuple[float, float]) -> None:
        missing = 2 * node + 3 - len(self.feature)
        self.feature += [-1] * missing
        self.left += [0] * missing
        self.value += [0.0] * missing
        self.feature[node], self.left[node] = feature, left
        self.value[2 * node + 1], self.value[2 * node + 2] = values


class BoostedTrees(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted booster: a base value and the sum of the trees' damped values. Stored and loaded like any pipeline stage."""

    ensemble = Param(Params._dummy(), "ensemble", "bins, base, rate and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, ensemble: str = "{}", featuresCol: str = "features", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(ensemble="{}")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, edges: list[list[float]], levels: list[int], base: float, rate: float, trees: list[Tree]) -> BoostedTrees:
        made = {"edges": edges, "levels": levels, "base": base, "rate": rate, "trees": [[t.feature, t.left, t.value] for t in trees]}
        return cls(ensemble=json.dumps(made))

    @property
    def parts(self) -> dict:
        return json.loads(self.getOrDefault(self.ensemble))

    @property
    def trees(self) -> list[Tree]:
        return [Tree(*parts) for parts in self.parts["trees"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts, trees = self.parts, self.trees
        edges, levels = [np.array(e) for e in parts["edges"]], parts["levels"]
        base, rate, width = parts["base"], parts["rate"], max(_bins(edges, levels), default=1)
        tables: list[tuple[np.ndarray, np.ndarray]] = []  # made once a task

        @F.arrow_udf("double")
        def predicted(features: pa.Array) -> pa.Array:
            codes = coded(features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), len(levels)), edges, levels)
            total = np.full(len(features), base)
            if not tables:
                tables.extend(tree.table(width) for tree in trees)
            for tree, table in zip(trees, tables, strict=True):
                total += rate * tree.predict(codes, table)
            return pa.array(total)

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))


def coded(values: np.ndarray, edges: list[np.ndarray], levels: list[int]) -> np.ndarray:
    """Bin of every value: a column of the result a row. A level that was not seen is the last one."""
    codes = np.empty((values.shape[1], values.shape[0]), np.uint16)
    for nth, (edge, level) in enumerate(zip(edges, levels, strict=True)):
        codes[nth] = np.clip(values[:, nth], 0, level - 1) if level else np.searchsorted(edge, values[:, nth])
    return codes


def _bins(edges: list, levels: list[int]) -> list[int]:
    """Number of bins of every feature."""
    return [level or len(edge) + 1 for edge, level in zip(edges, levels, strict=True)]


def _nominal(df: DataFrame, features: str) -> dict[int, int]:
    """Number of levels of the nominal features of a vector column, by place."""
    named = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return {a["idx"]: a.get("num_vals") or len(a["vals"]) for a in named}


@dataclass(frozen=True)
class Binning:
    edges: list[list[float]]
    levels: list[int]
    rows: int
    base: float
    largest: float
    heaviest: float


def binning(df: DataFrame, target: str, weight: str | None = None, features: str = "features") -> Binning:
    """Bin edges at equal shares of the rows (all values, if few), and what the target needs, in one pass."""
    nominal = _nominal(df, features)
    first = df.select(features).first()
    if first is None:
        raise ValueError("no rows to train on")
    values = vector_to_array(features)
    shares = [k / BINS for k in range(1, BINS)]
    w = F.col(weight) if weight else F.lit(1.0)
    wanted = {f"e{i}": F.percentile_approx(values[i], shares, 10_000) for i in range(len(first[0])) if i not in nominal}
    sums = {"rows": F.count("*"), "base": F.sum(F.col(target) * w) / F.sum(w), "largest": F.max(F.abs(target)), "heaviest": F.max(w)}
    row = df.agg(*[column.alias(name) for name, column in (wanted | sums).items()]).first()
    edges = [sorted(set(row[f"e{i}"])) if i not in nominal else [] for i in range(len(first[0]))]
    levels = [nominal.get(i, 0) for i in range(len(first[0]))]
    return Binning(edges, levels, row["rows"], float(row["base"]), float(row["largest"]), float(row["heaviest"]))


def _blocks(df: DataFrame, bins: Binning, target: str, weight: str | None, features: str, before: BoostedTrees | None) -> DataFrame:
    """Binned rows in blocks of bounded size, written: codes, target, weight, prediction so far and a hash of each row."""
    w = F.col(weight) if weight else F.lit(1.0)
    values = vector_to_array(features)
    rows = df.select(values.alias("x"), F.col(target).cast("double").alias("y"), w.cast("double").alias("w"), F.xxhash64(values, target).alias("key"))
    edges, levels = [np.array(e) for e in bins.edges], bins.levels
    base, rate, trees = (before.parts["base"], before.parts["rate"], before.trees) if before else (bins.base, 0.0, [])

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        flat = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        codes = coded(flat.reshape(table.num_rows, len(levels)), edges, levels)
        score = np.full(table.num_rows, base)
        for tree in trees:
            score += rate * tree.predict(codes)
        cells = [codes, *(table[name].to_numpy() for name in ("y", "w")), score, table["key"].to_numpy()]
        return pa.RecordBatch.from_arrays([pa.array([cell.tobytes()], pa.binary()) for cell in cells], ["codes", "y", "w", "score", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block(held)
                held = []
        if any(b.num_rows for b in held):
            yield block(held)

    return cut_lineage(rows.mapInArrow(read, "codes binary, y binary, w binary, score binary, key binary"), **LARGE_ROWS)


def _opened(batch: pa.RecordBatch, row: int, width: int) -> tuple[np.ndarray, ...]:
    kinds = (np.uint16, np.float64, np.float64, np.float64, np.uint64)
    codes, *rest = (np.frombuffer(batch.column(i)[row].as_py(), kind) for i, kind in enumerate(kinds))
    return codes.reshape(width, -1), *rest


def _drawn(keys: np.ndarray, tree: int, growth: Growth) -> np.ndarray:
    """The rows that a tree is fitted on, by a hash of their values."""
    if growth.rows >= 1:
        return np.ones(len(keys), bool)
    x = keys + np.uint64((growth.seed * 1_000_003 + tree + 1) * int(_MIX[0]) & (1 << 64) - 1)
    for shift, factor in ((30, _MIX[1]), (27, _MIX[2])):
        x = (x ^ (x >> np.uint64(shift))) * factor
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(growth.rows * (1 << 64)))


def split_gains(g: np.ndarray, h: np.ndarray, n: np.ndarray, growth: Growth) -> np.ndarray:
    """Gain of sending the first 1, 2, ... bins (last axis) to the left; -inf where a child is too small."""
    left, total = [np.cumsum(x, axis=-1)[..., :-1] for x in (g, h, n)], [x.sum(axis=-1, keepdims=True) for x in (g, h, n)]
    right = [t - x for t, x in zip(total, left, strict=True)]

    def worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / np.where(h + growth.l2 > 0, h + growth.l2, np.inf)

    gain = worth(left[0], left[1]) + worth(right[0], right[1]) - worth(total[0], total[1])
    small = np.minimum(left[2], right[2]) < max(growth.leaf, 1)
    return np.where(small | (np.minimum(left[1], right[1]) < growth.child_weight), -np.inf, gain)


def best_splits(histogram: np.ndarray, nominal: bool, growth: Growth) -> list[tuple[int, float, list[int], list[float]]]:
    """For (3, nodes, bins) sums: (node, gain, codes that go left, sums on the left and in all); one shared split for symmetric trees."""
    g, h, n = histogram
    shared = growth.way == "symmetric"
    if nominal:
        ratio_g, ratio_h = (x.sum(axis=0, keepdims=True) if shared else x for x in (g, h))
        ratio = np.where(ratio_h > 0, ratio_g / np.where(ratio_h > 0, ratio_h, 1), np.inf)
        order = np.broadcast_to(np.argsort(ratio, axis=1, kind="stable"), g.shape)
    else:
        order = np.broadcast_to(np.arange(g.shape[1]), g.shape)
    g, h, n = (np.take_along_axis(x, order, axis=1) for x in (g, h, n))
    gains = split_gains(g, h, n, growth)
    if shared:
        # a node that the split leaves whole gains nothing and does not rule it out
        summed = np.where(np.isfinite(gains), gains, 0).sum(axis=0)
        place = np.full(len(gains), int(np.argmax(summed)))
        best = np.full(len(gains), float(summed.max(initial=0)))
    else:
        place = np.argmax(gains, axis=1)
        best = gains[np.arange(len(gains)), place]
    out = []
    for node, (at, gain) in enumerate(zip(place.tolist(), best.tolist(), strict=True)):
        if gain > LEAST_GAIN:
            sums = [float(x) for part in (g, h, n) for x in (part[node, : at + 1].sum(), part[node].sum())]
            out.append((node, gain, order[node, : at + 1].tolist() if nominal else [at], sums))
    return out


class _Level:
    """The sums of one level of a tree: per chosen feature gradient, hessian and count per (active node, bin)."""

    def __init__(self, bins: Binning, growth: Growth, number: int, tree: Tree, active: list[int]):
        self.growth, self.levels, self.tree = growth, bins.levels, tree
        self.chosen = _chosen(bins, growth, number)
        self.slot = np.full(len(tree.feature), -1)
        self.slot[active] = np.arange(len(active))
        count = _bins(bins.edges, bins.levels)
        self.shapes = {feature: (3, len(active), count[feature]) for feature in self.chosen}
        # sums on this grid are exact, whatever the order
        self.grid, self.weights = (2.0 ** (51 - np.ceil(np.log2(max(bins.rows * x, 1e-300)))) for x in (4 * bins.largest * bins.heaviest, bins.heaviest))

    def empty(self) -> dict[int, np.ndarray]:
        return {feature: np.zeros(shape) for feature, shape in self.shapes.items()}

    def add(self, sums: dict[int, np.ndarray], codes: np.ndarray, y: np.ndarray, w: np.ndarray, score: np.ndarray, drawn: np.ndarray, at: np.ndarray) -> None:
        """Rows of one block, ``at`` being the node of each."""
        at = self.slot[at]
        here = np.flatnonzero((at >= 0) & drawn)
        g = np.round((score[here] - y[here]) * w[here] * self.grid) / self.grid
        h = np.round(w[here] * self.weights) / self.weights
        at = at[here]
        for feature, part in sums.items():
            _, nodes, depth = part.shape
            cell = at * depth + codes[feature, here]
            for k, values in enumerate((g, h, None)):
                part[k] += np.bincount(cell, values, nodes * depth).reshape(nodes, depth)

    def splits(self, sums: dict[int, np.ndarray]) -> list[tuple]:
        return [(feature, *split) for feature, part in sums.items() if part.shape[2] > 1 for split in best_splits(part, self.levels[feature] > 0, self.growth)]


def _chosen(bins: Binning, growth: Growth, number: int) -> list[int]:
    """The features that a tree may use."""
    width = len(bins.levels)
    if growth.columns >= 1:
        return list(range(width))
    count = max(1, round(growth.columns * width))
    return sorted(np.random.default_rng([growth.seed, number]).choice(width, count, replace=False).tolist())


def _level(blocks: DataFrame, bins: Binning, growth: Growth, number: int, tree: Tree, active: list[int], pending: list[Tree]) -> list[tuple]:
    """The best split of every active node and feature: one job."""
    level, width = _Level(bins, growth, number, tree, active), len(bins.levels)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for row in range(batch.num_rows):
                codes, y, w, score, key = _opened(batch, row, width)
                for done in pending:
                    score = score + growth.rate * done.predict(codes)
                sums = sums or level.empty()
                level.add(sums, codes, y, w, score, _drawn(key, number, growth), tree.nodes(codes))
        for feature, part in (sums or {}).items():
            yield pa.RecordBatch.from_arrays([pa.array([feature], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["feature", "sums"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for feature, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums = np.frombuffer(raw.as_py()).reshape(level.shapes[feature])
                total[feature] = total[feature] + sums if feature in total else sums
        rows = level.splits(total)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows, strict=True)], ["feature", "node", "gain", "left", "sums"])

    parts = blocks.mapInArrow(add_up, "feature int, sums binary").repartition("feature")
    return parts.mapInArrow(choose, "feature long, node long, gain double, left array<bigint>, sums array<double>").collect()


def _grow(level: Callable[[Tree, list[int]], list[tuple]], bins: Binning, growth: Growth) -> Tree:
    """One tree; ``level`` finds the best split of every active node and feature."""
    tree, gains, active = Tree(), {}, [0]
    for _ in range(growth.depth):
        found = level(tree, active)
        best: dict[int, tuple] = {}
        for feature, node, gain, left, sums in sorted(map(tuple, found), key=lambda r: (-r[2], r[0], r[1])):
            best.setdefault(int(node), (feature, gain, left, sums))
        if growth.way == "symmetric" and best:
            shared = next(iter(best.values()))[0]
            best = {int(r[1]): (r[0], r[2], r[3], r[4]) for r in map(tuple, found) if r[0] == shared}
        following = []
        for slot, (feature, gain, left, (gl, g, hl, h, nl, n)) in sorted(best.items()):
            node = active[slot]
            goes = [int(c) for c in left] if bins.levels[feature] else int(left[0])
            if node == 0:
                tree.value[0] = -g / (h + growth.l2)
            # a symmetric split may leave a child without rows: it keeps its parent's value
            values = tuple(-a / (b + growth.l2) if c > 0 else tree.value[node] for a, b, c in ((gl, hl, nl), (g - gl, h - hl, n - nl)))
            tree.grow(node, int(feature), goes, values)
            gains[node] = gain
            following += [child for child, rows in ((2 * node + 1, nl), (2 * node + 2, n - nl)) if rows > 0]
        if not following:
            break
        active = following
    return _best_first(tree, gains, growth.leaves) if growth.way == "leaves" else tree


def _best_first(tree: Tree, gains: dict[int, float], leaves: int) -> Tree:
    """The tree whose leaf of greatest gain was always split next, up to a number of leaves."""
    kept, open_ = set(), {0} & gains.keys()
    while open_ and len(kept) + 1 < leaves:
        node = min(open_, key=lambda i: (-gains[i], i))
        kept.add(node)
        open_ = (open_ - {node}) | ({2 * node + 1, 2 * node + 2} & gains.keys())
    size = max((2 * node + 3 for node in kept), default=1)
    feature = [tree.feature[i] if i in kept else -1 for i in range(size)]
    return Tree(feature, [tree.left[i] if i in kept else 0 for i in range(size)], tree.value[:size])


def _rescored(blocks: DataFrame, width: int, rate: float, trees: list[Tree]) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for row in range(batch.num_rows):
                codes, _, _, score, _ = _opened(batch, row, width)
                scores.append((score + rate * sum(tree.predict(codes) for tree in trees)).tobytes())
            yield batch.set_column(3, "score", pa.array(scores, pa.binary()))

    return cut_lineage(blocks.mapInArrow(add, blocks.schema), **LARGE_ROWS)


def _dealt(blocks: DataFrame) -> DataFrame:
    return blocks.coalesce(TASKS_PER_CORE * blocks.sparkSession.sparkContext.defaultParallelism)


def _grown_in_steps(blocks: DataFrame, bins: Binning, growth: Growth, first: int) -> list[Tree]:
    """The trees by one job a level."""
    blocks = _dealt(blocks)
    trees: list[Tree] = []
    pending: list[Tree] = []
    for turn in range(growth.rounds):
        tree = _grow(lambda tree, active: _level(blocks, bins, growth, first + turn, tree, active, pending), bins, growth)
        trees.append(tree)
        pending.append(tree)
        if len(pending) == REFRESH and turn + 1 < growth.rounds:
            blocks, pending = _dealt(_rescored(blocks, len(bins.levels), growth.rate, pending)), []
    return trees


def _grown_in_one_task(blocks: DataFrame, bins: Binning, growth: Growth, first: int) -> list[Tree]:
    """The same trees by one task that holds all blocks."""
    width = len(bins.levels)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_opened(batch, row, width) for batch in batches for row in range(batch.num_rows)]
        if not parts:
            return
        codes, y, w, score, key = (np.concatenate(part, axis=-1) for part in zip(*parts, strict=True))
        del parts
        # predictions are added up as they are where trees are pending
        running, total = score, np.zeros(len(score))
        for turn in range(growth.rounds):
            drawn, at = _drawn(key, first + turn, growth), None

            def level(tree: Tree, active: list[int]) -> list[tuple]:
                nonlocal at
                step, at = _Level(bins, growth, first + turn, tree, active), tree.nodes(codes, at=at)
                sums = step.empty()
                step.add(sums, codes, y, w, running, drawn, at)
                return step.splits(sums)

            tree = _grow(level, bins, growth)
            yield pa.RecordBatch.from_arrays([pa.array([turn], pa.int32()), pa.array([json.dumps([tree.feature, tree.left, tree.value])])], ["turn", "tree"])
            worth = tree.predict(codes)
            running, total = running + growth.rate * worth, total + worth
            if turn % REFRESH == REFRESH - 1:
                score = score + growth.rate * total
                running, total = score, np.zeros(len(score))

    made = blocks.coalesce(1).mapInArrow(grow, "turn int, tree string").collect()
    found = [Tree(*json.loads(row["tree"])) for row in sorted(made, key=lambda row: row["turn"])]
    return found or [Tree() for _ in range(growth.rounds)]


def fit(
    df: DataFrame,
    growth: Growth,
    target: str,
    weight: str | None = None,
    features: str = "features",
    bins: Binning | None = None,
    before: BoostedTrees | None = None,
) -> BoostedTrees:
    """Boost ``growth.rounds`` trees on a frame with a feature vector and a target, after those of ``before`` if given.

    A target or weight that is null counts in no sum. ``bins`` of a larger frame may be given; with ``before`` they must be its bins.
    """
    rows = df.filter(F.col(target).isNotNull() & (F.col(weight).isNotNull() if weight else F.lit(True)))
    bins = bins or binning(rows, target, weight, features)
    bounded_batches(df.sparkSession)
    blocks = _blocks(rows, bins, target, weight, features, before)
    small = bins.rows * (2 * len(bins.levels) + 32) <= ONE_TASK_BYTES
    trees = (_grown_in_one_task if small else _grown_in_steps)(blocks, bins, growth, len(before.trees) if before else 0)
    base = before.parts["base"] if before else bins.base
    model = BoostedTrees.of(bins.edges, bins.levels, base, growth.rate, (before.trees if before else []) + trees)
    return model._set(featuresCol=features)
