"""Fare regressors under the names and settings of the model catalog; all of them are storable pipeline stages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from math import ceil, log

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.contract import TARGET
from faremill.operators import boosters
from faremill.operators.boosters import BoostedTrees, Growth
from faremill.operators.preprocess import FEATURES
from faremill.session import SMALL_GROUPS, cut_lineage, shared_folder

PREDICTION = "prediction"
SEED = 42


@dataclass(frozen=True)
class Preset:
    name: str
    kind: str
    status: str
    settings: dict[str, float] = field(default_factory=dict)
    nominal_levels: int = 0
    growth: str = "level"  # how boosted trees grow

    def sized(self, rounds: int) -> Preset:
        """The same learner with another number of trees."""
        return replace(self, settings={**self.settings, "rounds": rounds})


TREE_LEVELS = 512  # zones, vendors and rate codes stay single nominal columns for trees

# ---- fixed values: the model catalog ----
CATALOG = {
    preset.name: preset
    for preset in (
        Preset("dummy_regressor", "mean", "baseline"),
        Preset("ridge_regressor", "ridge", "archived", {"alpha": 1.0}),
        Preset("sgd_regressor", "linear", "baseline", {"alpha": 0.0001}),
        Preset("random_forest", "forest", "recommended", {"rounds": 250, "depth": 12, "leaf": 20}, TREE_LEVELS),
        Preset("adaboost", "adaboost", "archived", {"rounds": 150, "depth": 4, "rate": 0.05}, TREE_LEVELS),
        Preset(
            "gradient_boosting",
            "boosting",
            "recommended",
            {"rounds": 250, "depth": 4, "rate": 0.05, "rows": 0.8},
            TREE_LEVELS,
        ),
        Preset(
            "hist_gradient_boosting",
            "boosting",
            "recommended",
            {"rounds": 200, "depth": 6, "rate": 0.05, "leaf": 50, "leaves": 31},
            TREE_LEVELS,
            "leaves",
        ),
        Preset("bagging", "bagging", "archived", {"rounds": 60, "depth": 8, "rows": 0.7}, TREE_LEVELS),
        Preset("pasting", "pasting", "archived", {"rounds": 60, "depth": 8, "rows": 0.7}, TREE_LEVELS),
        Preset("voting", "voting", "archived", {}, TREE_LEVELS),
        Preset(
            "xgboost",
            "boosting",
            "production",
            {"rounds": 600, "depth": 6, "rate": 0.05, "rows": 0.8, "columns": 0.8, "child_weight": 5, "l2": 1.0},
            TREE_LEVELS,
        ),
        Preset(
            "lightgbm",
            "boosting",
            "recommended",
            {"rounds": 400, "depth": 6, "rate": 0.05, "rows": 0.8, "columns": 0.8, "leaf": 20, "child_weight": 0.001, "leaves": 31},
            TREE_LEVELS,
            "leaves",
        ),
        Preset(
            "catboost",
            "boosting",
            "recommended",
            {"rounds": 400, "depth": 6, "rate": 0.05, "l2": 3.0},
            TREE_LEVELS,
            "symmetric",
        ),
    )
}
CURATED = (
    "dummy_regressor",
    "sgd_regressor",
    "random_forest",
    "gradient_boosting",
    "hist_gradient_boosting",
    "xgboost",
    "lightgbm",
    "catboost",
)
PRODUCTION = "xgboost"
VOTERS = ("random_forest", "gradient_boosting", "hist_gradient_boosting")
# ---- end of fixed values ----


def fit_mean(df: DataFrame, target: str = TARGET, weight: str | None = None) -> SQLTransformer:
    """Predicts the (weighted) mean target of the training rows."""
    w = F.col(weight) if weight else F.lit(1.0)
    present = F.when(F.col(target).isNotNull(), w)
    mean = df.agg(F.sum(F.col(target) * w) / F.sum(present)).first()[0]
    if mean is None:
        raise ValueError("no rows to train on")
    return SQLTransformer(statement=f"SELECT *, {float(mean)!r}D AS {PREDICTION} FROM __THIS__")


def combined(models: Sequence[Model], expression: str) -> PipelineModel:
    """Fitted models whose predictions ``_p0``, ``_p1``, ... an SQL expression joins into one; stored like any pipeline."""
    names = [f"_p{i}" for i in range(len(models))]
    members = [model.copy({model.predictionCol: name}) for model, name in zip(models, names, strict=True)]
    statement = f"SELECT * EXCEPT ({', '.join(names)}), {expression} AS {PREDICTION} FROM __THIS__"
    return PipelineModel([*members, SQLTransformer(statement=statement)])


def mean_of(count: int) -> str:
    return f"({' + '.join(f'_p{i}' for i in range(count))}) / {count}"


def weighted_median(weights: Sequence[float]) -> str:
    """The value at which the weights of the ordered predictions reach half of their sum."""
    votes = ", ".join(f"struct(_p{i} AS value, {float(w)!r}D AS weight)" for i, w in enumerate(weights))
    half = sum(weights) / 2
    value = f"if(s.value IS NULL AND s.seen + v.weight >= {half!r}D, v.value, s.value)"
    start = "struct(0.0D AS seen, CAST(NULL AS DOUBLE) AS value)"
    step = f"(s, v) -> struct(s.seen + v.weight AS seen, {value} AS value)"
    return f"aggregate(array_sort(array({votes})), {start}, {step}, s -> s.value)"


def _tree_columns(weight: str | None, target: str) -> dict[str, object]:
    columns: dict[str, object] = {"featuresCol": FEATURES, "labelCol": target, "maxBins": TREE_LEVELS + 1}
    columns["maxMemoryInMB"] = 256  # for every task at once; nodes beyond are split in a further pass, to the same trees
    if weight:
        columns["weightCol"] = weight
    return columns


def growth(preset: Preset) -> Growth:
    s = preset.settings
    return Growth(
        rounds=int(s["rounds"]),
        depth=int(s["depth"]),
        rate=s["rate"],
        way=preset.growth,
        l2=s.get("l2", 0.0),
        leaf=int(s.get("leaf", 1)),
        child_weight=s.get("child_weight", 0.0),
        leaves=int(s.get("leaves", 0)),
        rows=s.get("rows", 1.0),
        columns=s.get("columns", 1.0),
        seed=SEED,
    )


def forest(preset: Preset, target: str = TARGET, weight: str | None = None) -> RandomForestRegressor:
    s = preset.settings
    return RandomForestRegressor(
        **_tree_columns(weight, target),
        numTrees=int(s["rounds"]),
        maxDepth=int(s["depth"]),
        minInstancesPerNode=int(s.get("leaf", 1)),
        subsamplingRate=s.get("rows", 1.0),
        bootstrap=preset.kind != "pasting",
        featureSubsetStrategy="all",
        checkpointInterval=10,
        seed=SEED,
    )


def ridge(alpha: float, rows: int, target: str = TARGET, weight: str | None = None) -> LinearRegression:
    """Squared error plus alpha times the squared coefficients, intercept free."""
    return _linear(alpha / rows, target, weight)


def _linear(penalty: float, target: str, weight: str | None) -> LinearRegression:
    learner = LinearRegression(
        featuresCol=FEATURES,
        labelCol=target,
        regParam=penalty,
        elasticNetParam=0.0,
        standardization=False,
        solver="l-bfgs",
        maxIter=200,
    )
    return learner.setWeightCol(weight) if weight else learner


def ready_checkpoints(df: DataFrame) -> None:
    """Forests and AdaBoost cut their lineage in the shared folder; name it where the session has not."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))


def fit_adaboost(df: DataFrame, preset: Preset, target: str = TARGET, weight: str | None = None) -> PipelineModel:
    """AdaBoost.R2 with linear loss: rows are reweighted by their error, trees vote by weighted median."""
    ready_checkpoints(df)
    rate, depth = preset.settings["rate"], int(preset.settings["depth"])
    first = F.col(weight) if weight else F.lit(1.0)
    rows = df.select(FEATURES, F.col(target).cast("double").alias(target), first.cast("double").alias("_w"))
    trees: list[Model] = []
    votes: list[float] = []
    for turn in range(int(preset.settings["rounds"])):
        columns = _tree_columns("_w", target)
        tree = DecisionTreeRegressor(**columns, maxDepth=depth, seed=SEED, predictionCol="_p").fit(rows)
        error = F.abs(F.col("_p") - F.col(target))
        scored = tree.transform(rows)
        # one pass: the mean loss is the weighted mean error over the largest one
        worst, wrong, mass, mean_mass = scored.agg(F.max(error), F.sum(error * F.col("_w")), F.sum("_w"), F.avg("_w")).first()
        if not worst:  # nothing left to correct
            trees.append(tree)
            votes.append(1.0)
            break
        mean_loss = wrong / worst / mass
        if mean_loss >= 0.5 and trees:
            break
        trees.append(tree)
        if mean_loss >= 0.5:
            votes.append(1.0)
            break
        beta = mean_loss / (1.0 - mean_loss)
        votes.append(rate * log(1.0 / beta))
        # The tree only depends on relative weights; dividing by their mean keeps them near 1.
        lighter = F.pow(F.lit(beta), (1 - error / F.lit(worst)) * rate)
        following = scored.select(FEATURES, target, (F.col("_w") * lighter / F.lit(mean_mass)).alias("_w"))
        # a table of its own for every tree: caches of the turns would fill the executors
        rows = cut_lineage(following, **SMALL_GROUPS)
    return combined(trees, weighted_median(votes))


def fit_continued(
    df: DataFrame,
    preset: Preset,
    strata: Iterable[Column],
    target: str = TARGET,
    weight: str | None = None,
) -> BoostedTrees:
    """Continued boosting: every stratum in turn adds its share of the rounds to the trees there are.

    All strata share the bins of the whole frame, so a stratum of any size can be trained. Strata without rows are left out.
    """
    strata = list(strata)
    sizes = df.agg(*[F.count_if(stratum).alias(str(i)) for i, stratum in enumerate(strata)]).first()
    parts = [stratum for stratum, size in zip(strata, sizes, strict=True) if size]
    if not parts:
        raise ValueError("no rows to train on")
    share = growth(preset.sized(max(1, ceil(preset.settings["rounds"] / len(parts)))))
    bins = boosters.binning(df, target, weight, FEATURES)
    model = None
    for stratum in parts:
        model = boosters.fit(df.filter(stratum), share, target, weight, FEATURES, bins, model)
    return model


def fit_preset(df: DataFrame, preset: Preset, target: str = TARGET, weight: str | None = None):
    """Fit a catalog entry on a frame with the feature vector and the target."""
    if preset.kind == "mean":
        return fit_mean(df, target, weight)
    if preset.kind == "ridge":
        return ridge(preset.settings["alpha"], df.count(), target, weight).fit(df)
    if preset.kind == "linear":
        return _linear(preset.settings["alpha"], target, weight).fit(df)
    if preset.kind == "boosting":
        return boosters.fit(df, growth(preset), target, weight, FEATURES)
    ready_checkpoints(df)
    if preset.kind in ("forest", "bagging", "pasting"):
        return forest(preset, target, weight).fit(df)
    if preset.kind == "adaboost":
        return fit_adaboost(df, preset, target, weight)
    if preset.kind == "voting":
        rounds = preset.settings.get("rounds")
        members = [CATALOG[name].sized(rounds) if rounds else CATALOG[name] for name in VOTERS]
        return combined([fit_preset(df, member, target, weight) for member in members], mean_of(len(members)))
    raise ValueError(f"unknown kind of learner: {preset.kind}")
