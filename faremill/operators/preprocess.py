"""Fitted preprocessing: impute, scale and one-hot encode the model features.

Statistics are aggregates over the training rows and small (one row per feature); they are baked
into a persistable ``PipelineModel`` so that training, evaluation and streams share one transform.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from faremill.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from faremill.functions.trip import number
from faremill.operators.dictionary import dense_ids
from faremill.operators.features import with_trip_features
from faremill.operators.quantiles import summaries
from faremill.session import cut_lineage

FEATURES = "features"
#: The categories that tree learners take as nominal columns: those of a closed domain.
NOMINAL = tuple(name for name in CATEGORICAL_FEATURES if name != "route_id")


def numeric_statistics(features: DataFrame) -> DataFrame:
    """Per numeric feature: the median that fills gaps, then mean and population std of the filled values."""
    values = {name: number(F.col(name)) for name in NUMERIC_FEATURES}
    sums = summaries(
        features, values, [0.5], per_column=lambda v: {"avg": F.avg(v), "var": F.var_pop(v)}, extra={"rows": F.count("*")}
    )
    known = sums.filter("rows > 0").select("*", F.col("quantiles")[0].alias("median"))
    # a feature without a value is filled with zero
    stats = known.withColumns(
        {"gaps": 1 - F.col("n") / F.col("rows")} | {name: F.coalesce(name, F.lit(0.0)) for name in ("median", "avg", "var")}
    )
    # Filling a share of the rows with one value moves mean and variance in closed form.
    gaps, apart = F.col("gaps"), F.col("median") - F.col("avg")
    return stats.select(
        "column",
        "median",
        (F.col("avg") + gaps * apart).alias("mean"),
        F.sqrt((1 - gaps) * F.col("var") + gaps * (1 - gaps) * apart * apart).alias("std"),
    )


def category_counts(features: DataFrame) -> DataFrame:
    """Rows per categorical feature and value, combined before they are shuffled."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
            for name in CATEGORICAL_FEATURES
        ]
    )
    return (
        features.select(F.inline(cells))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def category_statistics(features: DataFrame) -> DataFrame:
    """Per categorical feature: most frequent value (the smallest of a tie) and number of levels."""
    return _most_frequent(category_counts(features))


def _most_frequent(counts: DataFrame) -> DataFrame:
    rank = F.struct(-F.col("n"), F.col("value").try_cast("bigint"), F.col("value"))
    return counts.groupBy("column").agg(F.min_by("value", rank).alias("most_frequent"), F.count("*").alias("levels"))


def category_dictionary(features: DataFrame) -> DataFrame:
    """(column, value, n, id) of every categorical value; ids are dense within a column, in the order of the values."""
    return dense_ids(category_counts(features))


def _labels(counts: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """The sorted values of columns whose encoder holds them all: ids of a closed domain (fleets, zones, pairs of zones)."""
    rows = counts.filter(F.col("column").isin(names)).select("column", "value").collect()
    found: dict[str, list[str]] = {name: [] for name in names}
    for row in rows:
        found[row["column"]].append(row["value"])
    return {name: sorted(values) for name, values in found.items()}


def _fill_and_scale(numeric: list[Row], categories: list[Row]) -> SQLTransformer:
    parts = []
    for row in numeric:
        name, spread = row["column"], row["std"] if row["std"] > 0 else 1.0
        parts.append(
            f"(coalesce(cast({name} AS double), {row['median']!r}D) - {row['mean']!r}D) / {spread!r}D AS {name}_scaled"
        )
    for row in categories:
        filled = row["most_frequent"].replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"coalesce(cast({row['column']} AS string), '{filled}') AS {row['column']}_known")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def fit_preprocessor(features: DataFrame, nominal_levels: int = 0, hashed_width: int = 0) -> PipelineModel:
    """Fit on a frame with the model features.

    Every category is one-hot encoded; a value not seen here becomes all zeros. Tree learners keep
    one bin per feature and row, so tens of thousands of one-hot columns do not suit them: with
    ``nominal_levels`` (the learner's ``maxBins``) the columns of ``NOMINAL`` are one nominal column each,
    and the route is left out, being the pair of the two zones. With ``hashed_width`` all categories share that many
    slots, chosen by hash, and no list of values is gathered anywhere: for categories of unbounded many values. There, a value
    not seen here falls into some slot. The encoding never depends on the rows; rows that do not suit it are an error.
    """
    numeric = numeric_statistics(features).collect()  # one row per feature
    counts = cut_lineage(category_counts(features))
    categories = _most_frequent(counts).collect()  # one row per feature
    if not numeric or len(categories) < len(CATEGORICAL_FEATURES):
        raise ValueError("no rows to fit on")
    nominal = list(NOMINAL) if nominal_levels else []
    wide = [] if nominal_levels or hashed_width else list(CATEGORICAL_FEATURES)
    labels = _labels(counts, nominal + wide)
    for name in nominal:
        if len(labels[name]) >= nominal_levels:  # one level is for values not seen here
            raise ValueError(f"{name} has {len(labels[name])} levels, more than {nominal_levels - 1}")
    indexed = nominal + wide
    stages = [
        _fill_and_scale(numeric, categories),
        *[
            StringIndexerModel.from_labels(
                labels[name], inputCol=f"{name}_known", outputCol=f"{name}_index", handleInvalid="keep"
            )
            for name in indexed
        ],
    ]
    if wide:
        # The unseen slot is the last one; dropping it turns an unseen value into all zeros.
        stages.append(
            OneHotEncoder(
                inputCols=[f"{name}_index" for name in wide],
                outputCols=[f"{name}_hot" for name in wide],
                dropLast=True,
            )
        )
    hashed = [f"{name}_known" for name in CATEGORICAL_FEATURES] if hashed_width and not nominal else []
    if hashed:
        stages.append(FeatureHasher(inputCols=hashed, outputCol="hashed", numFeatures=hashed_width, categoricalCols=hashed))
    stages.append(
        VectorAssembler(
            inputCols=[
                *[f"{name}_scaled" for name in NUMERIC_FEATURES],
                *[f"{name}_index" for name in nominal],
                *[f"{name}_hot" for name in wide],
                *(["hashed"] if hashed else []),
            ],
            outputCol=FEATURES,
        )
    )
    return Pipeline(stages=stages).fit(features)


def to_vectors(preprocessor: PipelineModel, trips: DataFrame, *keep: str) -> DataFrame:
    """Raw feature columns to the feature vector, with the columns to keep beside it."""
    derived = trips if "route_id" in trips.columns else with_trip_features(trips)
    return preprocessor.transform(derived).select(*keep, FEATURES)
