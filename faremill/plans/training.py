"""Training jobs: fit, evaluate by split, benchmark the catalog, produce the served model."""

from __future__ import annotations

import json
import time
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from faremill.contract import CONTRACT_VERSION, TARGET, feature_audit
from faremill.operators.features import refuse_leakage, with_trip_features
from faremill.operators.learners import CATALOG, CURATED, PREDICTION, PRODUCTION, Preset, fit_preset
from faremill.operators.metrics import metrics_by_grains, regression_metrics
from faremill.operators.preprocess import FEATURES, fit_preprocessor, to_vectors
from faremill.operators.reports import fleet_weight_map, with_fleet_weight
from faremill.operators.sampling import stratified_train_sample
from faremill.operators.splits import split, window_start, with_split
from faremill.session import SMALL_GROUPS, cut_lineage
from faremill.settings import Settings
from faremill.sources import ledger, snapshots


#: Learners that draw rows by partition and place: other partitions make other trees, so they see those that the rows come in.
DRAWN_BY_PLACE = ("forest", "bagging", "pasting")


@dataclass
class Trained:
    preset: Preset
    preprocessor: PipelineModel
    model: object
    weights: dict[str, float]
    rows: int

    def predict(self, trips: DataFrame, *keep: str) -> DataFrame:
        vectors = to_vectors(self.preprocessor, trips, *keep)
        return self.model.transform(vectors).select(*keep, PREDICTION)


def training_rows(obt: DataFrame, settings: Settings) -> DataFrame:
    """The training split, all of it unless the settings ask for a stratified sample."""
    refuse_leakage(obt.columns)
    train = split(obt, "train", settings)
    if settings.train_sample_limit:
        train = stratified_train_sample(train, settings.train_sample_limit, settings)
    return train


def stored_vectors(vectors: DataFrame) -> DataFrame:
    """The vectors as a table of small row groups: learners read it again and again, in tasks of bounded size.

    A cache would hold what a task made as one block: executors fill up with them, and pass them on whole. The names of the vector's
    slots, of which there may be very many, stay out of the files' footers.
    """
    names = vectors.schema[FEATURES].metadata
    others = [name for name in vectors.columns if name != FEATURES]
    stored = cut_lineage(vectors.select(*others, F.col(FEATURES).alias(FEATURES, metadata={"slots": "elsewhere"})), **SMALL_GROUPS)
    return stored.select(*others, F.col(FEATURES).alias(FEATURES, metadata=names))


def train(rows: DataFrame, preset: Preset, preprocessor: PipelineModel | None = None) -> Trained:
    """Fit preprocessing (unless given) and a weighted model on training rows."""
    features = with_trip_features(rows)
    preprocessor = preprocessor or fit_preprocessor(features, preset.nominal_levels)
    weights = fleet_weight_map(rows)
    weighted = with_fleet_weight(features, weights)
    made = to_vectors(preprocessor, weighted, TARGET, "weight")
    vectors = made.persist() if preset.kind in DRAWN_BY_PLACE else stored_vectors(made)
    try:
        count = vectors.count()
        if count == 0:
            raise ValueError("no rows to train on")
        model = fit_preset(vectors, preset, TARGET, "weight")
    finally:
        vectors.unpersist()
    return Trained(preset, preprocessor, model, weights, count)


def predictions(trained: Trained, obt: DataFrame, settings: Settings, *keep: str) -> DataFrame:
    """Validation and test predictions, stored once so that several metrics can share them."""
    held_out = with_split(obt, settings).filter(F.col("split") != "train")
    return cut_lineage(trained.predict(held_out, "split", TARGET, *keep))


def _require_both(evaluated: Collection[str]) -> None:
    missing = sorted({"validation", "test"} - set(evaluated))
    if missing:
        raise ValueError("nothing to evaluate: no rows in " + ", ".join(missing))


def strategy(settings: Settings) -> str:
    return "sample" if settings.train_sample_limit else "all_rows"


def evaluate_by_grain(trained: Trained, obt: DataFrame, settings: Settings) -> DataFrame:
    """Errors of a trained model per split, by evaluation window of ``settings.grain``, by fleet, by both, and in all."""
    scored = predictions(trained, obt, settings, "trip_type", "pickup_datetime")
    window = F.lit(None).cast("date")
    for name in ("validation", "test"):
        first, _ = settings.split_ranges[name]
        window = F.when(F.col("split") == name, window_start(first, settings.grain)).otherwise(window)
    rows = scored.withColumn("window_start", window)
    grains = [["split"], ["split", "window_start"], ["split", "trip_type"], ["split", "window_start", "trip_type"]]
    return metrics_by_grains(rows, grains, PREDICTION, TARGET)


def benchmark(
    obt: DataFrame,
    settings: Settings,
    presets: Sequence[Preset] = tuple(CATALOG[name] for name in CURATED),
    ledger_root: str | None = None,
    again: bool = False,
) -> DataFrame:
    """One training run per preset: validation and test error, best validation first.

    With a ledger, every run is noted as soon as it is done, presets that it has under this contract are not run again
    (unless ``again``; the newer run then counts), and a benchmark that broke off goes on where it stopped. Rows, weights
    and vectors are made once for every encoding, not for every preset.
    """
    spark = obt.sparkSession
    noted: dict[str, Row] = {}
    if ledger_root:
        noted = {row["model"]: row for row in ledger.current_entries(ledger.read_entries(spark, ledger_root)).collect()}
    done = {name for name, row in noted.items() if row["contract_version"] == CONTRACT_VERSION and not again}
    todo = [preset for preset in presets if preset.name not in done]
    lines = [noted[preset.name] for preset in presets if preset.name in done]
    rows = training_rows(obt, settings)
    weights = fleet_weight_map(rows) if todo else {}
    for levels in dict.fromkeys(preset.nominal_levels for preset in todo):
        encoded = encode(rows, obt, settings, levels, weights)
        for preset in [preset for preset in todo if preset.nominal_levels == levels]:
            started = time.monotonic()
            count, rmse = encoded.run(preset)
            run = (noted[preset.name]["run"] if preset.name in noted else 0) + 1
            errors = (rmse["validation"], rmse["test"], CONTRACT_VERSION, preset.status, strategy(settings))
            fleets = ",".join(settings.fleets), json.dumps(weights, sort_keys=True), settings.zone_lookup
            line = spark.createDataFrame([(preset.name, run, count, *errors, *fleets, time.monotonic() - started)], ledger.ENTRIES)
            if ledger_root:
                ledger.append_entries(line, ledger_root)
            lines.append(line.first())
    shown = ("model", "status", "sample_rows", "val_rmse", "test_rmse", "contract_version")
    table = spark.createDataFrame([tuple(row[name] for name in ledger.ENTRIES.fieldNames()) for row in lines], ledger.ENTRIES)
    return table.select(*shown).orderBy("val_rmse")


@dataclass
class Encoded:
    """Training and evaluation rows as vectors of one encoding; the training rows are a table that all presets read."""

    training: DataFrame
    rows: int
    held_out: DataFrame

    def run(self, preset: Preset) -> tuple[int, dict[str, float]]:
        """Rows trained on, and the error of each held-out split."""
        model = fit_preset(self.training, preset, TARGET, "weight")
        error = F.col(TARGET) - F.col(PREDICTION)
        found = model.transform(self.held_out).groupBy("split").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
        rmse = {row["split"]: row["rmse"] for row in found.collect()}  # two rows
        _require_both(rmse)
        return self.rows, rmse


def encode(rows: DataFrame, obt: DataFrame, settings: Settings, levels: int, weights: dict[str, float]) -> Encoded:
    features = with_trip_features(rows)
    preprocessor = fit_preprocessor(features, levels)
    vectors = stored_vectors(to_vectors(preprocessor, with_fleet_weight(features, weights), TARGET, "weight"))
    count = vectors.count()
    if count == 0:
        raise ValueError("no rows to train on")
    held_out = with_split(obt, settings).filter(F.col("split") != "train")
    return Encoded(vectors, count, to_vectors(preprocessor, held_out, "split", TARGET))


def train_production(
    obt: DataFrame, settings: Settings, root: str, preset: Preset = CATALOG[PRODUCTION]
) -> DataFrame:
    """Train, evaluate validation and test once, store the model with its facts; returns the facts."""
    trained = train(training_rows(obt, settings), preset)
    scored = regression_metrics(predictions(trained, obt, settings), PREDICTION, TARGET, ["split"])
    facts: dict[str, object] = {}
    found = scored.collect()  # two rows
    _require_both([row["split"] for row in found])
    for row in found:
        prefix = "val" if row["split"] == "validation" else "test"
        facts.update({f"{prefix}_{name}": row[name] for name in ("rmse", "mae", "med_ae")})
        facts[f"{prefix}_mape"] = round(row["mape"], 2)
        facts[f"{prefix}_r2"] = round(row["r2"], 4)
    names = [f"{part}_{name}" for part in ("val", "test") for name in ("rmse", "mae", "med_ae", "mape", "r2")]
    line = (
        preset.name,
        preset.status,
        trained.rows,
        strategy(settings),
        CONTRACT_VERSION,
        ",".join(settings.fleets),
        json.dumps({fleet: round(weight, 6) for fleet, weight in trained.weights.items()}, sort_keys=True),
        json.dumps(feature_audit()),
        *[facts.get(name) for name in names],
    )
    schema = (
        "model string, status string, sample_rows bigint, training_strategy string, contract_version string, fleets string, "
        "fleet_weights string, feature_audit string, " + ", ".join(f"{name} double" for name in names)
    )
    table = obt.sparkSession.createDataFrame([line], schema)
    PipelineModel([trained.preprocessor, trained.model]).write().overwrite().save(f"{root}/model")
    table.write.mode("overwrite").parquet(f"{root}/facts")
    return table


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


SHOWN = ("val_rmse", "val_mae", "val_med_ae", "val_r2", "test_rmse")


def model_facts(spark: SparkSession, root: str) -> DataFrame:
    """What a service reports about the stored model."""
    facts = spark.read.parquet(f"{root}/facts")
    kept = ("model", "sample_rows", "training_strategy", "contract_version", "fleets")
    return facts.select(*kept, *[F.round(name, 4).alias(name) for name in SHOWN])


def service_health(spark: SparkSession, root: str) -> DataFrame:
    """One row: whether a model is stored, and its facts, which are NULL without one."""
    if snapshots.exists(spark, f"{root}/facts") and snapshots.exists(spark, f"{root}/model"):
        facts = model_facts(spark, root)
    else:
        columns = "model string, sample_rows bigint, training_strategy string, contract_version string, fleets string, "
        facts = spark.createDataFrame([(None,) * 10], columns + ", ".join(f"{name} double" for name in SHOWN))
    return facts.select(F.lit("ok").alias("status"), F.col("model").isNotNull().alias("model_loaded"), "*")
