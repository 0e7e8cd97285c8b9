from dataclasses import replace

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from faremill.contract import RAW_FEATURES
from faremill.operators import boosters, learners, preprocess, requests
from faremill.operators.features import with_trip_features
from faremill.plans import scoring, training
from faremill.session import new_folder
from tests.frames import thirty_days, trips


@pytest.fixture(scope="module")
def days(spark):
    return thirty_days(spark).persist()


def small(name, **settings):
    preset = learners.CATALOG[name]
    return replace(preset, settings={**preset.settings, **settings})


def rmse(trained, rows):
    error = F.col("fare_amount") - F.col("prediction")
    return trained.predict(rows, "fare_amount").agg(F.sqrt(F.avg(error * error))).first()[0]


def test_catalog():
    assert len(learners.CATALOG) == 13 and len(learners.CURATED) == 8
    assert learners.PRODUCTION in learners.CURATED
    assert learners.CATALOG["xgboost"].settings["rounds"] == 600


def test_statistics_match_a_direct_computation(spark):
    frame = with_trip_features(trips(spark))
    frame = frame.withColumn("passenger_count", F.when(F.col("vendor_id") == 1, F.col("passenger_count")))
    row = preprocess.numeric_statistics(frame).filter("column = 'passenger_count'").first()
    assert (row["median"], row["mean"], row["std"]) == (1.0, 1.0, 0.0)
    distance = preprocess.numeric_statistics(frame).filter("column = 'estimated_distance'").first()
    assert distance["median"] == pytest.approx(3.1)
    assert distance["mean"] == pytest.approx((1.5 + 7.2 + 3.1) / 3)
    assert distance["std"] == pytest.approx(2.40, abs=0.01)
    modes = {r["column"]: (r["most_frequent"], r["levels"]) for r in preprocess.category_statistics(frame).collect()}
    assert modes["trip_type"] == ("yellow", 2)
    assert modes["dropoff_location_id"] == ("142", 3)  # a tie: the smallest
    assert modes["vendor_id"] == ("1", 2)


def test_gaps_are_filled_in_mean_and_spread(spark):
    rows = [("yellow", "2025-01-03 08:15:00", n, 1.0, 1, 2, 1, 1, 9.0) for n in (1, 2, 6, None, None)]
    row = preprocess.numeric_statistics(with_trip_features(trips(spark, rows))).filter("column = 'passenger_count'").first()
    filled = [1, 2, 6, 2, 2]
    mean = sum(filled) / 5
    assert row["mean"] == pytest.approx(mean)
    assert row["std"] == pytest.approx((sum((x - mean) ** 2 for x in filled) / 5) ** 0.5)


def test_unseen_values_are_all_zeros(spark):
    rows = trips(spark)
    fitted = preprocess.fit_preprocessor(with_trip_features(rows.filter("trip_type = 'yellow'")))
    encoded = fitted.transform(with_trip_features(rows))
    hot = {row["trip_type"]: row["trip_type_hot"] for row in encoded.select("trip_type", "trip_type_hot").collect()}
    assert hot["yellow"] == Vectors.sparse(1, [0], [1.0])
    assert hot["green"] == Vectors.sparse(1, [], [])
    assert preprocess.to_vectors(fitted, rows).count() == 3
    with pytest.raises(ValueError, match="no rows"):
        preprocess.fit_preprocessor(with_trip_features(rows.limit(0)))


def test_linear_fit_recovers_the_fare(days):
    trained = training.train(days, learners.CATALOG["sgd_regressor"])
    assert rmse(trained, days) < 0.05
    assert trained.rows == 30 and set(trained.weights) == {"yellow", "green"}


def test_mean_is_weighted(spark, days):
    plain = learners.fit_mean(days)
    assert plain.transform(days).first()["prediction"] == pytest.approx(8 + 0.8 * 15.5)
    weighted = learners.fit_mean(days.withColumn("w", F.when(F.col("trip_type") == "yellow", 1.0).otherwise(0.0)), weight="w")
    assert weighted.transform(days).first()["prediction"] == pytest.approx(8 + 0.8 * 15)
    with pytest.raises(ValueError, match="no rows"):
        learners.fit_mean(days.limit(0))


@pytest.mark.parametrize(
    ("name", "settings"),
    [
        ("ridge_regressor", {}),
        ("random_forest", {"rounds": 5, "leaf": 1}),
        ("gradient_boosting", {"rounds": 4}),
        ("bagging", {"rounds": 3}),
        ("pasting", {"rounds": 3}),
        ("adaboost", {"rounds": 12}),
        ("xgboost", {"rounds": 3, "child_weight": 1}),
        ("hist_gradient_boosting", {"rounds": 4, "leaf": 2}),
        ("lightgbm", {"rounds": 4, "leaf": 2}),
        ("catboost", {"rounds": 4}),
        ("voting", {"rounds": 12}),
    ],
)
def test_learners_beat_the_mean(days, name, settings):
    preset = small(name, **settings)
    first = training.train(days, preset)
    spread = days.agg(F.stddev_pop("fare_amount")).first()[0]
    assert rmse(first, days) < 0.9 * spread
    if name == "xgboost":  # rows and columns are drawn at random, from a fixed seed
        again = training.train(days, preset, first.preprocessor)
        assert rmse(again, days) == pytest.approx(rmse(first, days), rel=1e-9)


def test_weighted_median_vote(spark):
    row = spark.createDataFrame([(3.0, 1.0, 2.0)], "_p0 double, _p1 double, _p2 double")

    def vote(*weights):
        return row.select(F.expr(learners.weighted_median(weights))).first()[0]

    assert vote(1.0, 1.0, 1.0) == 2.0
    assert vote(5.0, 1.0, 1.0) == 3.0
    assert vote(0.1, 5.0, 0.1) == 1.0


def test_continued_boosting_uses_every_stratum(days):
    fitted = preprocess.fit_preprocessor(with_trip_features(days), 512)
    vectors = preprocess.to_vectors(fitted, days, "fare_amount", "trip_type").persist()
    strata = [F.col("trip_type") == fleet for fleet in ("yellow", "blue", "green")]
    preset = small("xgboost", rounds=6, child_weight=1, rate=0.5)
    model = learners.fit_continued(vectors, preset, strata)
    assert len(model.trees) == 6  # the empty stratum is skipped
    error = F.col("fare_amount") - F.col("prediction")
    assert model.transform(vectors).agg(F.sqrt(F.avg(error * error))).first()[0] < 5
    few = [F.col("fare_amount") == vectors.first()["fare_amount"], F.lit(True)]
    assert len(learners.fit_continued(vectors, preset, few).trees) == 6
    with pytest.raises(ValueError, match="no rows"):
        learners.fit_continued(vectors.limit(0), small("xgboost", rounds=6), strata)


def numbers(spark, n=900, parts=5):
    """Rows of two ordered features and a nominal one of six levels."""
    rng = np.random.default_rng(1)
    x = np.c_[rng.normal(size=n).round(1), rng.random(n).round(2), rng.integers(0, 6, n)]
    y = 3 * x[:, 0] + 2 * x[:, 1] ** 2 + np.where(np.isin(x[:, 2], (1, 4)), 4, 0) + rng.normal(size=n) * 0.1
    w = rng.integers(1, 4, n).astype(float)
    rows = [(*map(float, row), float(t), float(v)) for row, t, v in zip(x, y, w)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, w double").repartition(parts)
    attribute = {"ml_attr": {"type": "nominal", "vals": list("pqrstu")}}
    df = df.withColumn("c", F.col("c").alias("c", metadata=attribute))
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df), x, y, w


def brute_split(x, g, h, l2, least):
    """Best gain over all cuts of ordered features and all ratio-ordered cuts of the nominal one."""
    def worth(at):
        return g[at].sum() ** 2 / (h[at].sum() + l2)

    everything, best = np.ones(len(g), bool), (-1.0, None, None)
    for f in range(3):
        values = np.unique(x[:, f])
        if f == 2:
            values = np.array(sorted(values, key=lambda v: g[x[:, f] == v].sum() / h[x[:, f] == v].sum()))
        for k in range(1, len(values)):
            at = np.isin(x[:, f], values[:k])
            if min(at.sum(), (~at).sum()) >= least:
                gain = worth(at) + worth(~at) - worth(everything)
                if gain > best[0] + 1e-9:
                    best = (gain, f, at)
    return best


def brute_tree(x, g, h, depth, l2, least):
    gain, _, at = brute_split(x, g, h, l2, least) if depth else (-1, None, None)
    if gain <= boosters.LEAST_GAIN:
        return np.full(len(g), -g.sum() / (h.sum() + l2))
    out = np.empty(len(g))
    out[at], out[~at] = (brute_tree(x[m], g[m], h[m], depth - 1, l2, least) for m in (at, ~at))
    return out


@pytest.mark.parametrize(("l2", "least"), [(0.0, 1), (2.0, 40)])
def test_a_boosted_tree_equals_a_brute_force_one(spark, l2, least):
    df, x, y, w = numbers(spark)
    model = boosters.fit(df, boosters.Growth(1, 2, 1.0, l2=l2, leaf=least), "y", "w")
    base = (y * w).sum() / w.sum()
    want = base + brute_tree(x, (base - y) * w, w, 2, l2, least)
    got = {(r.a, r.b, r.c, r.y): r.prediction for r in model.transform(df).collect()}
    assert [got[*row, t] for row, t in zip(x, y)] == pytest.approx(want.tolist(), abs=1e-6)


def test_one_split_equals_sql(spark):
    df, x, y, _ = numbers(spark)
    df.createOrReplaceTempView("boosted_rows")
    best = spark.sql("""
        WITH cuts AS (SELECT DISTINCT a AS cut FROM boosted_rows), base AS (SELECT avg(y) AS m FROM boosted_rows)
        SELECT cut, pow(sum(IF(a <= cut, m - y, 0)), 2) / count_if(a <= cut) + pow(sum(IF(a > cut, m - y, 0)), 2) / nullif(count_if(a > cut), 0) AS gain
        FROM boosted_rows, cuts, base GROUP BY cut ORDER BY gain DESC NULLS LAST LIMIT 1""").first()
    only_a = VectorAssembler(inputCols=["a"], outputCol="one").transform(df)
    tree = boosters.fit(only_a, boosters.Growth(1, 1, 1.0), "y", features="one")
    assert tree.parts["edges"][0][tree.trees[0].left[0]] == best.cut


def test_ways_of_growing(spark):
    df, _, _, _ = numbers(spark)
    leaves = boosters.fit(df, boosters.Growth(2, 4, 0.3, "leaves", leaves=6), "y")
    assert all(sum(f >= 0 for f in tree.feature) == 5 for tree in leaves.trees)
    same = boosters.fit(df, boosters.Growth(2, 3, 0.3, "symmetric", l2=3.0), "y")
    for tree in same.trees:
        for first, last in ((1, 3), (3, 7)):
            inner = {(tree.feature[i], str(tree.left[i])) for i in range(first, last) if tree.feature[i] >= 0}
            assert len(inner) == 1
    presets = [boosters.fit(df, learners.growth(small(name, rounds=2, leaf=5)), "y") for name in ("xgboost", "lightgbm", "catboost", "hist_gradient_boosting")]
    assert len({str(model.parts["trees"]) for model in presets}) == 4


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    growth = boosters.Growth(4, 3, 0.3, rows=0.7, columns=0.7)
    monkeypatch.setattr(boosters, "REFRESH", 2)
    one, many = (boosters.fit(numbers(spark, parts=parts)[0], growth, "y", "w").parts["trees"] for parts in (1, 7))
    for left, right in zip(one, many, strict=True):
        assert left[:2] == right[:2] and left[2] == pytest.approx(right[2], rel=1e-9)


def test_boosting_refuses_no_rows_and_takes_one_value(spark):
    df, _, _, _ = numbers(spark)
    with pytest.raises(ValueError, match="no rows"):
        boosters.fit(df.limit(0), boosters.Growth(1, 2, 0.5), "y")
    flat = boosters.fit(df.withColumn("y", F.lit(4.0)), boosters.Growth(2, 2, 0.5), "y")
    assert flat.transform(df).agg(F.min("prediction"), F.max("prediction")).first() == (4.0, 4.0)
    gaps = boosters.fit(df.withColumn("y", F.when(F.col("a") > 0, F.col("y"))), boosters.Growth(1, 1, 0.5), "y")
    assert gaps.transform(df).filter("isnan(prediction)").isEmpty()


@pytest.mark.parametrize("name", ["dummy_regressor", "adaboost", "voting", "catboost"])
def test_every_learner_can_be_stored(spark, days, name):
    preset = small(name, rounds=2) if name != "dummy_regressor" else learners.CATALOG[name]
    trained = training.train(days, preset)
    path = new_folder(spark, "stored")
    PipelineModel([trained.preprocessor, trained.model]).save(path)
    loaded = training.load_model(path)
    features = with_trip_features(days)
    pairs = trained.predict(days, "fare_amount").agg(F.sum("prediction")).first()[0], loaded.transform(features).agg(F.sum("prediction")).first()[0]
    assert pairs[0] == pytest.approx(pairs[1], rel=1e-12)


def test_tree_encoding_does_not_depend_on_the_rows(days):
    whole, part = (preprocess.fit_preprocessor(with_trip_features(df), 512) for df in (days, days.limit(9)))
    columns = [fitted.stages[-1].getInputCols() for fitted in (whole, part)]
    assert columns[0] == columns[1] and "route_id_index" not in columns[0]
    with pytest.raises(ValueError, match="levels, more than 1"):
        preprocess.fit_preprocessor(with_trip_features(days), 2)


def test_an_evaluation_needs_both_splits(days, january):
    early = with_trip_features(days).orderBy("pickup_datetime").limit(5)
    with pytest.raises(ValueError, match="no rows in test, validation"):
        training.benchmark(early, january, [learners.CATALOG["dummy_regressor"]])


def test_benchmark_orders_by_validation_error(days, january):
    table = training.benchmark(
        with_trip_features(days), january, [learners.CATALOG["dummy_regressor"], small("gradient_boosting", rounds=3)]
    )
    rows = table.collect()
    assert [row["model"] for row in rows] == ["gradient_boosting", "dummy_regressor"]
    assert all(row["sample_rows"] == 21 and row["val_rmse"] >= 0 and row["test_rmse"] >= 0 for row in rows)


def test_production_model_is_stored_with_its_facts(spark, days, january):
    root = new_folder(spark, "model")
    facts = training.train_production(with_trip_features(days), january, root, small("xgboost", rounds=2, child_weight=1)).first()
    assert facts["sample_rows"] == 21 and facts["val_rmse"] >= 0 and facts["test_r2"] is not None
    assert training.model_facts(spark, root).first()["model"] == "xgboost"
    model = training.load_model(f"{root}/model")
    scored = scoring.score(model, trips(spark).drop("fare_amount", "trip_type")).collect()
    assert len(scored) == 3 and all(isinstance(row["estimated_fare_amount"], float) for row in scored)
    assert {row["trip_type"] for row in scored} == {"yellow"}


def test_scoring_refuses_outcomes(spark):
    with pytest.raises(ValueError, match="tip_amount"):
        scoring.score(learners.fit_mean(trips(spark)), trips(spark).withColumn("tip_amount", F.lit(1.0)))


def test_stream_scores_equal_batch_scores(spark, days):
    root = new_folder(spark, "stream")
    days.select(*RAW_FEATURES).repartition(3).write.parquet(f"{root}/in")
    trained = training.train(days, learners.CATALOG["ridge_regressor"])
    model = training.PipelineModel([trained.preprocessor, trained.model])
    stream = spark.readStream.schema(days.select(*RAW_FEATURES).schema).parquet(f"{root}/in")
    for _ in range(2):  # the second run finds nothing new
        scoring.score_stream(model, stream, f"{root}/out", f"{root}/seen").awaitTermination()
    batch = scoring.score(model, days.select(*RAW_FEATURES))
    assert sorted(spark.read.parquet(f"{root}/out").collect()) == sorted(batch.collect())


def test_request_checks(spark):
    good = ("yellow", "2025-01-03 08:15:00", 8, 0.0, 1, 265, 2, 6, 1.0)
    bad = ("blue", None, 9, -1.0, 0, 266, 3, 7, 1.0)
    missing = (None, "2025-01-03 08:15:00", None, None, None, 5, 1, 1, 1.0)
    odd = ("green", "2025-01-03 08:15:00", 1, 40.0, 7, 7, 1, 1, 1.0)
    checked = requests.check_requests(trips(spark, [good, bad, missing, odd]))
    errors, warnings = zip(*[(row["errors"], row["warnings"]) for row in checked.collect()])
    assert errors[0] == [] and warnings[0] == ["beyond_training"]
    assert errors[1] == [
        "trip_type",
        "pickup_datetime",
        "pickup_location_id",
        "dropoff_location_id",
        "passenger_count",
        "estimated_distance",
        "vendor_id",
        "ratecode_id",
    ]
    assert errors[2] == ["trip_type", "pickup_location_id", "passenger_count", "estimated_distance"]
    assert errors[3] == [] and warnings[3] == ["same_zone_long", "long_trip"]
    assert requests.valid_requests(checked).count() == 2 and requests.rejected_requests(checked).count() == 2


@pytest.mark.parametrize("name", ["xgboost", "lightgbm", "catboost"])
def test_one_task_grows_the_trees_of_one_job_a_level(spark, monkeypatch, name):
    df, _, _, _ = numbers(spark)
    growth = learners.growth(small(name, rounds=7, depth=3, leaf=3, rate=0.3))
    monkeypatch.setattr(boosters, "REFRESH", 3)
    here = boosters.fit(df, growth, "y", "w")
    more = boosters.fit(df, growth, "y", "w", before=here)
    monkeypatch.setattr(boosters, "ONE_TASK_BYTES", 0)
    assert boosters.fit(df, growth, "y", "w").parts == here.parts
    assert boosters.fit(df, growth, "y", "w", before=here).parts == more.parts


def test_histograms_do_not_grow_in_number_with_the_rows(spark, monkeypatch):
    """Blocks of very many parts are dealt to a bounded number of tasks, and what goes to Python at once is bounded."""
    given = []

    def level(blocks, *rest):
        given.append(blocks.rdd.getNumPartitions())
        return real(blocks, *rest)

    real = boosters._level
    monkeypatch.setattr(boosters, "_level", level)
    monkeypatch.setattr(boosters, "ONE_TASK_BYTES", 0)
    monkeypatch.setattr(boosters, "TASKS_PER_CORE", 1)
    size, opened = (f"spark.sql.files.{name}" for name in ("maxPartitionBytes", "openCostInBytes"))
    before = spark.conf.get(size), spark.conf.get(opened)
    spark.conf.set(size, 4096)
    spark.conf.set(opened, 4096)
    try:
        boosters.fit(numbers(spark, n=3000, parts=40)[0], boosters.Growth(2, 2, 0.3), "y", "w")
    finally:
        spark.conf.set(size, before[0])
        spark.conf.set(opened, before[1])
    assert given and max(given) <= spark.sparkContext.defaultParallelism
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 1 << 30


@pytest.mark.parametrize("name", ["ridge_regressor", "sgd_regressor", "xgboost"])
def test_training_rows_are_a_table_and_no_cache(days, monkeypatch, name):
    held = []
    real = training.fit_preset
    monkeypatch.setattr(training, "fit_preset", lambda df, *rest: held.append(df) or real(df, *rest))
    training.train(days, small(name, rounds=2) if name == "xgboost" else learners.CATALOG[name])
    (df,) = held
    assert not df.storageLevel.useMemory and not df.storageLevel.useDisk
    footers = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in df.inputFiles()]
    assert sum(one.num_rows for one in footers) == 30
    assert all(b"ml_attr" not in value for one in footers for value in one.metadata.values())
    assert "ml_attr" in df.schema["features"].metadata


def test_adaboost_keeps_no_caches(spark, monkeypatch):
    df, _, _, _ = numbers(spark)
    monkeypatch.setattr(type(df), "persist", lambda *_: pytest.fail("a cache for every tree"))
    model = learners.fit_adaboost(df, small("adaboost", rounds=3), "y")
    assert len(model.stages) == 4
