"""Versions of a store: layers by month, the versioned ledger, stored sketches, and what a service reports."""

from datetime import datetime
from threading import Barrier, Thread

import pytest
from pyspark.sql import functions as F

from checks import trips
from checks.trips import SETTINGS
from faremill.contract import CONTRACT_VERSION
from faremill.operators import learners, reports
from faremill.operators.canonical import canonical_trips
from faremill.operators.cleaning import staging
from faremill.operators.features import obt, with_trip_features
from faremill.plans import incremental, training
from faremill.session import new_folder
from faremill.sources import audit, ledger, snapshots
from tests.frames import thirty_days

SF = "/root/testdata/sf0.001"
FIRST, LATER = datetime(2025, 1, 1), datetime(2025, 2, 1)


@pytest.fixture(scope="module")
def raw(spark):
    month = F.date_format("pickup", "yyyy-MM").alias("period_label")
    return {
        fleet: rows.withColumn("pickup", F.col(f"{prefix}_pickup_datetime")).select("*", month).drop("pickup")
        for (fleet, rows), prefix in zip(trips.raw(spark, SF).items(), ("tpep", "lpep"))
    }


def audited(spark, rows):
    return spark.createDataFrame([(*row, audit.COPIED) for row in rows], "trip_type string, period_label string, loaded_at timestamp, copy_status string")


def test_only_changed_months_are_rebuilt(spark, raw):
    root = new_folder(spark, "versions")
    two = [("yellow", "1995-01", FIRST), ("yellow", "1995-02", FIRST), ("green", "1995-01", FIRST)]
    assert len(incremental.update_layers(raw, audited(spark, two), SETTINGS, root)) == 3
    _, before = snapshots.latest(spark, root)
    assert incremental.update_layers(raw, audited(spark, two), SETTINGS, root) == []
    changed = [*two[1:], ("yellow", "1995-01", LATER), ("yellow", "1995-03", FIRST)]
    assert incremental.update_layers(raw, audited(spark, changed), SETTINGS, root) == [("yellow", "1995-01"), ("yellow", "1995-03")]
    number, after = snapshots.latest(spark, root)
    assert number == 2
    assert after["obt/yellow/1995-02"] == before["obt/yellow/1995-02"] and after["obt/yellow/1995-01"] != before["obt/yellow/1995-01"]
    want = obt(staging(canonical_trips(raw, SETTINGS), SETTINGS)).filter("date_format(pickup_datetime, 'yyyy-MM') in ('1995-01', '1995-02', '1995-03')")
    want = want.filter("trip_type = 'yellow' or date_format(pickup_datetime, 'yyyy-MM') = '1995-01'")
    got = incremental.read_layer(spark, root, "obt")
    assert got.count() == want.count() > 0 and got.exceptAll(want.select(*got.columns)).isEmpty()
    assert incremental.read_layer(spark, root, "obt", ["1995-02"]).select(F.date_format("pickup_datetime", "yyyy-MM")).distinct().count() == 1
    # a month that is no longer there goes, without rebuilding the others
    assert incremental.update_layers(raw, audited(spark, changed[:2]), SETTINGS, root) == []
    assert not any(name.endswith("1995-03") for name in snapshots.latest(spark, root)[1])


def test_a_build_that_fails_half_way_leaves_the_old_version(spark, raw, monkeypatch):
    root = new_folder(spark, "versions")
    incremental.update_layers(raw, audited(spark, [("yellow", "1995-01", FIRST)]), SETTINGS, root)
    rows = incremental.read_layer(spark, root, "staging").count()

    def broken(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(incremental, "obt", broken)
        incremental.update_layers(raw, audited(spark, [("yellow", "1995-01", LATER), ("yellow", "1995-02", LATER)]), SETTINGS, root)
    assert snapshots.latest(spark, root)[0] == 1 and incremental.read_layer(spark, root, "staging").count() == rows
    assert len(incremental.update_layers(raw, audited(spark, [("yellow", "1995-01", LATER), ("yellow", "1995-02", LATER)]), SETTINGS, root)) == 2


def test_an_unfinished_manifest_is_no_version(spark):
    root = new_folder(spark, "versions")
    snapshots.publish(spark, root, 0, {"a": "b"})
    files, where = snapshots._path(spark, f"{root}/_versions/{2:010d}.json")
    files.create(where, False).close()
    assert snapshots.latest(spark, root) == (2, {"a": "b"})
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark, root, 1, {})
    assert snapshots.change(spark, root, lambda parts: {**parts, "c": "d"}) == 3
    assert snapshots.latest(spark, root) == (3, {"a": "b", "c": "d"})


def entry(spark, model, run, rmse, contract=CONTRACT_VERSION):
    return spark.createDataFrame([(model, run, 10, rmse, rmse, contract, None, None, None, None, None, None)], ledger.ENTRIES)


def test_two_writers_lose_no_run(spark):
    root = new_folder(spark, "ledger")
    assert ledger.read_entries(spark, root).count() == 0
    start, errors = Barrier(2), []

    def write(name):
        try:
            start.wait()
            for run in range(1, 4):
                ledger.append_entries(entry(spark, name, run, run / 2), root)
        except Exception as error:  # seen below
            errors.append(error)

    writers = [Thread(target=write, args=(name,)) for name in "ab"]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert not errors
    assert ledger.read_entries(spark, root).count() == 6
    assert [(r["model"], r["run"]) for r in ledger.current_entries(ledger.read_entries(spark, root)).orderBy("model").collect()] == [("a", 3), ("b", 3)]


def test_benchmark_skips_forces_and_replaces(spark, january, monkeypatch):
    root, rows = new_folder(spark, "ledger"), with_trip_features(thirty_days(spark))
    presets = [learners.CATALOG["dummy_regressor"], learners.CATALOG["sgd_regressor"]]
    fitted = []
    fit = training.fit_preset
    monkeypatch.setattr(training, "fit_preset", lambda df, preset, *rest: fitted.append(preset.name) or fit(df, preset, *rest))
    # a run that broke off after its first model, and one of an older contract
    training.benchmark(rows, january, presets[:1], root)
    ledger.append_entries(entry(spark, "sgd_regressor", 4, 0.1, "old"), root)
    table = training.benchmark(rows, january, presets, root).collect()
    assert fitted == ["dummy_regressor", "sgd_regressor"]
    assert [row["model"] for row in table] == ["sgd_regressor", "dummy_regressor"]
    training.benchmark(rows, january, presets, root, again=True)
    assert fitted[2:] == ["dummy_regressor", "sgd_regressor"]
    current = {row["model"]: row for row in ledger.current_entries(ledger.read_entries(spark, root)).collect()}
    assert (current["dummy_regressor"]["run"], current["sgd_regressor"]["run"]) == (2, 6)
    assert current["sgd_regressor"]["training_strategy"] == "all_rows" and current["sgd_regressor"]["seconds"] > 0


def test_health_without_and_with_a_model(spark, january):
    root = new_folder(spark, "model")
    empty = training.service_health(spark, root).first()
    assert (empty["status"], empty["model_loaded"], empty["model"], empty["val_rmse"]) == ("ok", False, None, None)
    training.train_production(with_trip_features(thirty_days(spark)), january, root, learners.CATALOG["dummy_regressor"])
    row = training.service_health(spark, root).first()
    assert (row["model_loaded"], row["model"], row["training_strategy"]) == (True, "dummy_regressor", "all_rows")


def test_errors_by_grain_of_a_trained_model(spark, january):
    rows = with_trip_features(thirty_days(spark))
    trained = training.train(training.training_rows(rows, january), learners.CATALOG["dummy_regressor"])
    found = training.evaluate_by_grain(trained, rows, january).collect()
    scored = [(r["fare_amount"], r["prediction"], r["trip_type"]) for r in training.predictions(trained, rows, january, "trip_type").collect()]
    for fleet in ("yellow", "green"):
        errors = sorted(abs(a - b) for a, b, name in scored if name == fleet)
        rows_of = [r for r in found if r["grain"] == "split+trip_type" and r["trip_type"] == fleet]
        assert sum(r["rows"] for r in rows_of) == len(errors)
    assert {r["grain"] for r in found} == {"split", "split+window_start", "split+trip_type", "split+window_start+trip_type"}
    assert all(r["med_ae"] is not None for r in found)


def test_stored_sketches_merge_to_the_profile(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("m"), (F.col("id") % 9000).cast("double").alias("x"), F.when(F.col("id") > 5, F.col("id").cast("string")).alias("y"))
    path = new_folder(spark, "profile")
    # month by month: a new month adds its own rows
    for m in range(3):
        reports.profile_parts(df.filter(F.col("m") == m), F.col("m"), ["x", "y"]).write.mode("append").partitionBy("part").parquet(path)
    got = {r["column"]: r for r in reports.merged_profile(spark.read.parquet(path)).collect()}
    assert (got["x"]["rows"], got["x"]["nulls"], got["y"]["nulls"]) == (30_000, 0, 6)
    assert got["x"]["n_unique"] == pytest.approx(9000, rel=0.03) and got["y"]["n_unique"] == pytest.approx(29_995, rel=0.03)
