"""The physical plans that matter at scale: pruning, pushed filters, no needless shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from checks import trips
from checks.trips import SETTINGS
from faremill.operators import cleaning, features, reports, sampling, splits
from faremill.operators.canonical import canonical_trips
from faremill.operators.quantiles import exact_percentiles
from faremill.plans.layers import build_layers
from faremill.session import new_folder

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark):
    return build_layers(trips.raw(spark, SF), SETTINGS, new_folder(spark, "layers"))


def test_layer_counts(layers):
    assert layers["staging"].count() == 408 + 4208
    assert layers["obt"].count() == 404 + 4151
    assert {name: layers[name].count() for name in ("train", "validation", "test")} == {
        "train": 3311,
        "validation": 679,
        "test": 565,
    }


def test_staging_is_one_narrow_pass_with_pushed_rules(spark):
    text = plan(cleaning.staging(canonical_trips(trips.raw(spark, SF), SETTINGS), SETTINGS))
    assert "Exchange" not in text
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", text)
    assert len(pushed) == 2
    for part in pushed:
        assert "fare_amount" in part and "passenger_count" in part and "pickup" in part


def test_reports_read_only_their_columns(spark):
    counted = reports.counts_by(canonical_trips(trips.raw(spark, SF), SETTINGS), "ratecode_id")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(counted))
    assert schemas == ["ratecodeid:bigint"] * 2


def test_splits_prune_year_directories(layers):
    text = plan(layers["validation"].groupBy("trip_type").count())
    pruned = re.search(r"PartitionFilters: \[([^\]]*)", text).group(1)
    assert "pickup_year" in pruned


def test_a_disabled_fleet_is_not_read(spark):
    from dataclasses import replace

    only = canonical_trips(trips.raw(spark, SF), replace(SETTINGS, fleets=("green",)))
    assert plan(only).count("FileScan") == 1


def test_features_and_windows_add_no_shuffle(layers):
    first, last = SETTINGS.split_ranges["test"]
    rows = splits.with_window(features.with_trip_features(layers["test"]), first, last, "week")
    assert "Exchange" not in plan(rows)


def test_samples_move_only_the_crossing_prefix(layers):
    sample = sampling.stratified_train_sample(layers["train"], 500, SETTINGS)
    text = plan(sample)
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text
    assert "SortMergeJoin" not in text  # one cut-off per stratum is broadcast


def test_percentiles_use_no_buffer_of_all_values(layers):
    text = plan(exact_percentiles(layers["obt"], ["fare_amount"], [0.5], ["trip_type"]))
    assert "percentile" not in text and "NestedLoop" not in text
    # what is left to do joins two written tables of one row a group
    assert text.count("Exchange") <= 4 and "obt" not in text
    assert layers["obt"].filter(F.col("fare_amount").isNull()).isEmpty()
