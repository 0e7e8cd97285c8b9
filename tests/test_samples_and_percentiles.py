from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faremill.operators import metrics, quantiles, reports, sampling, splits

POINTS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.995, 1.0]


def values(kind, n):
    random = np.random.default_rng(n)
    return {
        "continuous": random.normal(0, 50, n),
        "tiny": random.normal(0, 1e-6, n),
        "huge": random.normal(0, 1e12, n),
        "hot": np.where(random.random(n) < 0.4, 7.0, random.integers(0, 20, n)),
        "signed_zero": np.where(random.random(n) < 0.5, 0.0, -0.0),
    }[kind]


@pytest.mark.parametrize("kind", ["continuous", "tiny", "huge", "hot", "signed_zero"])
@pytest.mark.parametrize("way", ["brackets", "missed brackets", "large brackets"])
def test_percentiles_equal_numpy(spark, monkeypatch, kind, way):
    # few values to a sketch, so that brackets are narrow; without a margin some miss their rank
    monkeypatch.setattr(quantiles, "SKETCH", 100)
    monkeypatch.setattr(quantiles, "MARGIN", 0.0 if way == "missed brackets" else 0.06)
    monkeypatch.setattr(quantiles, "BRACKET_VALUES", 1 if way == "large brackets" else 10_000)
    frame = pd.DataFrame({"g": ["a"] * 1 + ["b"] * 2 + ["c"] * 997, "v": values(kind, 1000)})
    df = spark.createDataFrame(frame).repartition(5)
    rows = quantiles.exact_percentiles(df, ["v"], POINTS, ["g"]).collect()
    assert len(rows) == 3
    for row in rows:
        expected = np.quantile(frame.loc[frame.g == row["g"], "v"], POINTS)
        assert row["quantiles"] == pytest.approx(expected, rel=1e-12, abs=1e-15)


def test_percentiles_leave_out_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "v double")
    assert quantiles.medians(df, ["v"]).collect()[0]["median"] == 2.0
    assert quantiles.medians(df.limit(0), ["v"]).count() == 0


def test_groups_and_columns_without_values_are_kept(spark):
    rows = [("a", 1.0, None), ("a", 2.0, None), (None, 4.0, None), (None, 5.0, 7.0), ("c", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r.g, r.column): r for r in quantiles.summaries(df, ["x", "y"], [0.5], ["g"], lambda v: {"top": F.max(v)}, {"rows": F.count("*")}).collect()}
    assert len(got) == 6
    assert got["a", "x"][2:] == (2, [1.5], 2.0, 2) and got["a", "y"][2:] == (0, None, None, 2)
    assert got[None, "x"][2:] == (2, [4.5], 5.0, 2) and got[None, "y"].quantiles == [7.0]
    assert got["c", "x"].n == 0
    nothing = quantiles.summaries(df.limit(0), ["x"], [0.5], extra={"rows": F.count("*")}).collect()
    assert [(r.n, r.quantiles, r.rows) for r in nothing] == [(0, None, 0)]


def test_percentiles_read_their_input_twice(spark, tmp_path):
    spark.range(50_000).select((F.col("id") % 7).alias("g"), F.hash("id").cast("double").alias("v")).write.parquet(str(tmp_path / "in"))
    opened = spark.sparkContext.accumulator(0)
    made = spark.read.parquet(str(tmp_path / "in"))
    counted = made.mapInArrow(lambda batches: ((opened.add(b.num_rows), b)[1] for b in batches), made.schema)
    rows = quantiles.exact_percentiles(counted, ["v"], [0.25, 0.5, 0.75], ["g"]).collect()
    assert len(rows) == 7 and opened.value == 100_000


def test_samples_are_exact_repeatable_and_equal_brute_force(spark):
    # One stratum holds most rows, one is short, and copies of one row tie.
    df = spark.range(3000).select(
        F.when(F.col("id") < 2500, "hot").when(F.col("id") < 2990, "mid").otherwise("short").alias("s"),
        F.when(F.col("id") < 900, 7).otherwise(F.col("id")).cast("string").alias("key"),
    )
    for limit in (1, 50, 500, 5000):
        sample = sampling.smallest_hashes(df, limit, F.col("key"), 5, ["s"])
        sizes = {row["s"]: row["count"] for row in sample.groupBy("s").count().collect()}
        assert sizes == {"hot": min(limit, 2500), "mid": min(limit, 490), "short": min(limit, 10)}
        ranked = df.toPandas()
        ranked["h"] = [row["h"] for row in df.select(sampling.seeded(F.col("key"), 5).alias("h")).collect()]
        brute = ranked.sort_values("h", kind="stable").groupby("s").head(limit)
        assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, brute[["s", "key"]].to_numpy()))
    whole = sampling.smallest_hashes(df, 123, F.col("key"), 5)
    assert whole.count() == 123
    assert sorted(whole.collect()) == sorted(sampling.smallest_hashes(df.repartition(7), 123, F.col("key"), 5).collect())
    assert sampling.smallest_hashes(df.limit(0), 5, F.col("key"), 5).count() == 0
    assert sampling.fixed_size_sample(df, 77, 1).count() == 77


@pytest.mark.parametrize(("grain", "count"), [("month", 3), ("week", 8)])
def test_windows_cover_the_range(spark, grain, count):
    first, last = date(2025, 1, 15), date(2025, 3, 10)
    found = sorted(map(tuple, splits.windows(spark, first, last, grain).collect()))
    assert len(found) == count
    assert found[0][0] == first and found[-1][1] == last
    for before, after in zip(found, found[1:]):
        assert (after[0] - before[1]).days == 1
    if grain == "week":
        assert all((end - start).days == 6 for start, end in found[:-1])


def test_splits_are_disjoint_and_complete(spark, january):
    days = spark.range(31 * 24).select(
        F.timestamp_add("HOUR", F.col("id"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).alias("pickup_datetime")
    )
    parts = splits.split_frames(days, january)
    assert {name: part.count() for name, part in parts.items()} == {"train": 504, "validation": 144, "test": 96}
    summary = splits.split_summary(days, january)
    assert splits.splits_are_disjoint(summary)
    assert summary.agg(F.sum("rows")).first()[0] == 744


def test_perfect_and_constant_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (4.0, 4.0)], "fare_amount double, prediction double")
    row = metrics.evaluate(df)
    assert [row[name] for name in ("rmse", "mae", "med_ae", "mape", "r2")] == [0, 0, 0, 0, 1]
    flat = spark.createDataFrame([(2.0, 3.0), (2.0, 3.0)], "fare_amount double, prediction double")
    assert metrics.evaluate(flat)["r2"] == 0.0
    zero = spark.createDataFrame([(0.0, 0.0)], "fare_amount double, prediction double")
    assert metrics.evaluate(zero)["mape"] == 0.0
    with pytest.raises(ValueError, match="no rows"):
        metrics.evaluate(df.limit(0))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    rows = {row["bin"]: row["rows"] for row in reports.histogram(df, ["v"], 4).collect()}
    assert rows == {0: 0, 1: 0, 2: 4, 3: 0}


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, 0.0), (None, -0.0), (1, 2.5)], "a bigint, b double")
    found = {row["column"]: row for row in reports.column_profile(df).collect()}
    assert (found["a"]["nulls"], found["a"]["n_unique"], found["a"]["null_pct"]) == (1, 2, 33.33)
    assert (found["b"]["nulls"], found["b"]["n_unique"]) == (0, 2)


def test_samples_do_not_depend_on_the_order_of_ties(spark):
    rows = [("same", n) for n in range(40)]
    one, other = (spark.createDataFrame(part, "key string, tip int").repartition(3) for part in (rows, rows[::-1]))
    taken = [sorted(row["tip"] for row in sampling.smallest_hashes(df, 7, F.col("key"), 5).collect()) for df in (one, other)]
    assert taken[0] == taken[1] == list(range(7))


def test_metrics_without_rows_are_one_row(spark):
    df = spark.createDataFrame([], "fare_amount double, prediction double")
    row = metrics.regression_metrics(df).collect()
    assert len(row) == 1 and row[0]["rows"] == 0 and row[0]["rmse"] is None and row[0]["med_ae"] is None
