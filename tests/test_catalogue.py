"""Catalogue of part files, statistics noted on the write, category dictionaries, and raw green names."""

import glob
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import trips
from checks.trips import SETTINGS
from faremill import contract
from faremill.operators import cleaning, preprocess, reports
from faremill.operators.canonical import normalise_frame
from faremill.operators.dictionary import dense_ids, with_ids
from faremill.operators.features import with_trip_features
from faremill.plans import layers
from faremill.session import new_folder
from faremill.sources import audit, catalogue, raw_files

SF = "/root/testdata/sf0.001"


def part(spark, root, month, n, **replaced):
    rows = spark.range(n).select(
        *[replaced.get(field.name, F.lit(None).cast(field.dataType)).alias(field.name) for field in contract.RAW_YELLOW]
    )
    rows.coalesce(1).write.mode("append").parquet(f"{root}/in/yellow_tripdata_{month}.parquet")


def test_parts_of_one_month_may_differ_in_schema(spark):
    root = new_folder(spark, "drift")
    part(spark, root, "2025-01", 5, passenger_count=F.lit(2).cast("bigint"))
    part(spark, root, "2025-01", 3, passenger_count=F.lit(3.0))  # the same column as a floating number
    part(spark, root, "2025-02", 4, passenger_count=F.lit(1).cast("bigint"))
    part(spark, root, "2025-02", 0)
    parts = catalogue.footers(spark, [f"{root}/in"])
    wanted = catalogue.scans(parts).collect()
    assert len(wanted) == 3 and sorted(row["path"].endswith("02.parquet") for row in wanted) == [False, False, True]
    raw_files.load_trip_files(spark, f"{root}/in", f"{root}/raw", f"{root}/audit", "yellow")
    raw = raw_files.read_raw(spark, f"{root}/raw", "yellow")
    got = raw.groupBy("period_label").agg(F.count("*"), F.sum("passenger_count")).orderBy("period_label").collect()
    assert [tuple(row) for row in got] == [("2025-01", 8, 19), ("2025-02", 4, 4)]
    noted = audit.current_audit(spark, f"{root}/audit").orderBy("file_name").collect()
    assert [row["rows_loaded"] for row in noted] == [8, 4]


def test_files_outside_of_a_range_are_not_opened(spark):
    root = new_folder(spark, "ranges")
    time = lambda day: F.lit(f"2025-{day} 10:00:00").cast("timestamp_ntz")
    for month, day in (("2025-01", "01-31"), ("2025-02", "02-01"), ("2025-03", "03-05")):
        part(spark, root, month, 2, tpep_pickup_datetime=time(day))
    part(spark, root, "2025-04", 2)  # no pickup time at all: its span is unknown
    parts = catalogue.footers(spark, [f"{root}/in"])
    held = catalogue.within(parts, date(2025, 2, 1), date(2025, 2, 28)).collect()
    assert sorted(row["file_name"][16:23] for row in held) == ["2025-02", "2025-04"]
    broken = f"{root}/in/yellow_tripdata_2025-05.parquet"
    spark.createDataFrame([("no footer",)], "value string").coalesce(1).write.option("compression", "none").text(f"{root}/text")
    shutil.copy(glob.glob(f"{root}/text/*.txt")[0], broken)
    with pytest.raises(Exception, match="(?i)parquet"):
        catalogue.footers(spark, [f"{root}/in"]).collect()


def test_statistics_are_noted_on_the_write(spark):
    root = new_folder(spark, "noted")
    obt = layers.build_layers(trips.raw(spark, SF), SETTINGS, root)["train"]
    weights = layers.noted_weights(layers.read_statistics(spark, root))
    assert weights == pytest.approx(reports.fleet_weight_map(obt))


def test_dense_ids_of_many_values(spark):
    values = spark.range(200_000).select(F.lit("route").alias("column"), F.concat(F.col("id") % 447, F.lit("_"), F.col("id")).alias("value"))
    values = values.unionByName(spark.createDataFrame([("fleet", "green"), ("fleet", "yellow")], "column string, value string"))
    known = dense_ids(values, parts=7).persist()
    rows = known.filter("column = 'route'").orderBy("value").select("id").collect()
    assert [row["id"] for row in rows] == list(range(200_000))
    assert {row["value"]: row["id"] for row in known.filter("column = 'fleet'").collect()} == {"green": 0, "yellow": 1}
    text = known._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in text
    named = with_ids(spark.createDataFrame([("green",), ("blue",), (None,)], "fleet string"), known, ["fleet"])
    assert {row["fleet"]: row["fleet_id"] for row in named.collect()} == {"green": 0, "blue": None, None: None}
    assert dense_ids(values.limit(0)).count() == 0


def test_hashed_categories_gather_no_values(spark, monkeypatch):
    rows = with_trip_features(normalise_frame(trips.raw(spark, SF)["yellow"].limit(400)))
    asked = []
    gathered = preprocess._labels
    monkeypatch.setattr(preprocess, "_labels", lambda counts, names: asked.append(names) or gathered(counts, names))
    fitted = preprocess.fit_preprocessor(rows, hashed_width=1 << 12)
    assert asked == [[]]
    vector = preprocess.to_vectors(fitted, rows).first()["features"]
    assert vector.size == len(contract.NUMERIC_FEATURES) + (1 << 12)
    again = preprocess.to_vectors(fitted, rows.withColumn("route_id", F.lit("9999_9999"))).first()["features"]
    assert again.size == vector.size


def test_raw_green_is_green(spark):
    schema = "lpep_pickup_datetime string, lpep_dropoff_datetime string, trip_distance double, trip_type string"
    rows = [("2025-01-03 08:15:00", "2025-01-03 08:35:00", 1.5, kind) for kind in ("1", "2", None, " Yellow ", "green")]
    out = normalise_frame(spark.createDataFrame(rows, schema)).collect()
    assert [row["trip_type"] for row in out] == ["green", "green", "green", "yellow", "green"]
    mixed = spark.createDataFrame([("2025-01-03 08:15:00", "1")], "pickup_datetime string, trip_type string")
    assert normalise_frame(mixed).first()["trip_type"] == "1"


def test_lists_of_a_column():
    assert contract.lists_of("tip_amount") == ["leakage_columns", "diagnostic_only_columns"]
    assert contract.lists_of("nothing") == []
    assert reports.column_role("tip_amount") == "LEAKAGE" and reports.column_role("route_id") == "FEATURE"
    assert cleaning.rules.FLEET_KNOWN in cleaning.rules.CANDIDATE
