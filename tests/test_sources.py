import pytest
from pyspark.sql import functions as F

from faremill.contract import RAW_YELLOW
from faremill.operators import lookups
from faremill.session import new_folder
from faremill.sources import audit, ledger, months, raw_files, tables
from faremill.sources.zones import read_zones
from faremill.streaming.arrivals import stream_trip_files


def month_rows(spark, n, **replaced):
    frame = spark.range(n).select(
        *[
            replaced.get(field.name, F.lit(None).cast(field.dataType)).alias(field.name)
            for field in RAW_YELLOW
            if field.name != "vendorid"
        ],
        F.col("id").alias("VendorID"),
    )
    return frame


def land(frame, folder, month, parts=1):
    frame.repartition(parts).write.mode("append").parquet(f"{folder}/yellow_tripdata_{month}.parquet")


def load(spark, root, **options):
    return raw_files.load_trip_files(spark, f"{root}/in", f"{root}/raw", f"{root}/audit", "yellow", **options)


def counts(spark, root):
    rows = raw_files.read_raw(spark, f"{root}/raw", "yellow").groupBy("period_label").count().collect()
    return {row["period_label"]: row["count"] for row in rows}


def test_month_list(spark, january):
    rows = months.month_files(spark, january).collect()
    assert sorted(row["file_name"] for row in rows) == [
        "green_tripdata_2025-01.parquet",
        "yellow_tripdata_2025-01.parquet",
    ]


def test_loading_is_idempotent_and_matches_by_name(spark):
    root = new_folder(spark, "test")
    land(month_rows(spark, 5), f"{root}/in", "2025-01", parts=3)
    # The same columns in another case and with another number type, one column missing, one too many.
    drifted = month_rows(spark, 7, passenger_count=F.lit(2.0))
    drifted = drifted.withColumnRenamed("airport_fee", "Airport_fee").drop("extra").withColumn("cbd_fee", F.lit(1.0))
    land(drifted, f"{root}/in", "2025-02")
    assert load(spark, root) == ["yellow_tripdata_2025-01.parquet", "yellow_tripdata_2025-02.parquet"]
    assert load(spark, root) == []
    assert counts(spark, root) == {"2025-01": 5, "2025-02": 7}
    raw = raw_files.read_raw(spark, f"{root}/raw", "yellow")
    assert raw.filter("period_label = '2025-02' and passenger_count = 2").count() == 7
    land(month_rows(spark, 1), f"{root}/in", "2025-03")
    assert load(spark, root) == ["yellow_tripdata_2025-03.parquet"]
    assert len(load(spark, root, again=True)) == 3
    assert counts(spark, root) == {"2025-01": 5, "2025-02": 7, "2025-03": 1}
    current = audit.current_audit(spark, f"{root}/audit")
    assert {row["period_label"]: row["rows_loaded"] for row in current.collect()} == counts(spark, root)
    assert audit.load_events(spark, f"{root}/audit").count() == 6


def test_unreadable_file_stops_the_load(spark):
    root = new_folder(spark, "test")
    land(month_rows(spark, 5), f"{root}/in", "2025-01")
    spark.createDataFrame([("no parquet",)], "value string").write.text(f"{root}/text")
    broken = spark.read.parquet(f"{root}/in/yellow_tripdata_2025-01.parquet").withColumn(
        "passenger_count", F.lit("many")
    )
    broken.write.parquet(f"{root}/in/yellow_tripdata_2025-02.parquet")
    with pytest.raises(Exception, match="(?i)cast"):
        load(spark, root)
    assert not tables.table_exists(spark, f"{root}/audit")


def test_stream_takes_new_files_and_late_parts(spark):
    root = new_folder(spark, "test")

    def run():
        stream_trip_files(
            spark, f"{root}/in/*", f"{root}/raw", f"{root}/audit", f"{root}/seen", "yellow"
        ).awaitTermination()

    land(month_rows(spark, 5), f"{root}/in", "2025-01", parts=2)
    run()
    assert counts(spark, root) == {"2025-01": 5}
    land(month_rows(spark, 4), f"{root}/in", "2025-02")
    land(month_rows(spark, 2), f"{root}/in", "2025-01")  # one more part of a known month
    run()
    run()
    assert counts(spark, root) == {"2025-01": 7, "2025-02": 4}
    # The batch load sees the audit of the stream.
    assert load(spark, root) == []


def test_upsert_keeps_the_latest(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, v int, t string")
    new = spark.createDataFrame([("b", 2, "y"), ("c", 2, "y")], "k string, v int, t string")
    assert sorted(map(tuple, audit.upsert(old, new, "k", "v").collect())) == [("a", 1, "x"), ("b", 2, "y"), ("c", 2, "y")]


def test_probes(spark):
    root = new_folder(spark, "test")
    tables.replace_table(spark.range(4), f"{root}/t")
    assert tables.table_counts(spark, {"t": f"{root}/t", "none": f"{root}/none"}) == {"t": 4, "none": None}
    assert tables.has_rows(spark.range(1)) and not tables.has_rows(spark.range(0))


def test_zone_names_that_look_missing_stay_names(spark):
    path = new_folder(spark, "zones")
    lines = ['"LocationID","Borough","Zone","service_zone"', '1,"EWR","Newark Airport","EWR"', '264,"Unknown","N/A","N/A"']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    zones = read_zones(spark, path)
    assert sorted(map(tuple, zones.collect())) == [(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", "N/A", "N/A")]
    trips = spark.createDataFrame([(1, 264), (7, None)], "pickup_location_id bigint, dropoff_location_id bigint")
    labels = lookups.with_zone_labels(trips, zones).orderBy("pickup_location_id").collect()
    assert (labels[0]["pickup_zone"], labels[0]["dropoff_zone"]) == ("1 — Newark Airport (EWR)", "264 — N/A (Unknown)")
    assert (labels[1]["pickup_zone"], labels[1]["dropoff_zone"]) == ("Zone 7", None)
    facts = lookups.with_zone_facts(trips, zones).orderBy("pickup_location_id").first()
    assert (facts["pickup_is_airport"], facts["dropoff_is_airport"], facts["dropoff_borough"]) == (1, 0, "Unknown")


def test_ledger(spark):
    path = f"{new_folder(spark, 'ledger')}"
    assert ledger.read_runs(spark, path).count() == 0
    rows = [("a", 1, 10, 3.5, 3.6, "v"), ("b", 1, 10, 2.5, 2.9, "v")]
    ledger.append_runs(spark.createDataFrame(rows, ledger.RUNS), path)
    ledger.append_runs(spark.createDataFrame([("a", 2, 10, 1.25, 1.5, "v")], ledger.RUNS), path)
    runs = ledger.read_runs(spark, path)
    assert [(row["model"], row["val_rmse"]) for row in ledger.latest_runs(runs).collect()] == [("a", 1.25), ("b", 2.5)]
    assert ledger.is_recorded(runs, "a") and not ledger.is_recorded(runs, "c")
