"""The layered build: raw files to staging, modelling table and splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.contract import FLEETS
from faremill.operators.canonical import canonical_trips
from faremill.operators.cleaning import staging
from faremill.operators.features import obt
from faremill.operators.splits import split_frames, split_label
from faremill.settings import Settings
from faremill.sources.tables import replace_observed, replace_table

STATISTICS = "layer string, split string, trip_type string, rows bigint, first_pickup timestamp_ntz, last_pickup timestamp_ntz"
SPLITS = ("train", "validation", "test")


def _cells(settings: Settings, layer: str) -> dict[tuple[str, str | None, str], Column]:
    """Condition of every (layer, split, fleet) that is counted while the layer is written."""
    by_fleet = {fleet: F.col("trip_type") == fleet for fleet in FLEETS}
    if layer != "obt":
        return {(layer, None, fleet): of for fleet, of in by_fleet.items()}
    label = split_label(settings)
    return {(layer, split, fleet): of & (label == split) for split in SPLITS for fleet, of in by_fleet.items()}


def _metrics(cells: Mapping[tuple[str, str | None, str], Column]) -> list[Column]:
    pickup = F.col("pickup_datetime")
    return [
        metric.alias(f"{name}_{at}")
        for at, of in enumerate(cells.values())
        for name, metric in (("rows", F.count_if(of)), ("first", F.min(F.when(of, pickup))), ("last", F.max(F.when(of, pickup))))
    ]


def read_statistics(spark: SparkSession, root: str) -> DataFrame:
    """Rows and span of pickups by layer, split and fleet, as noted when the layers were written."""
    return spark.read.schema(STATISTICS).parquet(f"{root}/statistics")


def noted_weights(statistics: DataFrame, split: str = "train") -> dict[str, float]:
    """Inverse-frequency weight of each fleet of a split, from what was noted: no trip is read."""
    counts = {row["trip_type"]: row["rows"] for row in statistics.filter((F.col("split") == split) & (F.col("rows") > 0)).collect()}
    return {fleet: sum(counts.values()) / (len(counts) * rows) for fleet, rows in counts.items()}


def build_layers(
    raw: Mapping[str, DataFrame], settings: Settings, root: str, store_splits: bool = False
) -> dict[str, DataFrame]:
    """Write staging and the modelling table; splits are read from the latter, or written too.

    No step shuffles. The modelling table is partitioned by pickup year, which is what the splits
    and the yearly strata filter on; raw trips arrive by month, so a task holds one or two years
    and writes one or two files. Rows and spans by split and fleet are noted while they pass (``read_statistics``).
    """
    kinds = {layer: _cells(settings, layer) for layer in ("staging", "obt")}
    valid = staging(canonical_trips(raw, settings), settings)
    staged, seen = replace_observed(valid, f"{root}/staging", [], _metrics(kinds["staging"]))
    trips, later = replace_observed(obt(staged), f"{root}/obt", ["pickup_year"], _metrics(kinds["obt"]))
    noted = [
        (*cell, found[f"rows_{at}"], found[f"first_{at}"], found[f"last_{at}"])
        for layer, found in (("staging", seen), ("obt", later))
        for at, cell in enumerate(kinds[layer])
    ]
    replace_table(staged.sparkSession.createDataFrame(noted, STATISTICS).coalesce(1), f"{root}/statistics")
    layers = {"staging": staged, "obt": trips}
    for name, rows in split_frames(trips, settings).items():
        layers[name] = replace_table(rows, f"{root}/{name}", ["pickup_year"]) if store_splits else rows
    return layers
