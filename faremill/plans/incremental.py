"""Layers that are rebuilt by month and switched at once.

The load audit tells which months of the raw layer are new or were loaded again since the published version. Only those go
through the rules and derivations, into folders of their own; a new version then names them beside the parts that stay.
Readers always see one whole version. Other settings (date window, fleets) make every month stale.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators.canonical import canonical_columns
from faremill.operators.cleaning import staging
from faremill.operators.features import obt
from faremill.settings import Settings
from faremill.sources import audit, snapshots

LAYERS = ("staging", "obt")
PARTS = ["_fleet", "_month"]


def _fingerprint(settings: Settings) -> str:
    return json.dumps([str(settings.data_start), str(settings.data_end), *settings.fleets])


def _stale(loaded: DataFrame, settings: Settings, parts: Mapping[str, str]) -> tuple[dict[tuple[str, str], str], set[tuple[str, str]]]:
    """Load times of the months to rebuild, and the months that are no longer there."""
    copied = loaded.filter((F.col("copy_status") == audit.COPIED) & F.col("trip_type").isin(*settings.fleets))
    rows = copied.select("trip_type", "period_label", F.col("loaded_at").cast("string").alias("at")).collect()  # one row a month and fleet
    now = {(row["trip_type"], row["period_label"]): row["at"] for row in rows}
    same = parts.get("settings") == _fingerprint(settings)
    known = {tuple(name.split("/")[1:]) for name in parts if name.startswith("loaded/")}
    stale = {key: at for key, at in now.items() if not same or parts.get(f"loaded/{key[0]}/{key[1]}") != at}
    return stale, known - now.keys()


def _write(rows: DataFrame, path: str) -> DataFrame:
    rows.write.partitionBy(*PARTS).parquet(path)
    kept = [field for field in rows.schema if field.name not in PARTS]
    named = [T.StructField(name, T.StringType()) for name in PARTS]
    return rows.sparkSession.read.schema(T.StructType([*kept, *named])).parquet(path)


def update_layers(raw: Mapping[str, DataFrame], loaded: DataFrame, settings: Settings, root: str) -> list[tuple[str, str]]:
    """Rebuild what is stale and publish it; returns the (fleet, month) pairs rebuilt.

    ``raw`` has the raw trips of each fleet with ``period_label``, ``loaded`` the current load audit. No step shuffles.
    """
    spark = loaded.sparkSession
    number, parts = snapshots.latest(spark, root)
    stale, gone = _stale(loaded, settings, parts)
    if not stale and not gone:
        return []
    kept = {name: value for name, value in parts.items() if tuple(name.split("/")[1:]) not in gone}
    if stale:
        run = f"data/{uuid.uuid4().hex}"
        frames = []
        for fleet in sorted({fleet for fleet, _ in stale}):
            months = sorted(month for name, month in stale if name == fleet)
            rows = raw[fleet].filter(F.col("period_label").isin(months))
            frames.append(rows.select(*canonical_columns(fleet), F.lit(fleet).alias("_fleet"), F.col("period_label").alias("_month")))
        staged = _write(staging(reduce(DataFrame.unionByName, frames), settings), f"{root}/{run}/staging")
        _write(obt(staged, *PARTS), f"{root}/{run}/obt")
        for (fleet, month), at in stale.items():
            kept[f"loaded/{fleet}/{month}"] = at
            for layer in LAYERS:
                folder = f"{run}/{layer}/_fleet={fleet}/_month={month}"
                # a month may have no trip that passes
                kept[f"{layer}/{fleet}/{month}"] = folder if snapshots.exists(spark, f"{root}/{folder}") else ""
    kept["settings"] = _fingerprint(settings)
    snapshots.publish(spark, root, number, kept)
    return sorted(stale)


def read_layer(spark: SparkSession, root: str, layer: str, months: Sequence[str] | None = None) -> DataFrame:
    """A layer of the newest version; with ``months`` only their folders are opened."""
    _, parts = snapshots.latest(spark, root)
    folders = [value for name, value in sorted(parts.items()) if name.startswith(f"{layer}/") and value]
    if months is not None:
        folders = [folder for folder in folders if folder.rsplit("=", 1)[1] in set(months)]
    if not folders:
        raise ValueError(f"{root} has no {layer}")
    return spark.read.parquet(*[f"{root}/{folder}" for folder in folders])
