"""Versions of a store in a shared folder: parts that are never changed, and manifests that name those of a version.

A manifest is ``_versions/<number>.json``, a map of names to folders under the root. A writer reads the latest version, writes new
parts into folders of their own, and creates the next manifest; the file system lets only one writer create it, the
others start over from the newer version. Readers resolve the newest whole manifest, so they see a version wholly or not at all, and a
writer that dies leaves parts that no manifest names.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

TRIES = 20


class Conflict(RuntimeError):
    """Another writer has published the version."""


def _path(spark: SparkSession, path: str) -> tuple[object, object]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _path(spark, path)
    return files.exists(where)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, where = _path(spark, f"{root}/_versions")
    if not files.exists(where):
        return []
    names = (status.getPath().getName() for status in files.listStatus(where))
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def latest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number of the last manifest (0: none) and the parts of the newest whole one."""
    numbers = _numbers(spark, root)
    for number in reversed(numbers):
        # a manifest that its writer has not finished is no version yet
        row = spark.read.text(f"{root}/_versions/{number:010d}.json", wholetext=True).first()
        try:
            return numbers[-1], json.loads(row[0])["parts"]
        except (TypeError, ValueError, KeyError):
            continue
    return (numbers[-1] if numbers else 0), {}


def publish(spark: SparkSession, root: str, after: int, parts: dict[str, str]) -> int:
    """Make the version that follows ``after``; an error if there is one already."""
    number = after + 1
    files, where = _path(spark, f"{root}/_versions/{number:010d}.json")
    try:
        out = files.create(where, False)
    except Py4JJavaError as error:
        if files.exists(where):
            raise Conflict(f"version {number} of {root} exists") from error
        raise
    try:
        out.write(bytearray(json.dumps({"parts": parts}, sort_keys=True).encode()))
    finally:
        out.close()
    return number


def change(spark: SparkSession, root: str, edit: Callable[[dict[str, str]], dict[str, str]]) -> int:
    """Publish ``edit`` of the latest parts; tried again on the newer version when another writer was first."""
    for _ in range(TRIES):
        number, parts = latest(spark, root)
        try:
            return publish(spark, root, number, edit(dict(parts)))
        except Conflict:
            continue
    raise Conflict(f"{root}: no version could be published in {TRIES} tries")
