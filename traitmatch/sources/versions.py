"""Tables that are replaced in one step.

A table is a folder of versions, each a complete Parquet table, and a folder of
numbered pointer files.  A load writes a new version and then publishes it by
renaming one pointer file to the next number; what the pointer says (which version,
which day, which batch) becomes true in that one rename.  A load that dies before it leaves
the table as it was, and a reader that started on the old version keeps its files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_POINTERS, _VERSIONS = "_published", "_versions"
KEPT_VERSIONS = 2


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _pointers(spark: SparkSession, target: str) -> list[int]:
    """Published numbers, rising (a few: :func:`publish` removes old ones)."""
    fs, folder = _fs(spark, f"{target}/{_POINTERS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read_pointer(spark: SparkSession, target: str, number: int) -> dict:
    row = spark.read.option("wholetext", True).text(f"{target}/{_POINTERS}/{number:012d}.json").first()
    return {**json.loads(row[0]), "number": number}


def current(spark: SparkSession, target: str) -> dict | None:
    """The published pointer: ``version``, ``number`` and what the load stated; ``None`` for a table never published."""
    target = target.rstrip("/")
    numbers = _pointers(spark, target)
    return _read_pointer(spark, target, numbers[-1]) if numbers else None


def version_path(target: str, version: str) -> str:
    return f"{target.rstrip('/')}/{_VERSIONS}/{version}"


def read_version(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the published version."""
    at = current(spark, target)
    if at is None:
        raise FileNotFoundError(target)
    return spark.read.schema(StructType.fromJson(at["schema"])).parquet(version_path(target, at["version"]))


def stage(df: DataFrame, target: str, partition_by: str | None = None) -> str:
    """Write ``df`` as a new version that no reader sees yet; its name."""
    version = uuid.uuid4().hex[:16]
    df.write.parquet(version_path(target, version), partitionBy=partition_by)
    return version


def publish(spark: SparkSession, target: str, version: str, schema: StructType, keep: int = KEPT_VERSIONS,
            **stated) -> dict:
    """Make a staged version the table, in one rename.

    Two loads that publish at once get different numbers: the rename onto a taken number fails and
    the next one is tried; the later one wins as a whole.  The schema (a version without rows has it too)
    and ``stated`` (day, counts) are stored in the pointer.  All but the last ``keep`` versions are deleted afterwards.
    """
    target = target.rstrip("/")
    before = _pointers(spark, target)
    text = json.dumps({"version": version, "schema": schema.jsonValue(), **stated}, sort_keys=True)
    fs, temporary = _fs(spark, f"{target}/{_POINTERS}/.{version}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    number = (before[-1] if before else 0) + 1
    while True:
        _, final = _fs(spark, f"{target}/{_POINTERS}/{number:012d}.json")
        if not fs.exists(final) and fs.rename(temporary, final):
            break
        number += 1
    _forget(spark, target, [n for n in _pointers(spark, target) if n <= number][:-keep])
    return {"version": version, "number": number, **stated}


def _forget(spark: SparkSession, target: str, numbers: list[int]) -> None:
    """Delete old pointers, then the versions that only they named."""
    for number in numbers:
        version = _read_pointer(spark, target, number)["version"]
        for path in (f"{target}/{_POINTERS}/{number:012d}.json", version_path(target, version)):
            fs, at = _fs(spark, path)
            fs.delete(at, True)


def replace(df: DataFrame, target: str, **stated) -> DataFrame:
    """The table becomes the rows of ``df`` in one step; returns the new version.

    ``df`` may read the table that it replaces.
    """
    spark = df.sparkSession
    publish(spark, target, stage(df, target), df.schema, **stated)
    return read_version(spark, target)
