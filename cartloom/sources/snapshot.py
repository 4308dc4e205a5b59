"""Snapshot reader: one nested JSON array per entity, explicit schemas, required and optional files."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.sources.json_array import read_json_array
from cartloom.sources.schemas import DDL

SPLIT_BYTES = 128 << 20


class SnapshotMissing(RuntimeError):
    """Required entity files are absent."""


@dataclass(frozen=True)
class Snapshot:
    """Entity tables with the time and base address of the export."""

    tables: dict[str, DataFrame]
    taken: str = "unknown"
    base: str = "unknown"

    def __getitem__(self, entity: str) -> DataFrame:
        return self.tables[entity]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system the path names, local or not."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def entity_path(spark: SparkSession, folder: str, entity: str) -> tuple[str, bool] | None:
    """Where an entity lies and whether it is one JSON array.

    ``<entity>.json`` is an array; ``<entity>/`` is a folder of JSON-lines parts.
    """
    for path, array in ((f"{folder}/{entity}", False), (f"{folder}/{entity}.json", True)):
        if path_exists(spark, path):
            return path, array
    return None


def file_bytes(spark: SparkSession, path: str) -> int:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target).getLen()


def read_entity(spark: SparkSession, entity: str, path: str, array: bool, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows of one entity. An array of more than one split is read by many tasks, with the same rows."""
    if array and file_bytes(spark, path) > split_bytes:
        return read_json_array(spark, path, DDL[entity])
    return spark.read.schema(DDL[entity]).json(path, multiLine=array)


def empty(spark: SparkSession, entity: str) -> DataFrame:
    return spark.createDataFrame([], DDL[entity])


def load_snapshot(
    spark: SparkSession, folder: str, required: Iterable[str], optional: Iterable[str] = (), split_bytes: int = SPLIT_BYTES
) -> Snapshot:
    """Read a snapshot folder. All missing required entities are named in one error; a missing
    optional one is an empty table."""
    wanted = {**{e: True for e in required}, **{e: False for e in optional}}
    if not path_exists(spark, folder):
        raise SnapshotMissing(f"snapshot folder not found: {folder}")
    places = {e: entity_path(spark, folder, e) for e in wanted}
    missing = sorted(e for e, needed in wanted.items() if needed and places[e] is None)
    if missing:
        raise SnapshotMissing(f"missing required files in {folder}: {', '.join(missing)}")
    tables = {
        e: empty(spark, e)
        if place is None
        else read_entity(spark, e, *place, split_bytes)
        for e, place in places.items()
    }
    return Snapshot(tables, *_manifest(spark, f"{folder}/_manifest.json"))


def _manifest(spark: SparkSession, path: str) -> tuple[str, str]:
    """Time and base of the export. Spark's readers skip names that start with ``_``, so the one
    small object is read through the file system it lies on."""
    if not path_exists(spark, path):
        return "unknown", "unknown"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        found = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return found.get("finished") or found.get("started") or "unknown", found.get("base") or "unknown"


def source_summary(snapshot: Snapshot, tallies: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows per entity, and per value of the columns named in ``tallies``; one tall table."""
    tallies = tallies or {
        "products": ["status", "type"],
        "orders": ["status"],
        "customers": ["role"],
        "pages": ["status"],
        "posts": ["status"],
        "coupons": ["status"],
    }
    parts = []
    for entity, df in snapshot.tables.items():
        parts.append(
            df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(entity).alias("entity"), F.lit("total").alias("axis"), F.lit("").alias("value"), "n"
            )
        )
        for column in tallies.get(entity, []):
            parts.append(
                df.groupBy(F.coalesce(F.col(column), F.lit("")).alias("value"))
                .agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(entity).alias("entity"), F.lit(column).alias("axis"), "value", "n")
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
