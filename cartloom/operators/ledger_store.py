"""The ledger as a log-structured store: what a batch writes follows the batch, not the ledger.

A store is a folder with ``data-*`` datasets and numbered manifests. A dataset holds ledger rows, newest per key, as Parquet
partitioned by a hash bucket of the key. A manifest names the live datasets, newest first, with the highest id of each
resource and the last epoch of each writer; the highest complete manifest is the ledger. Datasets and manifests are
never changed, so readers of one version are never disturbed and a write that fails halfway leaves nothing but a
folder that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.operators.ledger import LEDGER, upsert
from cartloom.session import checkpointed

#: Datasets of one level that are merged into one of the next.
FANOUT = 8
BUCKETS = 64
ROWS = f"{LEDGER}, bucket int"


@dataclass(frozen=True)
class Manifest:
    """One version: live datasets as (name, level), newest first; ids used so far; epochs done by each writer."""

    version: int = -1
    buckets: int = BUCKETS
    live: tuple[tuple[str, int], ...] = ()
    counters: dict[str, int] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest_name(folder: str, version: int) -> str:
    return f"{folder}/manifest-{version:012d}"


def latest(spark: SparkSession, folder: str) -> Manifest:
    """The highest complete manifest, or an empty one where there is no store yet."""
    target, fs = _files(spark, folder)
    if not fs.exists(target):
        return Manifest()
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    for name in sorted((n for n in names if n.startswith("manifest-")), reverse=True):
        if fs.exists(_files(spark, f"{folder}/{name}/_SUCCESS")[0]):
            body = json.loads(spark.read.text(f"{folder}/{name}").first()[0])
            return Manifest(body["version"], body["buckets"], tuple((n, level) for n, level in body["live"]), body["counters"], body["writers"])
    return Manifest()


def commit(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    """Write a manifest; a version that exists already is an error, so of two writers at once one fails."""
    body = json.dumps({"version": manifest.version, "buckets": manifest.buckets, "live": manifest.live, "counters": manifest.counters, "writers": manifest.writers})
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("errorifexists").text(_manifest_name(folder, manifest.version))


def bucket_of(manifest: Manifest) -> Column:
    return F.pmod(F.xxhash64("resource", "key"), F.lit(manifest.buckets)).cast("int")


def rows_of(spark: SparkSession, folder: str, live: Sequence[tuple[str, int]]) -> DataFrame:
    """Rows of some datasets with their ``age``: 0 for the newest."""
    parts = [spark.read.schema(ROWS).parquet(f"{folder}/{name}").withColumn("age", F.lit(n)) for n, (name, _) in enumerate(live)]
    if not parts:
        return spark.createDataFrame([], f"{ROWS}, age int")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def newest(rows: DataFrame) -> DataFrame:
    """The newest row of each key; partial minima are taken before the shuffle."""
    best = rows.groupBy("resource", "key").agg(F.min_by(F.struct("id", "checksum", "payload", "bucket"), "age").alias("r"))
    return best.select("resource", "key", "r.id", "r.checksum", "r.payload", "r.bucket")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of the latest version."""
    return newest(rows_of(spark, folder, latest(spark, folder).live)).drop("bucket")


def look_up(spark: SparkSession, folder: str, manifest: Manifest, keys: DataFrame) -> DataFrame:
    """Ledger rows of ``keys`` (``resource, key``): only the buckets the keys fall into are read.

    An inner join on distinct keys: a semi join would be pushed below the union of the datasets, and Spark 4.1 takes a union
    of shuffled inputs for dealt by their key, though adaptive reads may leave each with another number of partitions.
    """
    touched = [r.bucket for r in keys.select(bucket_of(manifest).alias("bucket")).distinct().collect()]  # at most manifest.buckets
    rows = rows_of(spark, folder, manifest.live).where(F.col("bucket").isin(touched))
    return newest(rows.join(keys.select("resource", "key").distinct(), ["resource", "key"])).drop("bucket")


def write_dataset(rows: DataFrame, folder: str, manifest: Manifest) -> str:
    """One file per bucket and task range; a large bucket is split by its keys."""
    name = f"data-{uuid.uuid4().hex}"
    placed = rows.withColumn("bucket", bucket_of(manifest)).repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(16)))
    placed.write.partitionBy("bucket").parquet(f"{folder}/{name}")
    return name


def apply_batch(folder: str, batch: DataFrame, writer: str, epoch: int, fanout: int = FANOUT, buckets: int = BUCKETS) -> DataFrame | None:
    """Upsert a batch (``resource, key, payload, checksum`` and maybe ``applied``; unique keys) and commit a version.

    Gives ``resource, key, id, outcome`` of the batch's keys, or None where this writer has done this epoch already (a
    batch repeated after a restart). Another writer (a new query, or one whose checkpoint was lost, which starts at
    epoch 0 again) goes on from the ledger as it is. Read are the buckets of the batch's keys, written its changed rows,
    and now and then the datasets of one level as one of the next: every row is rewritten once per level.
    """
    spark = batch.sparkSession
    now = latest(spark, folder)
    if now.version < 0:
        now = replace(now, buckets=buckets)
    if now.writers.get(writer, -1) >= epoch:
        return None
    batch = checkpointed(batch)
    known = look_up(spark, folder, now, batch)
    counters = spark.createDataFrame(list(now.counters.items()), "resource string, last_id long")
    merged = checkpointed(upsert(known, batch, counters).where(F.col("outcome").isNotNull()))
    changed = merged.where(F.col("outcome").isin("created", "updated")).select("resource", "key", "id", "checksum", "payload")
    used = {r.resource: r.last for r in changed.groupBy("resource").agg(F.max("id").alias("last")).collect()}
    live = now.live
    if used:
        live = ((write_dataset(changed, folder, now), 0), *live)
    after = replace(
        now, version=now.version + 1, live=live, counters={**now.counters, **{k: max(v, now.counters.get(k, 0)) for k, v in used.items()}},
        writers={**now.writers, writer: epoch},
    )
    commit(spark, folder, after)
    compact(spark, folder, fanout)
    return merged.select("resource", "key", "id", "outcome")


def compact(spark: SparkSession, folder: str, fanout: int = FANOUT) -> int:
    """Merge full levels, lowest first; gives the number of merges. Rows and order of age stay as they are: the datasets
    of a level are newer than those of the levels above."""
    merges = 0
    while True:
        now = latest(spark, folder)
        levels: dict[int, list[tuple[str, int]]] = {}
        for entry in now.live:
            levels.setdefault(entry[1], []).append(entry)
        full = next((level for level in sorted(levels) if len(levels[level]) >= fanout), None)
        if full is None:
            return merges
        name = write_dataset(newest(rows_of(spark, folder, levels[full])).drop("bucket"), folder, now)
        at = now.live.index(levels[full][0])
        rest = [e for e in now.live if e[1] != full]
        commit(spark, folder, replace(now, version=now.version + 1, live=(*rest[:at], (name, full + 1), *rest[at:])))
        merges += 1


def unused(spark: SparkSession, folder: str) -> list[str]:
    """Datasets that the latest version doesn't name: of merged levels and of writes that failed. To be removed by the
    owner of the folder once no reader holds an older version."""
    target, fs = _files(spark, folder)
    live = {name for name, _ in latest(spark, folder).live}
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(n for n in names if n.startswith("data-") and n not in live)
