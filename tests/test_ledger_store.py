"""The log-structured ledger: results as of whole upserts, bytes that follow the batch, restarts, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from cartloom.operators import ledger as lg
from cartloom.operators import ledger_store as store
from cartloom.streaming.jobs import ledger_writer

BATCH = "resource string, key string, payload string, checksum string"


def batch(spark, keys, mark, resource="Product"):
    return spark.createDataFrame([(resource, f"k{k}", f"p{mark}", f"c{mark}") for k in keys], BATCH)


def entries(df):
    return {(r.resource, r.key): (r.id, r.checksum, r.payload) for r in df.collect()}


def bytes_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_same_as_whole_upserts(spark, tmp_path):
    folder, whole = str(tmp_path / "store"), spark.createDataFrame([], lg.LEDGER)
    steps = [(range(40), 1), (range(20, 60), 2), (range(20, 60), 2), (range(5), 3), ([], 4), (range(55, 70), 5)]
    for epoch, (keys, mark) in enumerate(steps):
        new = batch(spark, keys, mark).unionByName(batch(spark, list(keys)[:3], mark, "Page"))
        merged = lg.checkpointed(lg.upsert(whole, new))
        whole = lg.next_version(merged)
        found = store.apply_batch(folder, new, "w", epoch, fanout=3, buckets=4)
        touched = {(r.resource, r.key) for r in new.collect()}
        expected = {(r.resource, r.key): (r.id, r.outcome) for r in merged.collect() if (r.resource, r.key) in touched}
        assert {(r.resource, r.key): (r.id, r.outcome) for r in found.collect()} == expected
        assert entries(store.read_store(spark, folder)) == entries(whole)
    now = store.latest(spark, folder)
    assert max(level for _, level in now.live) >= 1 and len(now.live) < 4 and store.unused(spark, folder)


def test_bytes_follow_the_batch(spark, tmp_path):
    folder = str(tmp_path / "store")
    store.apply_batch(folder, spark.range(20_000).select(
        F.lit("Product").alias("resource"), F.concat(F.lit("k"), "id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.md5(F.col("id").cast("string")).alias("checksum")), "w", 0)
    first = bytes_of(folder)
    store.apply_batch(folder, batch(spark, range(20), 9), "w", 1)
    second = bytes_of(folder) - first
    store.apply_batch(folder, batch(spark, range(20), 9), "w", 2)  # nothing changes
    assert second < first / 20 and bytes_of(folder) == first + second
    assert store.read_store(spark, folder).count() == 20_000


def test_repeated_batches_and_new_writers(spark, tmp_path):
    folder = str(tmp_path / "store")
    store.apply_batch(folder, batch(spark, range(10), 1), "a", 0)
    version = store.latest(spark, folder).version
    assert store.apply_batch(folder, batch(spark, range(10), 1), "a", 0) is None and store.latest(spark, folder).version == version
    # a query with a lost checkpoint starts at epoch 0 again, under a new name: ids stay, nothing is overwritten
    found = store.apply_batch(folder, batch(spark, range(5, 15), 2), "b", 0).collect()
    assert {r.outcome for r in found if int(r.key[1:]) < 10} == {"updated"} and min(r.id for r in found if r.outcome == "created") == 11
    assert store.read_store(spark, folder).count() == 15


def test_a_write_that_fails_halfway_leaves_the_ledger(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "store")
    store.apply_batch(folder, batch(spark, range(6), 1), "a", 0)
    before = entries(store.read_store(spark, folder))
    monkeypatch.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.apply_batch(folder, batch(spark, range(12), 2), "a", 1)
    assert entries(store.read_store(spark, folder)) == before and len(store.unused(spark, folder)) == 1
    monkeypatch.undo()
    store.apply_batch(folder, batch(spark, range(12), 2), "a", 1)
    after = store.read_store(spark, folder)
    assert after.count() == 12 and {r.checksum for r in after.collect()} == {"c2"}
    with pytest.raises(Exception, match="(?i)exist"):  # two writers of one version: the second fails
        store.commit(spark, folder, store.latest(spark, folder))


def test_failed_rows_leave_no_trace(spark, tmp_path):
    folder = str(tmp_path / "store")
    tried = batch(spark, range(4), 1).withColumn("applied", F.col("key") != "k2")
    got = {r.key: r.outcome for r in store.apply_batch(folder, tried, "a", 0).collect()}
    assert got == {"k0": "created", "k1": "created", "k2": "failed", "k3": "created"} and store.read_store(spark, folder).count() == 3


def test_stream_restart_and_lost_checkpoint(spark, tmp_path):
    """A stream that stops, goes on, and starts anew without its checkpoint."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "store")
    fields = f"{BATCH}, seq long"

    def send(keys, mark):
        batch(spark, keys, mark).withColumn("seq", F.lit(mark).cast("long")).coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        stream = spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(source)
        query = stream.writeStream.foreachBatch(ledger_writer(folder)).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None

    send(range(8), 1)
    run("one")
    send(range(4, 12), 2)
    run("one")
    first = entries(store.read_store(spark, folder))
    assert len(first) == 12 and first["Product", "k5"][1] == "c2"
    run("two")  # the same files once more, from epoch 0
    assert len(store.latest(spark, folder).writers) == 2
    again = entries(store.read_store(spark, folder))
    assert {k: v[0] for k, v in again.items()} == {k: v[0] for k, v in first.items()} and len(again) == 12


def test_look_up_joins_above_the_union(spark, tmp_path):
    """Several datasets, joins that shuffle: a semi join pushed below the union failed by partitions that don't match."""
    folder, whole = str(tmp_path / "store"), {}
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        for epoch, (lo, hi) in enumerate([(0, 4000), (3000, 5000), (2000, 6000), (0, 6000)]):
            new = spark.range(lo, hi, 1, 4).select(
                F.lit("Product").alias("resource"), F.concat(F.lit("k"), "id").alias("key"), F.lit(f"p{epoch}").alias("payload"), F.lit(f"c{epoch}").alias("checksum"))
            store.apply_batch(folder, new, "w", epoch, fanout=9, buckets=4)
            whole |= {f"k{k}": f"p{epoch}" for k in range(lo, hi)}
        now = store.latest(spark, folder)
        assert len(now.live) == 4
        plan = store.look_up(spark, folder, now, new)._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" not in plan
        got = {r.key: r.payload for r in store.read_store(spark, folder).collect()}
        assert got == whole and len({r.id for r in store.read_store(spark, folder).collect()}) == 6000
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
