"""Hot groups give the same rows as plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.operators import skew


def rows(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    # one key holds most rows; orders repeat, ids do not
    data = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(40)}", rnd.randrange(30), i, rnd.randrange(200_000)) for i in range(n)]
    return spark.createDataFrame(data, "k string, a int, id int, s int").withColumn("ts", F.timestamp_seconds("s"))


def same(left, right):
    columns = sorted(left.columns)
    assert sorted(map(tuple, left.select(columns).collect())) == sorted(map(tuple, right.select(columns).collect()))


def test_numbered_splits_hot_groups(spark):
    df = rows(spark).drop("ts")
    plain = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("a", "id")).cast("bigint"))
    for limit in (10, 100, 10_000):
        same(skew.numbered(df, ["k"], ["a", "id"], ["a", "id"], max_rows=limit), plain)


def test_numbered_hot_work_is_spread(spark):
    """With a hot key, no task numbers more than a fraction of the rows."""
    df = rows(spark).drop("ts")
    placed = skew.numbered(df, ["k"], ["a", "id"], ["a", "id"], max_rows=100)
    assert "_range" in placed._jdf.queryExecution().optimizedPlan().toString()


def test_previous_and_running_max(spark):
    df = rows(spark)
    order = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.select("id", F.lag("a").over(order).alias("p"), F.max("a").over(order).alias("m"))
    previous = skew.with_previous(df, ["k"], "ts", "id", F.col("a"), max_rows=100).select("id", F.col("previous.value").alias("p"))
    same(previous, plain.select("id", "p"))
    running = skew.with_running_max(df, ["k"], "ts", "id", F.col("a"), "m", max_rows=100).select("id", "m")
    same(running, plain.select("id", "m"))


def test_with_first(spark):
    df = rows(spark).drop("ts")
    same(skew.with_first(df, ["k", "a"], "id"), df.withColumn("first_id", F.min("id").over(Window.partitionBy("k", "a"))))


def test_null_keys_are_one_group(spark):
    from datetime import datetime

    from cartloom.operators.skew import with_first, with_previous

    rows = [(1, None, datetime(2026, 1, 1, 1), "a"), (2, None, datetime(2026, 1, 1, 4), "b"), (3, "k", datetime(2026, 1, 1, 5), "c")]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp, v string")
    assert {r.id: r.first_id for r in with_first(df, ["k"], "id").collect()} == {1: 1, 2: 1, 3: 3}
    before = with_previous(df, ["k"], "ts", "id", F.col("v"), "last").collect()
    assert {r.id: r["last"] and r["last"].value for r in before} == {1: None, 2: "a", 3: None}


def test_a_cluster_must_name_its_checkpoint_folder():
    from types import SimpleNamespace

    from cartloom.session import checkpoint_dir

    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(cluster)
