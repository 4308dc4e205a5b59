"""Session settings shared by tests, bench and jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "cartloom", memory: str = "8g") -> SparkSession:
    """Local session for tests and bench. On a cluster the job's own session is used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    A cluster names a shared folder in ``spark.checkpoint.dir``; only where that is unset
    (local tests) is a temporary one made. Other masters need the setting: executors can't see the driver's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="cartloom-ckpt-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder, so a lost executor costs one read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """A written copy in the shared checkpoint folder, for rows that several steps read: column by column, so repeated values cost little."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys into the session's number of shuffle partitions.

    Adaptive execution leaves a given number as it is. Else it merges partitions up to a size in compressed bytes, and
    a task sorts as many narrow rows as fit in that. For keys without hot values: skewed partitions are left, too.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
