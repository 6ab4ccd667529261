"""Session settings and the one place that decides where scratch tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  They are ordinary Spark settings; a
# cluster's own values win because the builder never overrides a running session.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # an id-only side is hashed per partition, so wide text rows need no sort
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "64m",
    # transformWithState keeps its state in RocksDB
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "promptmill", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**DEFAULTS, "spark.sql.shuffle.partitions": "8",
                 "spark.driver.memory": "12g", **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SPREAD = "spark.promptmill.spread"


def spread(df):
    """Rows dealt out to as many tasks as the setting ``spark.promptmill.spread`` says; as is where it is unset.

    For a small text table kept in one row group, which Spark reads in one task.  A
    large table has enough splits and must not pay for a shuffle of its text.
    """
    tasks = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(tasks)) if tasks else df


def by_rows(df):
    """Rows dealt out to tasks whatever bytes they have, for work that is much larger than the text it is done on."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a folder on this machine; anywhere else that is an error,
    because other executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="promptmill-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared scratch folder."""
    return f"{scratch_root(spark)}/promptmill/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """Write ``df`` to a scratch table and read it back.

    Cuts the lineage in storage that outlives a lost executor, and makes a value
    that must not be computed twice (a model call, a sampled order) be computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
