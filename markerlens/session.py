"""Spark session and shared-folder helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module only
builds one for tests, the bench and scripts, and resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Driver tables (one parquet file each) under an sf directory.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(master: str | None = None, app: str = "markerlens",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, pass the cluster's session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MARKERLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without one gets a private scratch folder; on a cluster the executors
    would not share it, so there a missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="markerlens-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared checkpoint folder (cuts lineage; survives
    executor loss). Never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared checkpoint folder as Parquet and read it back: lineage is cut as by ``checkpointed``,
    and later reads take only the columns they need."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read one driver table; column pruning and filters reach the parquet scan.

    A file with a single row group scans as one task, and all row-local work before the
    first shuffle (tokenising whole texts) would run on one core. When the scan yields fewer
    splits than the session's parallelism, the rows are spread round-robin over that many
    partitions. At cluster scale the scan has far more splits than cores and nothing is added.
    Projections and filters are pushed below the repartition by the optimizer.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread:
        want = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < want:
            df = df.repartition(want)
    return df
