"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage.

On a cluster the session is built by the caller; the library only reads
``spark.checkpoint.dir`` from it. A folder of our own is set only when the
setting is absent and the master is local (tests, benches).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .lifetime import own_table


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "respengine") -> SparkSession:
    """A local[N] session configured like the cluster one (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RESPENGINE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local runs.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we never
    override it. Without it, a local master gets a fresh scratch folder, and a
    non-local master is an error (a machine-local folder would not survive the
    loss of an executor).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    folder = tempfile.mkdtemp(prefix="respengine-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Compute ``df`` once into the reliable checkpoint folder and cut its lineage.

    Written as a parquet table in one job (an eager ``checkpoint()`` would run
    the plan twice: once to count, once to write) and read back. Used where a
    result must stay identical across later jobs (numbered dictionaries) or
    where lineage would otherwise be recomputed many times.
    """
    folder = ensure_checkpoint_dir(df.sparkSession)
    path = own_table(f"{folder.rstrip('/')}/tables/{uuid.uuid4().hex}")
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.parquet(path)
    # Restore the column order of ``df`` (partition columns are read last).
    return out.select(*df.columns)
