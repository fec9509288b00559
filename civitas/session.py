"""Spark session options shared by jobs, tests and the bench.

ANSI mode stays on (Spark 4 default): parsing goes through ``try_cast`` and
division through guarded ``when``/``try_divide`` so bad input becomes NULL
instead of failing a 1000-executor job on one dirty cell.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Defaults sized for local runs; on a cluster the submitting configuration wins
# because ``getOrCreate`` only applies options that are not already set.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Catalyst's statistics-based broadcast (10 MB) is the size check for
    # joins whose build side is not a declared bounded dimension.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "civitas",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", os.environ.get("CIVITAS_DRIVER_MEMORY", "12g"))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    Only a ``local`` master may go without the setting (as tests do) and gets
    a temporary folder; on a cluster the folder must be one that all machines
    share, so without the setting the session is refused.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not fallback and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    directory = configured or fallback or os.path.join(
        os.environ.get("TMPDIR", "/tmp"), "civitas-checkpoints")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(directory)
    return sc.getCheckpointDir() or directory


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint directory (never a
    machine-local temp folder): intermediate tables survive executor loss."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/civitas-{name}/{uuid.uuid4().hex}"


def written(df, name: str = "scratch"):
    """``df`` written to a fresh shared folder and read again: what follows
    reads the same rows however often, and a lost executor costs no rerun."""
    folder = scratch_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
