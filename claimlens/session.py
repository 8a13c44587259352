"""Session helpers. Library code never creates a session; callers pass one."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "claimlens") -> SparkSession:
    """Session for tests and local benchmarks (a cluster passes its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CLAIMLENS_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables and checkpoints.

    ``spark.checkpoint.dir`` names it on a cluster. Only a session whose master
    is local (one machine: tests, benchmarks) may fall back to a new scratch
    folder; on any other master a machine-local folder would be seen by one
    executor alone, so the missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not is_local_master(sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="claimlens-ckpt-"))
    return sc.getCheckpointDir()


def is_local_master(master: str) -> bool:
    """True for ``local`` and ``local[...]`` (driver and tasks in one process), not for ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def suggested_conf(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings for an input of ``input_bytes``: a shuffle width of about one
    partition per ``target_bytes`` (never fewer than two per core) and 128 MB splits.

    Only a suggestion: nothing is set, and what the cluster configured itself is left out.
    """
    cores = spark.sparkContext.defaultParallelism
    split = str(128 * 1024 * 1024)
    wanted = {
        "spark.sql.shuffle.partitions": str(max(2 * cores, -(-input_bytes // target_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": split,
        "spark.sql.files.maxPartitionBytes": split,
    }
    given = spark.sparkContext.getConf()
    return {k: v for k, v in wanted.items() if not given.contains(k)}


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Apply settings for the duration of a block and put the caller's back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
