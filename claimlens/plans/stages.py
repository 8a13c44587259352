"""Stage tables shared by the registered queries.

A stage (unscaled features, scaled features, per-claim results) is computed
once per Spark application and state of the input folder (its files' names, sizes
and times), written as Parquet under the cluster's shared ``spark.checkpoint.dir``
and read back. This is the lineage
cut of a production run: the global passes (medians, means, score bounds)
scan a stored, column-pruned table instead of re-running the joins, and a lost
executor only re-runs its own stage.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..sources.storage import delete_path, listing_digest

_LOCK = threading.Lock()
_PATHS: dict[tuple[str, str, str], str] = {}
_KEY_LOCKS: dict[tuple[str, str, str], threading.Lock] = {}


def stage_root(spark: SparkSession) -> str:
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/claimlens-stages/{spark.sparkContext.applicationId}"


def stage(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read stage ``name`` for input ``source``, building and writing it first if needed."""
    key = _key(spark, source, name)
    with _LOCK:
        key_lock = _KEY_LOCKS.setdefault(key, threading.Lock())
    with key_lock:  # concurrent callers wait for one build instead of racing on the folder
        path = _PATHS.get(key)
        if path is None:
            path = f"{stage_root(spark)}/{key[1]}/{name}-{uuid.uuid4().hex[:8]}"
            build().write.mode("errorifexists").option("compression", "zstd").parquet(path)
            _PATHS[key] = path
    return spark.read.parquet(path)


def stage_path(spark: SparkSession, source: str, name: str) -> str:
    """Where a built stage lives (raises if it was not built in this application)."""
    return _PATHS[_key(spark, source, name)]


def _key(spark: SparkSession, source: str, name: str) -> tuple[str, str, str]:
    """A changed input folder is another key, so a long session never reads a stale stage."""
    return spark.sparkContext.applicationId, listing_digest(spark, source), name


def forget(spark: SparkSession, delete: bool = False) -> None:
    """Drop this application's stage registrations, and its folder where ``delete`` is set
    (at the end of a run, when no plan reads it any more)."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        for key in [k for k in _PATHS if k[0] == app]:
            del _PATHS[key]
    if delete:
        delete_path(spark, stage_root(spark))
