"""Parquet table scans (column pruning and filter pushdown are Catalyst's)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .storage import stored_bytes

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# tables below this many stored bytes are dealt over the cores after their scan
SPREAD_BYTES = 64 * 1024 * 1024


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan ``<base_dir>/<name>.parquet``; a small table is dealt over all cores.

    A small file is one row group, so one task would run every narrow step after the
    scan. The bound is on stored bytes (a listing, no job), so at most SPREAD_BYTES are
    ever moved for this; larger tables have splits of their own.
    """
    path = f"{base_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    if stored_bytes(spark, path) > SPREAD_BYTES:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


def read_partitioned(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """Scan a ``dt=``-partitioned Parquet directory; ``dt`` prunes partitions."""
    df = spark.read.parquet(path)
    if dt is not None:
        from pyspark.sql import functions as F

        df = df.filter(F.col("dt") == F.lit(dt))
    return df
