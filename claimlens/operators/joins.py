"""Lookup tables for joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..plans.stages import stage_root


def stored_lookup(small: DataFrame) -> DataFrame:
    """Store a lookup table so that its size in bytes is known when a join is planned.

    Spark broadcasts a stored table whose bytes are below the session's
    ``spark.sql.autoBroadcastJoinThreshold`` and keeps a sort-merge join otherwise (AQE
    splits its skewed partitions): one rule, in bytes, and no hint that could be wrong. The
    table lies in this application's stage folder and goes with it.
    """
    spark = small.sparkSession
    path = f"{stage_root(spark)}/lookup-{uuid.uuid4().hex}"
    small.write.parquet(path)
    return spark.read.schema(small.schema).parquet(path)
