"""Large-large joins without a shuffle (J2): both sides stored bucketed and sorted by the key.

A bucketed table is dealt and sorted once, when it is written; every later join on its key reads bucket by bucket with
no exchange and no sort. Buckets cannot be split at run time, so keys with more than ``hot_rows`` rows
are stored apart in the plain layout and joined there, where adaptive execution splits them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import path_exists


@dataclass(frozen=True)
class Bucketed:
    """A stored side of a join: the table's name in the session's catalog, and its folder."""

    name: str
    path: str
    key: str
    buckets: int
    columns: tuple[str, ...]


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, hot_rows: int | None = None) -> Bucketed:
    """Store ``df`` in ``buckets`` buckets of ``key``, sorted; rows without a key match nothing and go to ``<path>/apart``
    with those of hot keys (``hot_rows`` None: no key is taken as hot)."""
    spark = df.sparkSession
    apart = F.col(key).isNull()
    if hot_rows is not None:
        hot = df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows).select(F.col(key).alias("_hot"))
        marked = df.join(hot, F.col(key) == F.col("_hot"), "left")
        marked.filter(F.col("_hot").isNotNull() | apart).drop("_hot").write.mode("errorifexists").parquet(f"{path}/apart")
        hot_keys = spark.read.schema(df.schema).parquet(f"{path}/apart").select(F.col(key).alias("_hot")).distinct()
        regular = df.filter(~apart).join(hot_keys, F.col(key) == F.col("_hot"), "left_anti")
    else:
        df.filter(apart).write.mode("errorifexists").parquet(f"{path}/apart")
        regular = df.filter(~apart)
    dealt = regular.repartition(buckets, key)  # as the buckets are dealt: one file per bucket
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").mode("errorifexists").saveAsTable(name)
    return Bucketed(name, path, key, buckets, tuple(df.columns))


def joined(spark: SparkSession, left: Bucketed, right: Bucketed, take: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(regular, apart): ``left`` with columns ``take`` of ``right`` (one row per key) by a left join.

    The regular part merges bucket with bucket; the rows stored apart are joined as usual. Their union is the join.
    """
    if left.buckets != right.buckets:
        raise ValueError("both sides need the same number of buckets")
    if path_exists(spark, f"{right.path}/apart") and spark.read.parquet(f"{right.path}/apart").filter(F.col(right.key).isNotNull()).limit(1).count():
        raise ValueError("the right side has one row per key: store it without hot_rows")
    other = spark.table(right.name).select(F.col(right.key).alias("_key"), *take)
    match = F.col(left.key) == F.col("_key")
    columns = [*left.columns, *take]
    regular = spark.table(left.name).hint("merge").join(other, match, "left").select(*columns)
    apart = spark.read.schema(spark.table(left.name).schema).parquet(f"{left.path}/apart").join(other, match, "left").select(*columns)
    return regular, apart
