"""The audit log by bucket of its entities (K8, U2, F9): appends and lookups read only the buckets that they touch."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import new_entries_only
from ..schemas import AUDIT_ENTRY
from ..sources.storage import path_exists


class AuditLog:
    """Entries in folders ``bucket=<b>`` by a hash of the entity id (null ids are a bucket's like any others)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, entity: Column) -> Column:
        return F.pmod(F.xxhash64(entity), F.lit(self.buckets)).cast("int")

    def read(self, only: list[int] | None = None) -> DataFrame:
        """All entries, or those of some buckets."""
        folders = [f"{self.path}/bucket={b}" for b in (range(self.buckets) if only is None else only)]
        held = [f for f in folders if path_exists(self.spark, f)]
        return self.spark.read.schema(AUDIT_ENTRY).parquet(*held) if held else self.spark.createDataFrame([], AUDIT_ENTRY)

    def append(self, entries: DataFrame) -> int:
        """Append the entries that are not in the log yet; returns how many. Null versions and ids are compared as equal.

        Repeats within ``entries`` (equal type, entity and version) count once: the earliest by time and score.
        """
        names, key = AUDIT_ENTRY.fieldNames(), ["event_type", "entity_id", "model_version"]
        first = F.min_by(F.struct(*names), F.struct("created_at", "score"))
        once = entries.groupBy(*key).agg(first.alias("e")).select("e.*").withColumn("bucket", self._bucket(F.col("entity_id")))
        touched = sorted(r[0] for r in once.select("bucket").distinct().collect())
        fresh = new_entries_only(once, self.read(touched)).select(*names, "bucket")
        stats = fresh.groupBy("bucket").agg(F.count("*").alias("n")).collect()  # one row per bucket
        if stats:
            (
                fresh.repartition(len(stats), "bucket").sortWithinPartitions("bucket", "entity_id")
                .write.mode("append").option("parquet.bloom.filter.enabled#entity_id", "true").partitionBy("bucket").parquet(self.path)
            )
        return sum(r.n for r in stats)

    def entries_of(self, entity_type: str | None, entity_id: str | None) -> DataFrame:
        """the entries of one entity, from its bucket."""
        bucket = self.spark.range(1).select(self._bucket(F.lit(entity_id).cast("string"))).first()[0]
        same = [F.col(c).eqNullSafe(F.lit(v).cast("string")) for c, v in (("entity_type", entity_type), ("entity_id", entity_id))]
        return self.read([bucket]).filter(reduce(operator.and_, same))
