"""Audit trail (P11, U1, U2, K8 dedupe, F10, J9)."""

from __future__ import annotations

import datetime as _dt
import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FRAUD_THRESHOLD, QUALITY_THRESHOLD
from ..functions.scalar import utc_bound

AUDIT_KEY = ["event_type", "entity_id", "model_version"]


def fraud_flag_entries(results: DataFrame, created_at, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """One ``fraud_flag`` entry per flagged claim."""
    return results.filter(F.col("is_suspected_fraud")).select(
        F.lit("fraud_flag").alias("event_type"),
        F.lit("claim").alias("entity_type"),
        F.col("claim_id").alias("entity_id"),
        "model_version",
        F.col("fraud_score").alias("score"),
        F.struct(
            F.col("contributing_factors"),
            F.lit(threshold).alias("threshold"),
            F.lit(None).cast("string").alias("manufacturer_name"),
            F.lit(None).cast("bigint").alias("total_claims"),
            F.lit(None).cast("double").alias("repair_claim_rate"),
        ).alias("details"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )


def quality_flag_entries(quality: DataFrame, created_at, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """One ``quality_flag`` entry per manufacturer of concern."""
    return quality.filter(F.col("is_quality_concern")).select(
        F.lit("quality_flag").alias("event_type"),
        F.lit("manufacturer").alias("entity_type"),
        F.col("manufacturer_id").alias("entity_id"),
        "model_version",
        F.col("quality_score").alias("score"),
        F.struct(
            F.lit(None).cast("array<string>").alias("contributing_factors"),
            F.lit(threshold).alias("threshold"),
            F.col("manufacturer_name"),
            F.col("total_claims").cast("bigint").alias("total_claims"),
            F.col("repair_claim_rate"),
        ).alias("details"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    )


def audit_entries(results: DataFrame, quality: DataFrame, created_at,
                  fraud_threshold: float = FRAUD_THRESHOLD,
                  quality_threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Both kinds of entries in one frame."""
    return fraud_flag_entries(results, created_at, fraud_threshold).unionByName(
        quality_flag_entries(quality, created_at, quality_threshold)
    )


def new_entries_only(new: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Entries not already in the log (idempotent append); null versions and ids are equal."""
    if existing is None:
        return new
    log = existing.select(*[F.col(c).alias(f"_log_{c}") for c in AUDIT_KEY])
    same = reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_log_{c}")) for c in AUDIT_KEY])
    return new.join(log, same, "left_anti")


def filter_audit(
    log: DataFrame,
    entity_type: str | None = None,
    entity_id: str | None = None,
    date_from: str | _dt.datetime | None = None,
    date_to: str | _dt.datetime | None = None,
) -> DataFrame:
    """conjunctive audit filters; null ``created_at`` fails a date filter."""
    out = log
    if entity_type:
        out = out.filter(F.col("entity_type") == entity_type)
    if entity_id:
        out = out.filter(F.col("entity_id") == entity_id)
    lo, hi = utc_bound(date_from), utc_bound(date_to, upper=True)
    if lo is not None:
        out = out.filter(F.col("created_at") >= F.lit(lo).cast("timestamp"))
    if hi is not None:
        out = out.filter(F.col("created_at") <= F.lit(hi).cast("timestamp"))
    return out


def with_audit_trail(entities: DataFrame, log: DataFrame, entity_type: str, key: str) -> DataFrame:
    """Each entity row with its audit entries (left join on type + id)."""
    trail = log.filter(F.col("entity_type") == entity_type).select(
        F.col("entity_id").alias(key), "event_type", F.col("created_at").alias("audited_at"), F.col("score").alias("audited_score")
    )
    return entities.join(trail, key, "left")
