"""Sinks (K1-K10). Each returns what the caller needs (paths, counts) using
``Observation`` metrics collected during the write, never a second job."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import new_entries_only
from ..operators.ingest import run_partition
from ..operators.query import export_rows, serving_extract
from ..schemas import AUDIT_ENTRY, MODEL_MANIFEST
from ..sources.storage import delete_path, read_if_exists


def _observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [m.alias(k) for k, m in metrics.items()]
    return df.observe(obs, *exprs), obs


def write_partitioned(df: DataFrame, base: str, dt: str, run_id: str = "full", **metrics) -> dict:
    """K1: write partition ``dt=<dt>/run_id=<run_id>`` under ``base``; returns counters.

    Only that partition is replaced, so a repeated run is idempotent and a second run on
    the same day adds to the first (D4); readers take the latest version per key.
    """
    out, obs = _observed(run_partition(df, dt, run_id), "partitioned", **metrics)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("dt", "run_id")
        .parquet(base)
    )
    return dict(obs.get)


def write_current(df: DataFrame, path: str, dt: str, **metrics) -> dict:
    """K1 for a table that is rebuilt in full: the one current copy, stamped with its ``dt``."""
    out, obs = _observed(df.drop("dt", "run_id").withColumn("dt", F.lit(dt)), "current", **metrics)
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt").parquet(path)
    return dict(obs.get)


def write_quarantine(bad: DataFrame, reason: str, base: str, entity: str, dt: str, run_id: str) -> int:
    """Rows that cannot be used, kept as JSON text with the reason; returns their number."""
    rows = bad.select(
        F.lit(entity).alias("entity"), F.lit(reason).alias("reason"),
        F.to_json(F.struct(*[F.col(c) for c in bad.columns])).alias("record"),
    )
    return write_partitioned(rows, f"{base}/{entity}/{reason}", dt, run_id)["rows"]


def append_retry(df: DataFrame, path: str, keys: tuple[str, ...] = ("claim_id", "updated_at")) -> int:
    """K2: append the claim versions that are not queued yet; returns rows queued."""
    queued = read_if_exists(df.sparkSession, path)
    if queued is not None:
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys if k in df.columns]
        df = df.alias("n").join(queued.alias("q"), same, "left_anti")
    out, obs = _observed(df, "retry")
    out.write.mode("append").parquet(path)
    return obs.get["rows"]


def clear_retry(spark: SparkSession, path: str) -> None:
    """Empty the retry queue once its claims are stored elsewhere."""
    delete_path(spark, path)


def write_parquet(df: DataFrame, path: str) -> int:
    """K3: overwrite a Parquet table; returns rows written."""
    out, obs = _observed(df, "parquet")
    out.write.mode("overwrite").parquet(path)
    return obs.get["rows"]


def write_json_document(df: DataFrame, path: str) -> None:
    """A small one-row document (params, metadata, manifest) as JSON."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_training_csv(features: DataFrame, path: str) -> int:
    """K5: headerless CSV of the feature columns (no ``claim_id``); returns rows."""
    out, obs = _observed(features.drop("claim_id"), "training")
    out.write.mode("overwrite").option("header", False).csv(path)
    return obs.get["rows"]


def write_fraud_results(results: DataFrame, path: str, serving_path: str | None = None,
                        serving_limit: int | None = None) -> int:
    """K6: all results as JSON lines, gzipped (as plain text they take some ten times the space). Results are served from this full table; a top-n
    report by score is written only where the caller names its path and its n."""
    if serving_path and serving_limit is None:
        raise ValueError("a serving extract is a top-n report: give serving_limit")
    out, obs = _observed(results, "fraud", flagged=F.count_if(F.col("is_suspected_fraud")))
    out.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "gzip").json(path)
    if serving_path:
        serving_extract(results, serving_limit).write.mode("overwrite").option(
            "ignoreNullFields", False
        ).option("compression", "gzip").json(serving_path)
    return obs.get["rows"]


def write_quality_results(quality: DataFrame, path: str, breakdown: DataFrame | None = None,
                          breakdown_path: str | None = None) -> int:
    """K7: quality records as JSON lines, and the complete breakdown (one line per
    manufacturer and key) beside them."""
    out, obs = _observed(quality, "quality", concerns=F.count_if(F.col("is_quality_concern")))
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    if breakdown is not None:
        breakdown.write.mode("overwrite").option("ignoreNullFields", False).json(breakdown_path)
    return obs.get["rows"]


def append_audit(spark: SparkSession, entries: DataFrame, path: str) -> int:
    """K8: append entries not yet in the log (idempotent).

    A missing log starts fresh; a log that cannot be read is an error, or its entries
    would be appended again. The log is partitioned by model version, and only the
    partitions of the new entries' versions (a handful) are read for the comparison.
    """
    existing = read_if_exists(spark, path, AUDIT_ENTRY)
    if existing is not None:
        versions = [r[0] for r in entries.select("model_version").distinct().collect()]
        own = F.col("model_version").isin([v for v in versions if v is not None])
        # entries without a version are compared with the log's own such partition
        existing = existing.filter(own | F.col("model_version").isNull() if None in versions else own)
    fresh, obs = _observed(new_entries_only(entries, existing), "audit")
    fresh.write.mode("append").partitionBy("model_version").parquet(path)
    return obs.get["rows"]


def export_csv(df: DataFrame, path: str, limit: int | None = None) -> int:
    """K9: CSV with header; nested columns as JSON text. Quotes inside values
    are doubled (RFC 4180), so the JSON text survives any CSV reader."""
    out, obs = _observed(export_rows(df, limit=limit), "export")
    (
        out.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return obs.get["rows"]


def write_manifest(spark: SparkSession, path: str, job_name: str, model_path: str, seconds: float,
                   records: int, trees: int, samples: int, dim: int,
                   created_at: _dt.datetime | None = None) -> None:
    """Training manifest JSON."""
    created = (created_at or _dt.datetime.now(_dt.timezone.utc)).isoformat()
    row = (job_name, model_path, float(seconds), int(records), (trees, samples, dim), created)
    write_json_document(spark.createDataFrame([row], MODEL_MANIFEST), path)
