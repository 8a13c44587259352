"""Manufacturer quality.

Everything groups by manufacturer with map-side partial aggregation, so a
manufacturer that owns a third of all claims costs one row per task in the
shuffle. Breakdown tables stay long (one row per manufacturer and key); only
bounded slices (the category list, the top-k SKUs) are nested into maps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import QUALITY_THRESHOLD
from ..functions.scalar import or_unknown, safe_ratio, zscore
from .stats import with_scalars



def _is_repair():
    return F.coalesce(F.col("claim_type") == F.lit("repair"), F.lit(False))


def known_manufacturer(results: DataFrame) -> DataFrame:
    """drop rows without a manufacturer (D3)."""
    m = F.col("manufacturer_id")
    return results.filter(m.isNotNull() & (m != ""))


def manufacturer_rollup(results: DataFrame) -> DataFrame:
    """A6 + A9: per manufacturer counts, repair rate and mean anomaly score."""
    scores = F.col("fraud_score") if "fraud_score" in results.columns else F.lit(None).cast("double")
    agg = known_manufacturer(results).groupBy("manufacturer_id").agg(
        F.min("manufacturer_name").alias("manufacturer_name"),
        F.count(F.lit(1)).alias("total_claims"),
        F.count_if(_is_repair()).alias("repair_count"),
        F.avg(scores).alias("mean_anomaly_score"),
    )
    return agg.withColumn("repair_claim_rate", safe_ratio(F.col("repair_count"), F.col("total_claims")))


def population_stats(rollup: DataFrame, column: str = "repair_claim_rate") -> DataFrame:
    """A10: population mean and stddev across manufacturers (one row)."""
    return rollup.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def manufacturer_quality(results: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """W4 + F8: z-score of each manufacturer's repair rate against its peers.

    The z-score of the mean anomaly score is carried as an extra column (D16).
    """
    rollup = manufacturer_rollup(results)
    both = rollup.agg(
        F.avg("repair_claim_rate").alias("rate_mean"),
        F.stddev_pop("repair_claim_rate").alias("rate_std"),
        F.avg("mean_anomaly_score").alias("score_mean"),
        F.stddev_pop("mean_anomaly_score").alias("score_std"),
    )
    p = F.col("_peers")
    rate = {"mean": p["rate_mean"], "std": p["rate_std"]}
    anomaly = {"mean": p["score_mean"], "std": p["score_std"]}
    scored = with_scalars(rollup, "_peers", both).withColumns(
        {
            "quality_score": zscore(F.col("repair_claim_rate"), rate["mean"], rate["std"]),
            "anomaly_score_z": zscore(F.col("mean_anomaly_score"), anomaly["mean"], anomaly["std"]),
        }
    )
    return scored.drop("_peers").withColumn("is_quality_concern", F.col("quality_score") > F.lit(threshold))


def category_breakdown(results: DataFrame) -> DataFrame:
    """Per manufacturer x category (null -> unknown) count and repair rate."""
    agg = (
        known_manufacturer(results)
        .groupBy("manufacturer_id", or_unknown(F.col("product_category")).alias("category"))
        .agg(F.count(F.lit(1)).alias("claim_count"), F.count_if(_is_repair()).alias("repair_count"))
    )
    return agg.withColumn("repair_rate", safe_ratio(F.col("repair_count"), F.col("claim_count")))


def sku_breakdown(results: DataFrame) -> DataFrame:
    """Per manufacturer x SKU (null -> unknown) count, repairs, repair rate."""
    agg = (
        known_manufacturer(results)
        .groupBy("manufacturer_id", or_unknown(F.col("sku")).alias("sku"))
        .agg(F.count(F.lit(1)).alias("claim_count"), F.count_if(_is_repair()).alias("repair_count"))
    )
    return agg.withColumn("repair_rate", safe_ratio(F.col("repair_count"), F.col("claim_count")))


def top_skus(breakdown: DataFrame, k: int | None) -> DataFrame:
    """Top-k SKUs by repair count per manufacturer (ties by SKU).

    ``row_number() <= k`` lets Spark insert a map-side group limit, so each
    task ships at most k rows per manufacturer. ``k=None`` is W3: the full
    ranking as a range-partitioned global sort (no single task per manufacturer).
    """
    order = [F.col("manufacturer_id"), F.col("repair_count").desc(), F.col("sku")]
    if k is None:
        return breakdown.orderBy(*order)
    w = Window.partitionBy("manufacturer_id").orderBy(F.col("repair_count").desc(), F.col("sku"))
    return breakdown.withColumn("sku_rank", F.row_number().over(w)).filter(F.col("sku_rank") <= k)


def category_map(breakdown: DataFrame) -> DataFrame:
    """A7 as ``map<category, struct<category, claim_count, repair_rate>>``.

    One row holds one manufacturer's categories; an open vocabulary is served by the long
    table (``category_breakdown``), which has the same rows.
    """
    entry = F.struct(
        F.col("category"),
        F.struct("category", "claim_count", "repair_rate"),
    )
    return breakdown.groupBy("manufacturer_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("product_category_breakdown")
    )


def quality_breakdown(results: DataFrame) -> DataFrame:
    """K7: the complete breakdown as rows: every category and every SKU of every manufacturer.

    A long table, so a manufacturer with millions of SKUs is that many rows and no row
    or task holds them all.
    """
    columns = ["claim_count", "repair_count", "repair_rate"]
    by_category = category_breakdown(results).select("manufacturer_id", F.lit("category").alias("kind"), F.col("category").alias("key"), *columns)
    by_sku = sku_breakdown(results).select("manufacturer_id", F.lit("sku").alias("kind"), F.col("sku").alias("key"), *columns)
    return by_category.unionByName(by_sku)


def top_sku_map(breakdown: DataFrame, k: int) -> DataFrame:
    """Report column: the ``k`` SKUs with most repairs as ``map<sku, struct<...>>``."""
    top = top_skus(breakdown, k)
    entry = F.struct(F.col("sku"), F.struct("sku", "claim_count", "repair_count", "repair_rate"))
    return top.groupBy("manufacturer_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("top_skus"))


def quality_results(
    results: DataFrame,
    model_version: str,
    scored_at,
    threshold: float = QUALITY_THRESHOLD,
    top_k: int = 10,
) -> DataFrame:
    """The per-manufacturer result record.

    ``product_category_breakdown`` nests all categories; of the SKUs the record shows the
    ``top_k`` by repairs (``top_skus``), and :func:`quality_breakdown` has them all.
    """
    quality = manufacturer_quality(results, threshold)
    cats = category_map(category_breakdown(results))
    skus = top_sku_map(sku_breakdown(results), top_k)
    return (
        quality.join(cats, "manufacturer_id", "left")
        .join(skus, "manufacturer_id", "left")
        .select(
            "manufacturer_id",
            "manufacturer_name",
            "total_claims",
            "repair_count",
            "repair_claim_rate",
            "quality_score",
            "is_quality_concern",
            "mean_anomaly_score",
            "anomaly_score_z",
            "product_category_breakdown",
            "top_skus",
            F.lit(model_version).alias("model_version"),
            F.lit(scored_at).cast("timestamp").alias("scored_at"),
        )
    )
