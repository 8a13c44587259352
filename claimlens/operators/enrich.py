"""Enrichment: claims joined to the product catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ingest import latest_version

LOOKUP_COLUMNS = ("manufacturer_id", "manufacturer_name", "product_category")


def dedupe_catalog(catalog: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per SKU; the row that sorts last by ``order_by`` wins."""
    return latest_version(catalog, "sku", order_by or [])


def enrich_claims(claims: DataFrame, catalog: DataFrame) -> DataFrame:
    """J1 + P1: claims left-joined to the catalog on ``sku``.

    Unknown SKUs keep their claim with null manufacturer fields and
    ``manufacturer_unknown = true``. No broadcast hint: AQE broadcasts the
    catalog when its measured size is under the threshold and otherwise keeps
    a sort-merge join whose skewed partitions it splits.
    """
    lookup = catalog.select("sku", *[F.col(c).alias(f"_lk_{c}") for c in LOOKUP_COLUMNS])
    joined = claims.join(lookup, "sku", "left")
    return joined.select(
        *[F.col(c) for c in claims.columns],
        *[F.col(f"_lk_{c}").alias(c) for c in LOOKUP_COLUMNS],
        F.col("_lk_manufacturer_id").isNull().alias("manufacturer_unknown"),
    )


def empty_enrichment(claims: DataFrame) -> DataFrame:
    """Manufacturer columns with null / true defaults."""
    return claims.select(
        "*",
        F.lit(None).cast("string").alias("manufacturer_id"),
        F.lit(None).cast("string").alias("manufacturer_name"),
        F.lit(None).cast("string").alias("product_category"),
        F.lit(True).alias("manufacturer_unknown"),
    )


def enrich_or_queue(claims: DataFrame, catalog: DataFrame | None) -> tuple[DataFrame | None, DataFrame]:
    """With no readable catalog every claim goes to the retry queue and
    nothing is enriched (the caller must not overwrite earlier output)."""
    if catalog is None:
        return None, claims
    return enrich_claims(claims, catalog), claims.limit(0)


def distinct_skus(claims: DataFrame) -> DataFrame:
    """A1/U4: distinct SKUs referenced by claims."""
    return claims.select("sku").distinct()


def sku_lookup(requested: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J6 + U3: (found rows, not-found SKUs) for a frame of requested ``sku``.

    Not-found keeps repeats of the request, like the list it replaces.
    """
    cat = catalog.select("sku", "manufacturer_id", "manufacturer_name", "product_category")
    found = requested.select("sku").join(cat, "sku", "inner")
    missing = requested.select("sku").join(cat.select("sku"), "sku", "left_anti")
    return found, missing


def unknown_manufacturer_counts(enriched: DataFrame) -> DataFrame:
    """Rows, unknown-manufacturer rows and their share."""
    return enriched.agg(
        F.count(F.lit(1)).alias("claims"),
        F.count_if(F.col("manufacturer_unknown")).alias("unknown_manufacturer"),
    )


def replay_retry(ingested: DataFrame, retry: DataFrame, key: str = "claim_id") -> DataFrame:
    """Ingested claims plus the retry queue, one latest version per key."""
    return latest_version(ingested.unionByName(retry, allowMissingColumns=True), key, ["updated_at"])
