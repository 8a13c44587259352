"""Manufacturer rollups that follow changes (A2, A6-A8): signed deltas, merged by sums.

A changed claim is subtracted as it was and added as it is, so a day's work is in proportion to
its changes and old claims are never read. Deltas are exact integers and may be merged in any
order and grouping; a delta that was stored is a partial aggregate like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import or_unknown, safe_ratio
from .enrich import enrich_claims
from .quality import known_manufacturer

KEYS = ("manufacturer_id", "product_category", "sku")
SUMS = ("claims", "repairs")


def rollup_delta(changes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Signed counts per manufacturer, category and SKU of ``changes`` (``old``, ``new`` claim records, old null for a
    new claim). The catalog is the one that all deltas are made with: a changed catalog needs a full rollup."""
    fields = changes.schema["new"].dataType.fieldNames()
    signed = changes.select("new.*", F.lit(1).alias("sign")).unionByName(
        changes.filter(F.col("old").isNotNull()).select("old.*", F.lit(-1).alias("sign"))
    )
    rows = known_manufacturer(enrich_claims(signed.select(*fields, "sign"), catalog))
    repair = F.coalesce((F.col("claim_type") == F.lit("repair")).cast("int"), F.lit(0))
    return rows.groupBy(*KEYS).agg(F.sum("sign").alias("claims"), F.sum(F.col("sign") * repair).alias("repairs"))


def merge_rollups(*parts: DataFrame) -> DataFrame:
    """One rollup of several: sums per key; keys whose claims are all retracted go."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).filter("claims <> 0")


def rollup_by(rollup: DataFrame, *keys: str) -> DataFrame:
    """A6 (``manufacturer_id``), A7 (with ``product_category``) or A8 (with ``sku``) from a merged rollup."""
    named = rollup.withColumns({c: or_unknown(F.col(c)) for c in keys if c != "manufacturer_id"})
    out = named.groupBy(*keys).agg(F.sum("claims").alias("total_claims"), F.sum("repairs").alias("repair_count"))
    return out.withColumn("repair_claim_rate", safe_ratio(F.col("repair_count"), F.col("total_claims")))
