"""A manufacturer with a third of all claims: results stay exact and the
claims are never shuffled by manufacturer."""

from pyspark.sql import functions as F

from claimlens.operators import features as FE
from claimlens.operators import quality as Q


def _claims(spark, n=3000):
    df = spark.range(n).select(
        F.format_string("C%06d", "id").alias("claim_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.format_string("M%03d", F.col("id") % 97)).alias("manufacturer_id"),
        F.when(F.col("id") % 5 == 0, "repair").otherwise("refund").alias("claim_type"),
        F.lit("electronics").alias("product_category"),
        F.format_string("S%04d", F.col("id") % 211).alias("sku"),
        F.lit("name").alias("manufacturer_name"),
    )
    return df


def test_hot_manufacturer_frequency_is_broadcast(spark):
    claims = _claims(spark)
    out = FE.with_manufacturer_frequency(claims)
    rows = {r.claim_id: r.manufacturer_claim_frequency for r in out.collect()}
    assert rows["C000000"] == 1000.0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hot_manufacturer_quality_exact(spark):
    q = {r.manufacturer_id: r for r in Q.manufacturer_rollup(_claims(spark)).collect()}
    assert q["HOT"].total_claims == 1000
    assert q["HOT"].repair_count == sum(1 for i in range(0, 3000, 3) if i % 5 == 0)
    top = Q.top_skus(Q.sku_breakdown(_claims(spark)), 3).filter("manufacturer_id = 'HOT'").count()
    assert top == 3


def test_hot_sku_enrichment_and_contract_join_exact(spark):
    """A SKU and a contract holding a third of all claims: joins stay exact with
    the broadcast thresholds off (sort-merge joins, AQE skew handling)."""
    from claimlens.operators import enrich as E

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        claims = spark.range(3000).select(
            F.format_string("C%06d", "id").alias("claim_id"),
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.format_string("S%04d", F.col("id") % 50)).alias("sku"),
            F.when(F.col("id") % 3 == 1, "K-HOT").otherwise(F.format_string("K%05d", "id")).alias("contract_id"),
            F.to_date(F.lit("2024-06-01")).alias("claim_date"),
        )
        catalog = spark.range(50).select(
            F.format_string("S%04d", "id").alias("sku"), F.lit("M").alias("manufacturer_id"),
            F.lit("Maker").alias("manufacturer_name"), F.lit("electronics").alias("product_category"),
        ).unionByName(spark.createDataFrame([("HOT", "MH", "Hot", "toys")], "sku string, manufacturer_id string, "
                                            "manufacturer_name string, product_category string"))
        enriched = E.enrich_claims(claims, catalog)
        counts = {r.manufacturer_id: r["count"] for r in enriched.groupBy("manufacturer_id").count().collect()}
        assert counts == {"MH": 1000, "M": 2000}
        contracts = spark.createDataFrame([("K-HOT", "2024-01-01")], "contract_id string, start_date string").select(
            "contract_id", F.to_date("start_date").alias("start_date"))
        days = FE.with_days_feature(FE.with_contract_start(enriched, contracts))
        assert days.filter(F.col(FE.DAYS) == 152.0).count() == 1000
        assert "SortMergeJoin" in days._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        if prev_aqe is not None:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev_aqe)
        else:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
