import pytest

from claimlens.operators import quality as Q


def _results(spark, rows):
    return spark.createDataFrame(
        rows, "claim_id string, manufacturer_id string, manufacturer_name string, claim_type string, "
              "product_category string, sku string, fraud_score double"
    )


ROWS = [
    ("1", "M1", "One", "repair", "electronics", "S1", 0.9),
    ("2", "M1", "One", "repair", None, "S1", 0.8),
    ("3", "M1", "One", "refund", "electronics", "S2", 0.1),
    ("4", "M2", "Two", "refund", "appliances", "S3", 0.2),
    ("5", "M2", "Two", None, "appliances", None, 0.3),
    ("6", "M3", "Three", "replacement", "furniture", "S4", 0.4),
    ("7", None, None, "repair", "furniture", "S5", 0.5),
    ("8", "", None, "repair", "furniture", "S5", 0.5),
]


def test_rollup_rates_and_zscore(spark):
    q = {r.manufacturer_id: r for r in Q.manufacturer_quality(_results(spark, ROWS)).collect()}
    assert set(q) == {"M1", "M2", "M3"}  # null / empty manufacturer dropped
    assert q["M1"].total_claims == 3 and q["M1"].repair_count == 2
    assert q["M1"].repair_claim_rate == pytest.approx(2 / 3)
    rates = [2 / 3, 0.0, 0.0]
    mean = sum(rates) / 3
    std = (sum((r - mean) ** 2 for r in rates) / 3) ** 0.5
    assert q["M1"].quality_score == pytest.approx((2 / 3 - mean) / std)
    assert not q["M1"].is_quality_concern


def test_one_manufacturer_scores_zero(spark):
    q = Q.manufacturer_quality(_results(spark, ROWS[:3])).collect()
    assert len(q) == 1 and q[0].quality_score == 0.0


def test_breakdowns_sum_to_total(spark):
    res = _results(spark, ROWS)
    cats = {(r.manufacturer_id, r.category): r.claim_count for r in Q.category_breakdown(res).collect()}
    assert cats[("M1", "unknown")] == 1 and cats[("M1", "electronics")] == 2
    skus = {(r.manufacturer_id, r.sku): r for r in Q.sku_breakdown(res).collect()}
    assert skus[("M2", "unknown")].claim_count == 1
    assert skus[("M1", "S1")].repair_count == 2 and skus[("M1", "S1")].repair_rate == 1.0
    total = {r.manufacturer_id: r.total_claims for r in Q.manufacturer_rollup(res).collect()}
    for m, n in total.items():
        assert sum(c for (mm, _), c in cats.items() if mm == m) == n


def test_top_skus_rank_and_ties(spark):
    res = _results(spark, ROWS)
    top = Q.top_skus(Q.sku_breakdown(res), 1).collect()
    assert {(r.manufacturer_id, r.sku) for r in top} == {("M1", "S1"), ("M2", "S3"), ("M3", "S4")}
    full = [(r.manufacturer_id, r.sku) for r in Q.top_skus(Q.sku_breakdown(res), None).collect()]
    assert full[:2] == [("M1", "S1"), ("M1", "S2")]


def test_quality_results_nested_maps(spark):
    out = {r.manufacturer_id: r for r in Q.quality_results(_results(spark, ROWS), "v1", "2025-01-01 00:00:00").collect()}
    m1 = out["M1"]
    assert set(m1.product_category_breakdown) == {"electronics", "unknown"}
    assert m1.product_category_breakdown["electronics"].claim_count == 2
    assert m1.top_skus["S1"].repair_count == 2


def test_breakdown_is_complete_beyond_the_report(spark):
    rows = [(str(i), "M1", "One", "repair", f"cat{i % 40}", f"S{i}", 0.5) for i in range(300)]
    res = _results(spark, rows)
    record = Q.quality_results(res, "v1", "2025-01-01 00:00:00", top_k=3).first()
    assert len(record.top_skus) == 3 and len(record.product_category_breakdown) == 40
    counts = {r.kind: r["count"] for r in Q.quality_breakdown(res).groupBy("kind").count().collect()}
    assert counts == {"category": 40, "sku": 300}
