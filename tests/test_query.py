import datetime as dt

import pytest

from claimlens.operators import audit as A
from claimlens.operators import query as QY


@pytest.fixture
def fraud(spark):
    rows = [
        ("CLAIM-00001", "Acme Corp", "electronics", 0.85, True, ["claim_amount"], dt.datetime(2025, 1, 2, 10, 0)),
        ("CLAIM-00002", "Beta Inc", "appliances", 0.45, False, ["claim_type_repair"], dt.datetime(2025, 1, 3, 12, 0)),
        ("CLAIM-00003", "Beta Inc", "appliances", None, False, [], dt.datetime(2025, 1, 4, 0, 0)),
    ]
    return spark.createDataFrame(
        rows, "claim_id string, manufacturer_name string, product_category string, fraud_score double, "
              "is_suspected_fraud boolean, contributing_factors array<string>, scored_at timestamp"
    )


def ids(df):
    return sorted(r.claim_id for r in df.collect())


def test_filters(fraud):
    assert ids(QY.filter_results(fraud, QY.ResultFilters(manufacturer="Beta Inc"))) == ["CLAIM-00002", "CLAIM-00003"]
    assert ids(QY.filter_results(fraud, QY.ResultFilters(category="electronics"))) == ["CLAIM-00001"]
    # null score passes a score range
    assert ids(QY.filter_results(fraud, QY.ResultFilters(score_min=0.5))) == ["CLAIM-00001", "CLAIM-00003"]
    assert ids(QY.filter_results(fraud, QY.ResultFilters(reason="Suspected fraud"))) == ["CLAIM-00001"]
    # No flag filter by default; opt-in filter keeps flagged rows only
    assert len(ids(QY.filter_results(fraud, QY.ResultFilters()))) == 3
    assert ids(QY.filter_results(fraud, QY.ResultFilters(flagged_only=True))) == ["CLAIM-00001"]


def test_date_only_upper_bound_covers_day(fraud):
    f = QY.ResultFilters(date_from="2025-01-02", date_to="2025-01-03")
    assert ids(QY.filter_results(fraud, f)) == ["CLAIM-00001", "CLAIM-00002"]
    f = QY.ResultFilters(date_from="2025-01-02T11:00:00Z", date_to="2025-01-03T13:00:00+01:00")
    assert ids(QY.filter_results(fraud, f)) == ["CLAIM-00002"]


def test_sort_and_page(fraud):
    first = [r.claim_id for r in QY.page_items(fraud, 1, 2).collect()]
    assert first == ["CLAIM-00001", "CLAIM-00002"]
    assert [r.claim_id for r in QY.page_items(fraud, 2, 2).collect()] == ["CLAIM-00003"]
    s = QY.page_summary(fraud, 2, 2).collect()[0]
    assert (s.total, s.total_pages) == (3, 2)
    empty = QY.page_summary(fraud.limit(0), 1, 50).collect()[0]
    assert (empty.total, empty.total_pages) == (0, 1)
    with pytest.raises(ValueError):
        QY.page_items(fraud, 0, 10)
    with pytest.raises(ValueError):
        QY.page_items(fraud, 1, 0)
    assert QY.page_items(fraud, 1, 100_000).count() == 3  # the bound on a page is the service's
    from claimlens.plans import results_api as API

    with pytest.raises(ValueError):
        API.get_fraud_results(fraud, page_size=501)


def test_sort_by_any_column_with_missing_values_last(spark):
    rows = [("C1", None, None, 0.1), ("C2", "Beta", dt.date(2024, 1, 2), None), ("C3", "Acme", dt.date(2024, 1, 3), 0.3), ("C4", "Acme", None, -0.2)]
    df = spark.createDataFrame(rows, "claim_id string, manufacturer_name string, claim_date date, fraud_score double")
    order = lambda by, down: [r.claim_id for r in QY.sort_results(df, sort_by=by, descending=down).collect()]
    assert order("manufacturer_name", False) == ["C3", "C4", "C2", "C1"]
    assert order("manufacturer_name", True) == ["C2", "C3", "C4", "C1"]
    assert order("claim_date", True) == ["C3", "C2", "C1", "C4"]
    assert order("fraud_score", True) == ["C3", "C1", "C2", "C4"]  # a missing number counts as 0
    assert order("no_such_column", True) == ["C1", "C2", "C3", "C4"]


def test_keyset_pages_walk_all_rows_in_order(spark):
    rows = [(f"C{i:02d}", [None, "A", "B", "B"][i % 4], float(i % 3)) for i in range(23)]
    df = spark.createDataFrame(rows, "claim_id string, manufacturer_name string, fraud_score double")
    for by, down in (("manufacturer_name", False), ("manufacturer_name", True), ("fraud_score", True), (None, False)):
        whole = [tuple(r) for r in QY.sort_results(df, sort_by=by, descending=down).collect()]
        column = {"manufacturer_name": 1}.get(by, 2)
        page = QY.page_items(df, 1, 5, sort_by=by, descending=down).collect()
        seen = []
        while page:
            seen += [tuple(r) for r in page]
            page = QY.page_after(df, page[-1][column], page[-1].claim_id, 5, sort_by=by, descending=down).collect()
        assert seen == whole


def test_fixed_text_of_negative_and_large_numbers(spark):
    from pyspark.sql import functions as F

    from claimlens.functions.text import fixed

    df = spark.createDataFrame([(-12.34,), (-0.5,), (0.004,), (-0.004,), (7.0,), (None,), (90071992547409.92,)], "x double")
    got = [r[0] for r in df.select(fixed(F.col("x"), 2)).collect()]
    assert got == ["-12.34", "-0.50", "0.00", "0.00", "7.00", None, "90071992547409.92"]
    assert [r[0] for r in df.limit(2).select(fixed(F.col("x"), 0)).collect()] == ["-12", "-1"]


def test_review_texts_have_data_and_instruction(fraud):
    from pyspark.sql import functions as F

    rows = fraud.withColumns({c: F.lit("x") for c in ("claim_type", "status", "description", "contract_id", "sku")}).withColumns(
        {"claim_date": F.to_date(F.lit("2024-06-15")), "claim_amount": F.lit(-3.5)}
    )
    got = QY.fraud_prompts(rows).collect()
    assert [r.claim_id for r in got] == ["CLAIM-00001"]
    assert "CLAIM-00001" in got[0].prompt and "-3.50" in got[0].prompt and "0.8500" in got[0].prompt and len(got[0].instruction) > 50


def test_bounds_and_lookup(fraud):
    b = QY.score_bounds(fraud, "fraud_score").collect()[0]
    assert (b["min"], b["max"]) == (0.45, 0.85)
    e = QY.score_bounds(fraud.limit(0), "fraud_score").collect()[0]
    assert (e["min"], e["max"]) == (0.0, 1.0)
    assert QY.lookup(fraud, "claim_id", "CLAIM-00002").count() == 1
    assert QY.lookup(fraud, "claim_id", "nope").count() == 0


def test_export_json_round_trip(fraud, spark):
    out = QY.export_rows(fraud)
    assert dict(out.dtypes)["contributing_factors"] == "string"
    import json

    rows = {r.claim_id: json.loads(r.contributing_factors) for r in out.collect()}
    assert rows["CLAIM-00001"] == ["claim_amount"]


def test_audit_entries_one_per_flag(fraud, spark):
    fraud = fraud.withColumn("model_version", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("v1"))
    quality = spark.createDataFrame(
        [("M1", "Acme", 10, 0.5, 2.5, True, "v1"), ("M2", "Beta", 5, 0.1, 2.0, False, "v1")],
        "manufacturer_id string, manufacturer_name string, total_claims bigint, repair_claim_rate double, "
        "quality_score double, is_quality_concern boolean, model_version string",
    )
    log = A.audit_entries(fraud, quality, dt.datetime(2025, 1, 5))
    got = sorted((r.event_type, r.entity_id) for r in log.collect())
    assert got == [("fraud_flag", "CLAIM-00001"), ("quality_flag", "M1")]
    # idempotent append
    assert A.new_entries_only(log, log).count() == 0
    assert A.filter_audit(log, entity_type="claim").count() == 1
    assert A.filter_audit(log, date_from="2025-01-06").count() == 0


def test_audit_trail_join(fraud, spark):
    log = spark.createDataFrame(
        [("fraud_flag", "claim", "CLAIM-00001", "v1", 0.85, None, dt.datetime(2025, 1, 5))],
        "event_type string, entity_type string, entity_id string, model_version string, score double, "
        "details string, created_at timestamp",
    )
    out = {r.claim_id: r.event_type for r in A.with_audit_trail(fraud, log, "claim", "claim_id").collect()}
    assert out == {"CLAIM-00001": "fraud_flag", "CLAIM-00002": None, "CLAIM-00003": None}


def test_results_api_surface(fraud, spark):
    from claimlens.plans import results_api as API

    items, summary = API.get_fraud_results(fraud, page=1, page_size=2)
    assert [r.claim_id for r in items.collect()] == ["CLAIM-00001", "CLAIM-00002"]
    assert summary.first().total_pages == 2
    assert API.get_fraud_detail(fraud, "CLAIM-00003").count() == 1
    assert API.get_fraud_detail(fraud, "missing").count() == 0
    assert API.get_fraud_score_bounds(fraud).first()["max"] == 0.85
    quality = spark.createDataFrame(
        [("M1", "Acme", 2.5, {"electronics": ("electronics", 3, 0.5)}), ("M2", "Beta", 0.5, {})],
        "manufacturer_id string, manufacturer_name string, quality_score double, "
        "product_category_breakdown map<string, struct<category string, claim_count bigint, repair_rate double>>",
    )
    q_items, _ = API.get_quality_results(quality, QY.ResultFilters(category="electronics"))
    assert [r.manufacturer_id for r in q_items.collect()] == ["M1"]
    assert API.get_quality_detail(quality, "M2").first().manufacturer_name == "Beta"
    assert dict(API.export_quality(quality).dtypes)["product_category_breakdown"] == "string"
