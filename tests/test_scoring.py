import pytest

from claimlens.config import FRAUD_REASONS
from claimlens.operators import scoring as S
from claimlens.operators.query import fraud_reason_text


def _norm(spark, vals):
    df = spark.createDataFrame([(f"c{i}", v) for i, v in enumerate(vals)], "claim_id string, raw_score double")
    return [r.fraud_score for r in S.normalize_scores(df).orderBy("claim_id").collect()]


def test_normalize(spark):
    assert _norm(spark, [1.0, 2.0, 3.0]) == pytest.approx([0.0, 0.5, 1.0])
    assert _norm(spark, [4.0, 4.0]) == [0.0, 0.0]
    assert _norm(spark, [9.0]) == [0.0]
    empty = spark.createDataFrame([], "claim_id string, raw_score double")
    assert S.normalize_scores(empty).count() == 0


def test_flag_is_strict(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.7000001), ("c", 1.0), ("d", 0.4)], "claim_id string, fraud_score double")
    flags = {r.claim_id: r.is_suspected_fraud for r in S.flag_fraud(df).collect()}
    assert flags == {"a": False, "b": True, "c": True, "d": False}


def test_reason_boundaries(spark):
    df = spark.createDataFrame(
        [("a", 0.39, ["claim_amount"]), ("b", 0.4, ["claim_amount"]), ("c", 0.7, ["claim_amount", "product_category_unknown"])],
        "claim_id string, fraud_score double, contributing_factors array<string>",
    )
    got = {r.claim_id: r.reason for r in fraud_reason_text(df).collect()}
    assert got["a"] == FRAUD_REASONS[0] and got["b"] == FRAUD_REASONS[1]
    # exactly 0.7: category says flagged while the flag (strict) says no
    assert got["c"] == "Suspected fraud — High claim amount; Unknown product category"


def test_contributing_factors_top3_desc_ties_keep_order(spark):
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([("x", 0.5, -3.0, 1.0, 1.0)], "claim_id string, a double, b double, c double, d double")
    out = S.contributing_factors(df, cols=cols).collect()[0].contributing_factors
    assert out == ["b", "c", "d"]


def test_contributing_factors_with_params(spark):
    df = spark.createDataFrame([("x", 10.0, 1.0)], "claim_id string, a double, b double")
    params = spark.createDataFrame([(10.0, 2.0)], "a__mean double, a__std double")
    out = S.contributing_factors(df, params, cols=["a", "b"], k=2).collect()[0].contributing_factors
    assert out == ["b", "a"]  # a deviates 0 from its mean, b is |1|


def test_align_scores_reports_both_sides(spark):
    feats = spark.createDataFrame([("a",), ("b",)], "claim_id string")
    scores = spark.createDataFrame([("b", 1.0), ("z", 2.0)], "claim_id string, raw_score double")
    matched, errors = S.align_scores(feats, scores)
    assert [r.claim_id for r in matched.collect()] == ["b"]
    assert {(r.claim_id, r.error) for r in errors.collect()} == {("a", "missing_score"), ("z", "missing_features")}


def test_compat_double_scale_reproduces_reference(spark):
    """With the scaler params, scaled values are standardised a second time."""
    df = spark.createDataFrame([("x", 0.5, 2.0)], "claim_id string, a double, b double")
    params = spark.createDataFrame([(100.0, 10.0, 0.0, 1.0)], "a__mean double, a__std double, b__mean double, b__std double")
    pure = S.contributing_factors(df, None, cols=["a", "b"], k=2).collect()[0].contributing_factors
    compat = S.contributing_factors(df, params, cols=["a", "b"], k=2).collect()[0].contributing_factors
    assert pure == ["b", "a"]      # |0.5| < |2.0|
    assert compat == ["a", "b"]    # |0.5 - 100| / 10 = 9.95 > |2 - 0| / 1


def test_ranked_names_are_sorted_without_a_comparator_per_pair(spark):
    from pyspark.sql import functions as F

    from claimlens.functions.scalar import top_k_names

    rows = spark.createDataFrame([(1.0, 3.0, 3.0, 0.0), (None, 2.0, float("nan"), 5.0), (0.0, -0.0, 0.0, 0.0)], "a double, b double, c double, d double")
    out = rows.select(top_k_names([(c, F.col(c)) for c in "abcd"], 3).alias("n"))
    assert "lambdafunction(CASE" not in out._jdf.queryExecution().optimizedPlan().toString() and "array_sort" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.n for r in out.collect()] == [["b", "c", "a"], ["a", "d", "b"], ["a", "b", "c"]]
    entries = F.array(*[F.struct((-F.col(c)).alias("neg"), F.lit(i).alias("pos"), F.lit(c).alias("name")) for i, c in enumerate("abcd")])
    plain = rows.select(F.slice(F.transform(F.array_sort(entries), lambda e: e["name"]), 1, 3).alias("n"))
    assert [r.n for r in plain.collect()] == [r.n for r in out.collect()]
