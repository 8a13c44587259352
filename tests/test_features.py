"""Feature operators."""

import pytest
from pyspark.sql import functions as F

from claimlens.operators import features as FE

# a hot maker, missing and unlisted values, a claim before its contract, a negative amount
ENRICHED = [
    ("a", "k1", "2023-03-01", "2023-02-27", "repair", 81.5, "furniture", "hot", "Hot Makers"),
    ("b", "k6", "2024-03-01", "2024-02-27", "refund", -20.0, None, "hot", "Hot Makers"),
    ("c", "k2", "2023-01-01", "2023-01-31", None, None, "toys", "hot", "Hot Makers"),
    ("d", "k3", None, "2023-01-31", "swap", 9000.0, "electronics", "hot", "Hot Makers"),
    ("e", "k4", "2023-12-31", None, "replacement", 0.0, "appliances", None, None),
    ("f", "k5", "2023-06-30", "2022-06-30", "refund", 81.5, "automotive", "rare", "Rare Ltd"),
]
COLS = ["claim_id", "contract_id", "claim_date", "start_date", "claim_type", "claim_amount",
        "product_category", "manufacturer_id", "manufacturer_name"]


@pytest.fixture
def enriched(spark):
    types = ["double" if c == "claim_amount" else "string" for c in COLS]
    return spark.createDataFrame(ENRICHED, ", ".join(f"{c} {t}" for c, t in zip(COLS, types, strict=True)))


def test_manufacturer_frequency(enriched):
    out = {r.claim_id: r.manufacturer_claim_frequency for r in FE.with_manufacturer_frequency(enriched).collect()}
    assert out == {"a": 4.0, "b": 4.0, "c": 4.0, "d": 4.0, "e": None, "f": 1.0}


def test_null_manufacturer_gets_null_frequency(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", "M")], "claim_id string, manufacturer_id string")
    out = {r.claim_id: r.manufacturer_claim_frequency for r in FE.with_manufacturer_frequency(df).collect()}
    assert out == {"a": None, "b": None, "c": 1.0}


def test_one_hot(enriched):
    rows = {r.claim_id: r for r in FE.one_hot_encode(enriched).collect()}
    types = {k: [r[f"claim_type_{v}"] for v in ("repair", "replacement", "refund", "unknown")] for k, r in rows.items()}
    assert types == {"a": [1, 0, 0, 0], "b": [0, 0, 1, 0], "c": [0, 0, 0, 1], "d": [0, 0, 0, 0], "e": [0, 1, 0, 0], "f": [0, 0, 1, 0]}
    kinds = ("electronics", "appliances", "automotive", "furniture", "unknown")
    # a missing category is "unknown"; an unlisted one is none of the columns
    assert [rows["b"][f"product_category_{c}"] for c in kinds] == [0, 0, 0, 0, 1]
    assert [rows["c"][f"product_category_{c}"] for c in kinds] == [0] * 5
    assert dict(FE.one_hot_encode(enriched).dtypes)["claim_type_repair"] == "tinyint"


def test_days_feature(enriched):
    rows = {r.claim_id: r[FE.DAYS] for r in FE.with_days_feature(enriched).collect()}
    assert rows == {"a": 2.0, "b": 3.0, "c": -30.0, "d": None, "e": None, "f": 365.0}  # b spans a leap day


def test_days_feature_bad_date_is_null(spark):
    df = spark.createDataFrame([("x", "not-a-date", "2024-01-01")], "claim_id string, claim_date string, start_date string")
    assert FE.with_days_feature(df).collect()[0][FE.DAYS] is None


def test_impute_lower_median(spark):
    df = spark.createDataFrame(
        [("C1", 100.0, 10.0, 5.0), ("C2", 200.0, 20.0, 10.0), ("C3", None, None, None)],
        "claim_id string, claim_amount double, days_between_contract_start_and_claim double, manufacturer_claim_frequency double",
    )
    out = {r.claim_id: r for r in FE.impute_median(df).collect()}
    assert (out["C3"].claim_amount, out["C3"].days_between_contract_start_and_claim, out["C3"].manufacturer_claim_frequency) == (100.0, 10.0, 5.0)


def test_impute_all_null_column_gets_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "claim_id string, claim_amount double")
    assert [r.claim_amount for r in FE.impute_median(df, ["claim_amount"]).collect()] == [0.0, 0.0]


def test_exact_median_matches_definition(spark):
    from claimlens.operators.stats import lower_medians

    vals = [5.0, 1.0, 4.0, 2.0, 3.0, 3.0, 9.0, 8.0]
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = lower_medians(df, ["a"]).collect()[0].median
    s = sorted(vals)
    assert got == s[(len(s) + 1) // 2 - 1]


def test_exact_median_by_narrow_brackets(spark):
    """Coarse percentiles, so that the bracket really narrows: hot values, nulls, NaN, odd and even counts."""
    import random

    from claimlens.operators.stats import lower_medians

    rng = random.Random(4)
    for n in (1, 2, 1000, 5001):
        a = [rng.choice([rng.gauss(0, 1), 0.25, None, float("nan")]) for _ in range(n)]
        b = [rng.expovariate(1) for _ in range(n)]
        df = spark.createDataFrame(list(zip(a, b, [None] * n, strict=True)), "a double, b double, c double")
        got = {r.name: r.median for r in lower_medians(df, ["a", "b", "c"], accuracy=20).collect()}
        want = {}
        for name, vals in (("a", [v for v in a if v is not None and v == v]), ("b", b)):
            if vals:
                want[name] = sorted(vals)[(len(vals) + 1) // 2 - 1]
        assert got == want


def test_standard_scale(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 20.0), ("c", 30.0)], "claim_id string, claim_amount double")
    s = FE.standard_scale(df, ["claim_amount"])
    vals = sorted(r.claim_amount for r in s.frame.collect())
    assert vals == pytest.approx([-1.0, 0.0, 1.0])
    p = s.params.collect()[0]
    assert p["claim_amount__mean"] == pytest.approx(20.0) and p["claim_amount__std"] == pytest.approx(10.0)


def test_scale_single_row_and_constant_std_is_one(spark):
    one = spark.createDataFrame([("a", 7.0)], "claim_id string, claim_amount double")
    assert FE.scaler_params(one, ["claim_amount"]).collect()[0]["claim_amount__std"] == 1.0
    const = spark.createDataFrame([("a", 7.0), ("b", 7.0)], "claim_id string, claim_amount double")
    assert FE.scaler_params(const, ["claim_amount"]).collect()[0]["claim_amount__std"] == 1.0


def test_inverse_scale_round_trip(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 11.0), ("c", 40.0)], "claim_id string, claim_amount double")
    s = FE.standard_scale(df, ["claim_amount"])
    back = sorted(r.claim_amount for r in FE.inverse_scale(s.frame, s.params, ["claim_amount"]).collect())
    assert back == pytest.approx([3.0, 11.0, 40.0])


def test_feature_chain_keeps_rows_and_columns(enriched, spark):
    contracts = enriched.select("contract_id", F.to_date("start_date").alias("start_date"))
    claims = enriched.drop("start_date").withColumn("claim_date", F.to_date("claim_date"))
    fs = FE.engineer_features(claims, contracts)
    fm = FE.feature_matrix(fs.frame)
    assert fm.count() == 6
    from claimlens.config import feature_columns

    assert fm.columns == ["claim_id"] + feature_columns()
    assert len(feature_columns()) == 12
    assert fm.filter(" OR ".join(f"{c} IS NULL" for c in feature_columns())).count() == 0


def test_approx_median_option(spark):
    from claimlens.config import RunSettings

    df = spark.createDataFrame([(f"c{i}", float(i)) for i in range(1, 102)] + [("cn", None)],
                               "claim_id string, claim_amount double")
    out = FE.impute_median(df, ["claim_amount"], RunSettings(exact_median=False)).filter("claim_id = 'cn'").collect()
    assert abs(out[0].claim_amount - 51.0) <= 1.0
