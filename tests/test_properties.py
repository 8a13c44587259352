"""Hypothesis properties from the specs, on small frames (few examples, one session)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from claimlens.operators import features as FE
from claimlens.operators import query as QY
from claimlens.operators import scoring as S
from claimlens.operators.stats import lower_medians

FAST = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
scores = st.lists(st.floats(min_value=0, max_value=1e5, allow_nan=False), min_size=1, max_size=30)


@FAST
@given(vals=scores)
def test_normalised_in_unit_interval(spark, vals):
    df = spark.createDataFrame([(f"c{i}", v) for i, v in enumerate(vals)], "claim_id string, raw_score double")
    out = [r.fraud_score for r in S.normalize_scores(df).collect()]
    assert all(0.0 <= v <= 1.0 for v in out)
    if max(vals) > min(vals):
        assert min(out) == 0.0 and max(out) == 1.0


@FAST
@given(vals=scores)
def test_exact_median_is_lower_median(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "a double")
    got = lower_medians(df, ["a"]).collect()[0].median
    s = sorted(vals)
    assert got == s[math.ceil(len(s) / 2) - 1]


@FAST
@given(vals=st.lists(st.floats(min_value=-1e4, max_value=1e4, allow_nan=False), min_size=2, max_size=25))
def test_inverse_scaling_recovers(spark, vals):
    df = spark.createDataFrame([(f"c{i}", v) for i, v in enumerate(vals)], "claim_id string, claim_amount double")
    s = FE.standard_scale(df, ["claim_amount"])
    back = [r.claim_amount for r in FE.inverse_scale(s.frame, s.params, ["claim_amount"]).orderBy("claim_id").collect()]
    want = [v for _, v in sorted((f"c{i}", v) for i, v in enumerate(vals))]
    assert all(abs(a - b) <= 1e-6 * max(1.0, abs(b)) for a, b in zip(back, want))


@FAST
@given(vals=scores, t=st.floats(min_value=0, max_value=1))
def test_flag_iff_above_threshold(spark, vals, t):
    df = spark.createDataFrame([(f"c{i}", v / 1e5) for i, v in enumerate(vals)], "claim_id string, fraud_score double")
    assert all(r.is_suspected_fraud == (r.fraud_score > t) for r in S.flag_fraud(df, t).collect())


@FAST
@given(vals=scores, lo=st.floats(min_value=0, max_value=0.5), hi=st.floats(min_value=0.5, max_value=1))
def test_every_filtered_item_satisfies_filters_and_sorted(spark, vals, lo, hi):
    df = spark.createDataFrame([(f"c{i}", v / 1e5) for i, v in enumerate(vals)], "claim_id string, fraud_score double")
    out = QY.page_items(QY.filter_results(df, QY.ResultFilters(score_min=lo, score_max=hi)), 1, 500).collect()
    assert all(lo <= r.fraud_score <= hi for r in out)
    assert [r.fraud_score for r in out] == sorted((r.fraud_score for r in out), reverse=True)


claims_rows = st.lists(
    st.tuples(st.sampled_from(["M1", "M2", "M3", None]), st.sampled_from(["repair", "refund", "replacement", None]),
              st.sampled_from(["electronics", "toys", None]), st.floats(min_value=0, max_value=1)),
    min_size=1, max_size=40,
)


def _results(spark, rows):
    data = [(f"c{i}", m, f"name-{m}" if m else None, t, c, f"S{i % 4}", s) for i, (m, t, c, s) in enumerate(rows)]
    return spark.createDataFrame(
        data, "claim_id string, manufacturer_id string, manufacturer_name string, claim_type string, "
              "product_category string, sku string, fraud_score double")


@FEW
@given(rows=claims_rows)
def test_quality_counts_and_zscore(spark, rows):
    from claimlens.operators import quality as Q

    res = _results(spark, rows)
    q = {r.manufacturer_id: r for r in Q.manufacturer_quality(res).collect()}
    known = [(m, t) for m, t, _, _ in rows if m]
    assert set(q) == {m for m, _ in known}
    rates = {}
    for m in q:
        total = sum(1 for mm, _ in known if mm == m)
        repairs = sum(1 for mm, t in known if mm == m and t == "repair")
        assert q[m].total_claims == total and q[m].repair_count == repairs
        rates[m] = repairs / total
    if rates:
        mean = sum(rates.values()) / len(rates)
        std = (sum((r - mean) ** 2 for r in rates.values()) / len(rates)) ** 0.5
        for m, r in rates.items():
            want = (r - mean) / std if std > 1e-12 else 0.0
            assert abs(q[m].quality_score - want) < 1e-9
    cats = Q.category_breakdown(res).groupBy("manufacturer_id").sum("claim_count").collect()
    assert {r.manufacturer_id: r[1] for r in cats} == {m: q[m].total_claims for m in q}


@FEW
@given(rows=claims_rows, t=st.floats(min_value=0, max_value=1))
def test_audit_one_entry_per_flag(spark, rows, t):
    import datetime as dt

    from pyspark.sql import functions as F

    from claimlens.operators import audit as A
    from claimlens.operators import quality as Q
    from claimlens.operators.scoring import flag_fraud

    res = flag_fraud(_results(spark, rows), t).withColumn("contributing_factors", F.array(F.lit("claim_amount"))) \
        .withColumn("model_version", F.lit("v"))
    quality = Q.manufacturer_quality(res).withColumn("model_version", F.lit("v"))
    log = A.audit_entries(res, quality, dt.datetime(2025, 1, 1)).collect()
    claims = [r.entity_id for r in log if r.event_type == "fraud_flag"]
    assert sorted(claims) == sorted(f"c{i}" for i, (_, _, _, s) in enumerate(rows) if s > t)
    assert len(set(claims)) == len(claims)


@FAST
@given(lines=st.lists(st.one_of(
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(repr),
    st.floats(min_value=0, max_value=1e3, allow_nan=False).map(lambda v: '{"score": %r}' % v),
    st.sampled_from(["bad", "{bad", "", "   ", '{"x": 1}', '{"score": null}'])), min_size=1, max_size=30))
def test_score_lines_nothing_lost_or_duplicated(spark, lines):
    from claimlens.sources.score_lines import parse_score_lines, split_scores

    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    good, bad = split_scores(parse_score_lines(df))
    g, b = [r.n for r in good.collect()], [r.n for r in bad.collect()]
    non_blank = [i for i, v in enumerate(lines) if v.strip()]
    assert sorted(g + b) == non_blank  # every non-blank line exactly once
    for r in good.collect():
        text = lines[r.n].strip()
        if not text.startswith("{"):
            assert r.raw_score == float(text)


@FEW
@given(rows=st.lists(st.tuples(st.text(alphabet="abc,\"' ", min_size=1, max_size=6),
                               st.lists(st.text(alphabet="xyz", min_size=1, max_size=4), max_size=3)),
                     min_size=1, max_size=10))
def test_csv_export_round_trips(spark, rows):
    import json
    import os
    import tempfile

    from claimlens.sinks.writers import export_csv

    df = spark.createDataFrame([(f"id{i}", name, factors) for i, (name, factors) in enumerate(rows)],
                               "claim_id string, name string, contributing_factors array<string>")
    path = os.path.join(tempfile.mkdtemp(prefix="claimlens-export-"), "out")
    export_csv(df, path)
    back = {r.claim_id: r for r in spark.read.option("header", True).option("escape", '"').csv(path).collect()}
    for i, (name, factors) in enumerate(rows):
        r = back[f"id{i}"]
        assert json.loads(r.contributing_factors) == factors
        assert r.name == name
