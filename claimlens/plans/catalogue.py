"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables through the warranty views. Output
columns are flat and engine-neutral (floats rounded to 6 places, dates and
timestamps as text, arrays joined) so the SQL twins in ``oracle.py`` can be
compared value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CONTINUOUS_FEATURES, RunSettings, one_hot_columns
from ..operators import audit as A
from ..operators import enrich as E
from ..operators import features as FE
from ..operators import quality as Q
from ..operators import query as QY
from ..operators import scoring as S
from ..operators.ingest import apply_watermark, latest_version
from ..sinks import writers as K
from ..sources import warranty_views as views
from ..sources.score_lines import key_score_lines, parse_score_lines, read_score_lines
from ..sources.tables import read_table
from ..streaming.incremental import ingest_available, ingested_claims
from . import warranty as W
from .stages import stage, stage_root

WATERMARK = "2000-01-01T00:00:00Z"
SERVING_REPORT = 10_000
AUDIT_FROM, AUDIT_TO = "2024-12-31", "2025-01-01"
PAGE, PAGE_SIZE = 2, 50
PAGE_FILTERS = QY.ResultFilters(category="electronics", score_min=0.05, reason="Within normal range")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def day_text(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def ts_text(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def _inputs(spark: SparkSession, sf: str) -> W.Inputs:
    return W.view_inputs(spark, sf)


def _features(spark: SparkSession, sf: str) -> FE.FeatureSet:
    """Scaled features. The unscaled base and its statistics are stage tables; a reader imputes and
    scales the columns that it takes, which costs less than to write and read all of them again."""
    imputed, params = _imputed(spark, sf)
    return FE.FeatureSet(FE.standard_scale(imputed, list(CONTINUOUS_FEATURES), params).frame, params)


def _results(spark: SparkSession, sf: str) -> DataFrame:
    """Per-claim results, stored once per run like the serving table."""
    def build():
        scored = W.score_features(_features(spark, sf))
        return S.fraud_results(scored, RunSettings().model_version, W.CATALOGUE_RUN_TS)

    return stage(spark, sf, "fraud_results", build)


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    """Manufacturer quality: one row per manufacturer, stored, as several queries read it."""
    return stage(spark, sf, "quality", lambda: Q.manufacturer_quality(_results(spark, sf)))


# -- ingestion / enrichment ---------------------------------------------------

def q_watermark_incremental(spark, sf):
    c = apply_watermark(views.claims(spark, sf), WATERMARK)
    return c.select("claim_id", ts_text("updated_at").alias("updated_at"))


def contract_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts as ingested on two days: open orders were re-issued 60 days
    later as premium contracts, so they have two versions."""
    base = views.contracts(spark, sf)
    orders = read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O")
    reissued = base.join(
        orders.select(F.format_string("CONTRACT-%09d", F.col("o_orderkey")).alias("contract_id")), "contract_id", "left_semi"
    ).withColumns(
        {"contract_type": F.lit("premium"), "updated_at": F.col("created_at") + F.expr("INTERVAL 60 DAYS")}
    )
    return base.unionByName(reissued)


def q_latest_contract_version(spark, sf):
    latest = latest_version(contract_versions(spark, sf), "contract_id", ["updated_at"])
    return latest.select(
        "contract_id", "contract_type", day_text("start_date").alias("start_date"), ts_text("updated_at").alias("updated_at")
    )


def q_enrich_claims(spark, sf):
    e = _enriched(spark, sf)
    return e.select("claim_id", "sku", "manufacturer_id", "manufacturer_name", "product_category", "manufacturer_unknown")


def q_unknown_manufacturer_counts(spark, sf):
    return E.unknown_manufacturer_counts(_enriched(spark, sf))


def q_distinct_skus(spark, sf):
    return E.distinct_skus(views.claims(spark, sf))


def q_sku_batch_lookup(spark, sf):
    inp = _inputs(spark, sf)
    found, _ = E.sku_lookup(E.distinct_skus(inp.claims), inp.catalog)
    return found


def q_sku_not_found(spark, sf):
    inp = _inputs(spark, sf)
    _, missing = E.sku_lookup(inp.claims.select("sku"), inp.catalog)
    return missing


def q_retry_replay(spark, sf):
    """Claims with an unknown SKU were queued and replayed one day later."""
    inp = _inputs(spark, sf)
    enriched = E.enrich_claims(inp.claims, inp.catalog)
    queued = enriched.filter("manufacturer_unknown").select(*inp.claims.columns).withColumn(
        "updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAYS")
    )
    replayed = E.replay_retry(inp.claims, queued)
    return replayed.select("claim_id", "sku", ts_text("updated_at").alias("updated_at"))


# -- features -------------------------------------------------------------------

def _feature_base(spark, sf):
    """Unscaled features, without the claim columns that no feature, score or result record has."""
    enriched = lambda: _enriched(spark, sf).drop("created_at", "updated_at", "manufacturer_unknown")
    return stage(spark, sf, "feature_base", lambda: FE.feature_base(enriched(), _inputs(spark, sf).contracts))


def q_manufacturer_frequency(spark, sf):
    freq = FE.manufacturer_frequency(_enriched(spark, sf))
    return freq.select("manufacturer_id", F.col(FE.FREQUENCY).alias(FE.FREQUENCY))


def q_days_feature(spark, sf):
    return _feature_base(spark, sf).select("claim_id", F.col(FE.DAYS))


def q_one_hot(spark, sf):
    return _feature_base(spark, sf).select("claim_id", *one_hot_columns())


def _imputed(spark, sf):
    """Imputed features over the staged medians and scaler params (each computed once per input)."""
    base, cols = _feature_base(spark, sf), list(CONTINUOUS_FEATURES)
    medians = stage(spark, sf, "medians", lambda: FE.median_table(base, cols))
    imputed = FE.impute_median(base, cols, RunSettings(), medians)
    return imputed, stage(spark, sf, "scaler_params", lambda: FE.scaler_params(imputed, cols))


def q_impute_median(spark, sf):
    imputed, _ = _imputed(spark, sf)
    return imputed.select("claim_id", *[r6(c).alias(c) for c in CONTINUOUS_FEATURES])


def q_scaler_params(spark, sf):
    _, params = _imputed(spark, sf)
    rows = F.inline(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
                  for c in CONTINUOUS_FEATURES])
    )
    return params.select(rows).select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


def q_standard_scale(spark, sf):
    imputed, params = _imputed(spark, sf)
    scaled = FE.standard_scale(imputed, params=params).frame
    return scaled.select("claim_id", *[r6(c).alias(c) for c in CONTINUOUS_FEATURES])


def q_inverse_scale(spark, sf):
    imputed, params = _imputed(spark, sf)
    s = FE.standard_scale(imputed, params=params)
    back = FE.inverse_scale(s.frame, s.params)
    return back.select("claim_id", *[r6(c).alias(c) for c in CONTINUOUS_FEATURES])


def q_feature_matrix(spark, sf):
    fm = FE.feature_matrix(_features(spark, sf).frame)
    return fm.select("claim_id", *[r6(c).alias(c) for c in CONTINUOUS_FEATURES], *one_hot_columns())


# -- scoring ---------------------------------------------------------------------

def _scored(spark, sf):
    return S.normalize_scores(S.distance_score(_features(spark, sf).frame))


def q_minmax_scores(spark, sf):
    return _scored(spark, sf).select("claim_id", r6("raw_score").alias("raw_score"), r6("fraud_score").alias("fraud_score"))


def q_fraud_flags(spark, sf):
    flagged = S.flag_fraud(_scored(spark, sf))
    return flagged.select("claim_id", r6("fraud_score").alias("fraud_score"), "is_suspected_fraud")


def q_contributing_factors(spark, sf):
    f = S.contributing_factors(_features(spark, sf).frame)
    return f.select("claim_id", F.array_join("contributing_factors", ",").alias("contributing_factors"))


def _flat_results(results: DataFrame) -> DataFrame:
    return results.select(
        "claim_id", "contract_id", r6("fraud_score").alias("fraud_score"), "is_suspected_fraud",
        F.array_join("contributing_factors", ",").alias("contributing_factors"), "model_version",
        "sku", "manufacturer_name", "claim_amount", "claim_type", day_text("claim_date").alias("claim_date"),
        "product_category", "status", "description",
    )


def q_fraud_results(spark, sf):
    return _flat_results(_results(spark, sf))


def score_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Score-file lines keyed by claim, in every shape the parser accepts.

    The score text is quantity + discount/100 written out digit by digit, so
    both engines render identical text; the line shape follows the line number.
    """
    line = read_table(spark, sf, "lineitem")
    claim_id = F.concat_ws(
        "-", F.lit("CLAIM"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.date_format("l_shipdate", "yyyyMMdd"),
    )
    num = F.concat(
        F.col("l_quantity").cast("int").cast("string"), F.lit("."),
        F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0"),
    )
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, num)
        .when(n == 2, F.concat(F.lit('{"score": '), num, F.lit("}")))
        .when(n == 3, F.concat(F.lit('{"anomaly_score": '), num, F.lit("}")))
        .when(n == 4, F.lit('{"x": 1}'))
        .when(n == 5, F.concat(F.lit("bad "), num))
        .when(n == 6, F.concat(F.lit('{"score": '), num))
        .when(n == 7, F.lit('{"score": null}'))
        .otherwise(F.concat(F.lit("  "), num, F.lit(" ")))
    )
    return line.select(claim_id.alias("claim_id"), text.alias("value"))


def q_parse_score_lines(spark, sf):
    parsed = parse_score_lines(score_lines(spark, sf))
    return parsed.select("claim_id", r6("raw_score").alias("raw_score"), "parse_error")


def q_score_alignment_errors(spark, sf):
    known = _enriched(spark, sf).filter(~F.col("manufacturer_unknown"))
    parsed = parse_score_lines(score_lines(spark, sf)).filter(F.col("parse_error").isNull())
    _, errors = S.align_scores(known, parsed)
    return errors


# -- manufacturer quality ------------------------------------------------------

def q_manufacturer_quality(spark, sf):
    q = Q.manufacturer_quality(_enriched(spark, sf))
    return q.select(
        "manufacturer_id", "manufacturer_name", "total_claims", "repair_count",
        r6("repair_claim_rate").alias("repair_claim_rate"), r6("quality_score").alias("quality_score"),
        "is_quality_concern",
    )


def q_manufacturer_anomaly(spark, sf):
    q = _quality(spark, sf)
    return q.select("manufacturer_id", r6("mean_anomaly_score").alias("mean_anomaly_score"),
                    r6("anomaly_score_z").alias("anomaly_score_z"))


def _enriched(spark, sf):
    """Enriched claims: the enrichment stage's output table (K1 in a run)."""
    def build():
        return W.enriched_table(_inputs(spark, sf))

    return stage(spark, sf, "enriched", build)


def q_category_breakdown(spark, sf):
    b = Q.category_breakdown(_enriched(spark, sf))
    return b.select("manufacturer_id", "category", "claim_count", "repair_count", r6("repair_rate").alias("repair_rate"))


def q_sku_breakdown(spark, sf):
    b = Q.sku_breakdown(_enriched(spark, sf))
    return b.select("manufacturer_id", "sku", "claim_count", "repair_count", r6("repair_rate").alias("repair_rate"))


def _top(k):
    def run(spark, sf):
        t = Q.top_skus(Q.sku_breakdown(_enriched(spark, sf)), k)
        return t.select("manufacturer_id", "sku", "repair_count", F.col("sku_rank").cast("bigint").alias("sku_rank"))
    return run


def q_category_map(spark, sf):
    """A7 nested map, flattened back to rows for comparison."""
    m = Q.category_map(Q.category_breakdown(_enriched(spark, sf)))
    e = m.select("manufacturer_id", F.explode("product_category_breakdown").alias("key", "stats"))
    return e.select("manufacturer_id", "key", F.col("stats.claim_count").alias("claim_count"),
                    r6("stats.repair_rate").alias("repair_rate"))


# -- audit -----------------------------------------------------------------------

def _audit(spark, sf):
    results = _results(spark, sf)
    quality = _quality(spark, sf).withColumn("model_version", F.lit(RunSettings().model_version))
    return A.audit_entries(results, quality, W.CATALOGUE_RUN_TS)


def _flat_audit(log: DataFrame) -> DataFrame:
    return log.select(
        "event_type", "entity_type", "entity_id", "model_version", r6("score").alias("score"),
        F.array_join("details.contributing_factors", ",").alias("contributing_factors"),
        F.col("details.threshold").alias("threshold"), F.col("details.manufacturer_name").alias("manufacturer_name"),
        # double, not nullable bigint: engines disagree on how a null integer reads back
        F.col("details.total_claims").cast("double").alias("total_claims"),
        r6("details.repair_claim_rate").alias("repair_claim_rate"), ts_text("created_at").alias("created_at"),
    )


def q_audit_entries(spark, sf):
    return _flat_audit(_audit(spark, sf))


def q_audit_filter(spark, sf):
    return _flat_audit(A.filter_audit(_audit(spark, sf), entity_type="manufacturer", date_from=AUDIT_FROM, date_to=AUDIT_TO))


# -- result queries ------------------------------------------------------------

def q_results_filtered_page(spark, sf):
    r = QY.filter_results(_results(spark, sf), PAGE_FILTERS, "fraud")
    return QY.page_items(r, PAGE, PAGE_SIZE).select("claim_id", r6("fraud_score").alias("fraud_score"), "product_category")


def q_page_summary(spark, sf):
    r = QY.filter_results(_results(spark, sf), PAGE_FILTERS, "fraud")
    return QY.page_summary(r, PAGE, PAGE_SIZE)


def q_score_bounds(spark, sf):
    f = QY.score_bounds(_results(spark, sf), "fraud_score").select(F.lit("fraud").alias("kind"), "*")
    q = QY.score_bounds(_quality(spark, sf), "quality_score").select(F.lit("quality").alias("kind"), "*")
    return f.unionByName(q)


def q_claim_detail(spark, sf):
    r = _results(spark, sf)
    key = r.select(F.min("claim_id")).scalar()
    return _flat_results(r.filter(F.col("claim_id") == key))


def q_manufacturer_detail(spark, sf):
    q = _quality(spark, sf)
    key = q.select(F.max("manufacturer_id")).scalar()
    return q.filter(F.col("manufacturer_id") == key).select(
        "manufacturer_id", "manufacturer_name", "total_claims", r6("quality_score").alias("quality_score")
    )


def q_reason_text(spark, sf):
    return QY.fraud_reason_text(_results(spark, sf)).select("claim_id", "reason")


def q_quality_reason_text(spark, sf):
    results = _results(spark, sf)
    top1 = Q.top_skus(Q.sku_breakdown(results), 1)
    return QY.quality_reason_text(_quality(spark, sf), top1).select("manufacturer_id", "reason")


def q_fraud_prompts(spark, sf):
    return QY.fraud_prompts(_results(spark, sf))


def q_quality_prompts(spark, sf):
    results = _results(spark, sf)
    return QY.quality_prompts(
        _quality(spark, sf), Q.category_breakdown(results), Q.top_skus(Q.sku_breakdown(results), 10)
    )


def q_contributing_factors_compat(spark, sf):
    """O4 with the reference's double standardisation (D1, compat mode)."""
    fs = _features(spark, sf)
    f = S.contributing_factors(fs.frame, fs.params)
    return f.select("claim_id", F.array_join("contributing_factors", ",").alias("contributing_factors"))


def q_serving_extract(spark, sf):
    """O3: a top-k report, the 10,000 claims with the highest scores (results are served from the full table)."""
    top = QY.serving_extract(_results(spark, sf), SERVING_REPORT)
    return top.select("claim_id", r6("fraud_score").alias("fraud_score"), "is_suspected_fraud")


def q_quality_results(spark, sf):
    """The full quality record: its own values, every nested category and top SKU, and the
    complete breakdown, one row each."""
    results = _results(spark, sf)
    q = Q.quality_results(results, RunSettings().model_version, W.CATALOGUE_RUN_TS)
    record = q.select(
        "manufacturer_id", "manufacturer_name", "total_claims", r6("quality_score").alias("quality_score"), "is_quality_concern",
        r6("mean_anomaly_score").alias("mean_anomaly_score"), "model_version", ts_text("scored_at").alias("scored_at"),
    )
    stats = ["claim_count", "repair_count", "repair_rate"]
    nested = q.select("manufacturer_id", F.lit("nested_category").alias("kind"), F.explode("product_category_breakdown").alias("key", "v")).select(
        "manufacturer_id", "kind", "key", "v.claim_count", F.lit(None).cast("bigint").alias("repair_count"), "v.repair_rate"
    )
    top = q.select("manufacturer_id", F.lit("top_sku").alias("kind"), F.explode("top_skus").alias("key", "v")).select(
        "manufacturer_id", "kind", "key", *[f"v.{c}" for c in stats]
    )
    rows = Q.quality_breakdown(results).unionByName(nested).unionByName(top)
    return record.join(rows, "manufacturer_id").select(
        *record.columns, "kind", "key", "claim_count",
        # double, not nullable bigint: engines disagree on how a null integer reads back
        F.col("repair_count").cast("double").alias("repair_count"), r6("repair_rate").alias("repair_rate"),
    )


def q_audit_trail(spark, sf):
    """Every manufacturer with its audit entries (left join on type + id)."""
    quality = _quality(spark, sf)
    trail = A.with_audit_trail(quality, _audit(spark, sf), "manufacturer", "manufacturer_id")
    return trail.select("manufacturer_id", "event_type", r6("audited_score").alias("audited_score"))


def q_forest_scores(spark, sf):
    """M1 + M2: random cut forest trained on a hash sample, scoring every claim."""
    from ..config import feature_columns
    from ..operators.forest import sample_for_trees, score_forest, train_forest

    settings = RunSettings()
    frame = FE.feature_matrix(_features(spark, sf).frame)
    cols = feature_columns()
    sample = sample_for_trees(frame, cols, settings.num_trees, settings.num_samples_per_tree, settings.seed)
    nodes = stage(spark, sf, "forest_nodes", lambda: train_forest(sample, settings.seed))
    # raw scores are stored once: normalising needs their global min and max
    raw = stage(spark, sf, "forest_raw_scores", lambda: score_forest(frame, nodes, cols).select("claim_id", "raw_score"))
    scored = S.normalize_scores(raw)
    return S.flag_fraud(scored).select("claim_id", r6("raw_score").alias("raw_score"),
                                       r6("fraud_score").alias("fraud_score"), "is_suspected_fraud")


# A stored forest over the three scaled continuous features, to check the scorer by: fixed values.
# (tree_id, node_id, dim, cut, left, right, mass, box_min, box_max)
FIXED_FOREST = (
    (0, 0, 0, 0.5, 1, 2, 8, (-1.5, -1.0, -2.0), (2.5, 1.5, 1.0)),
    (0, 1, 1, -0.25, 3, 4, 6, (-1.5, -1.0, -2.0), (0.25, 1.5, 1.0)),
    (0, 2, -1, 0.0, -1, -1, 2, (0.75, 0.0, -0.5), (2.5, 0.75, 0.5)),
    (0, 3, -1, 0.0, -1, -1, 2, (-1.0, -1.0, -2.0), (0.0, -0.5, 0.0)),
    (0, 4, -1, 0.0, -1, -1, 4, (-1.5, 0.0, -1.0), (0.25, 1.5, 1.0)),
    (1, 0, 2, 0.0, 1, 2, 8, (-2.0, -1.5, -1.5), (1.5, 2.0, 2.0)),
    (1, 1, -1, 0.0, -1, -1, 5, (-2.0, -1.5, -1.5), (1.0, 1.0, -0.25)),
    (1, 2, 1, 0.75, 3, 4, 3, (-0.5, 0.0, 0.5), (1.5, 2.0, 2.0)),
    (1, 3, -1, 0.0, -1, -1, 1, (0.5, 0.0, 0.5), (0.5, 0.0, 0.5)),
    (1, 4, -1, 0.0, -1, -1, 2, (-0.5, 1.0, 1.0), (1.5, 2.0, 2.0)),
)


def q_forest_scores_fixed(spark, sf):
    """M2 + M4: every claim scored by a stored node table (SQL walks the same table)."""
    from ..operators.forest import NODE_SCHEMA, score_forest

    nodes = spark.createDataFrame([(*n[:7], list(n[7]), list(n[8])) for n in FIXED_FOREST], NODE_SCHEMA)
    rows = _features(spark, sf).frame.select("claim_id", *CONTINUOUS_FEATURES)
    return score_forest(rows, nodes, CONTINUOUS_FEATURES).select("claim_id", r6("raw_score").alias("raw_score"))


def q_streaming_ingest(spark, sf):
    """Claims delivered as files in two runs of a stream. The first delivery has the newer
    half; the second brings the older half late, and the first half's claims updated."""
    folder = f"{stage_root(spark)}/stream-{uuid.uuid4().hex[:12]}"  # a fresh stream checkpoint per call
    claims = views.claims(spark, sf)
    newer = F.pmod(F.xxhash64("claim_id"), F.lit(2)) == 0
    first = claims.filter(newer)
    late = claims.filter(~newer).withColumn("updated_at", F.col("updated_at") - F.expr("INTERVAL 400 DAYS"))
    updated = first.withColumns({"status": F.lit("reviewed"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAYS")})
    for delivery in (first, late.unionByName(updated)):
        delivery.write.mode("append").option("compression", "zstd").parquet(f"{folder}/source")
        ingest_available(spark, f"{folder}/source", f"{folder}/table", f"{folder}/checkpoint", schema=claims.schema, fmt="parquet")
    stored, _ = ingested_claims(spark, f"{folder}/table", claims.schema)
    latest = latest_version(stored, "claim_id", ["updated_at"])
    # the hash differs between engines: what is compared is that all rows are there, once, updated or late
    return latest.select(
        "claim_id", (F.col("status") == "reviewed").alias("is_newer"),
    ).join(claims.select("claim_id", newer.alias("was_newer")), "claim_id").select(
        "claim_id", (F.col("is_newer") == F.col("was_newer")).alias("as_delivered")
    )


# -- ingestion runs -------------------------------------------------------------

def q_claims_redelivered(spark, sf):
    """W6 on claims: every claim delivered twice, half of them with an older version, gives one
    row per claim and unchanged manufacturer counts."""
    inp = _inputs(spark, sf)
    raw = views.claims(spark, sf)
    older = raw.filter(F.col("claim_type").isNotNull()).withColumns(
        {"claim_type": F.lit("repair"), "updated_at": F.col("updated_at") - F.expr("INTERVAL 9 DAYS")}
    )
    claims = latest_version(raw.unionByName(raw).unionByName(older), "claim_id", ["updated_at"])
    rollup = Q.manufacturer_rollup(E.enrich_claims(claims, inp.catalog))
    return rollup.select("manufacturer_id", "total_claims", "repair_count")


def q_ingest_two_runs_same_day(spark, sf):
    """K1 + D4: a full load and an incremental run on the same day; nothing of the first is lost."""
    folder = f"{stage_root(spark)}/ingest-{uuid.uuid4().hex[:12]}"
    claims = views.claims(spark, sf)
    K.write_partitioned(claims, f"{folder}/claims", "2025-01-01", "run1")
    later = apply_watermark(claims, WATERMARK).withColumns(
        {"status": F.lit("reviewed"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAYS")}
    )
    K.write_partitioned(later, f"{folder}/claims", "2025-01-01", "run2")
    stored = spark.read.schema(claims.schema).parquet(f"{folder}/claims")
    return latest_version(stored, "claim_id", ["updated_at"]).select("claim_id", "status", ts_text("updated_at").alias("updated_at"))


# -- results from score files, run summary ----------------------------------------

def _file_results(spark, sf):
    """(results, errors) from score files written and read back as text."""
    def build():
        lines = score_lines(spark, sf).select(F.concat_ws(",", "claim_id", F.trim("value")).alias("value"))
        folder = f"{stage_root(spark)}/score-files-{uuid.uuid4().hex[:12]}"
        lines.write.option("compression", "gzip").text(folder)
        return parse_score_lines(key_score_lines(read_score_lines(spark, folder))).select("claim_id", "raw_score", "parse_error")

    parsed = stage(spark, sf, "score_file_lines", build)
    settings = replace(RunSettings(), model_version="scores")
    return S.results_from_scores(_features(spark, sf).frame, parsed, settings, W.CATALOGUE_RUN_TS)


def q_results_from_score_files(spark, sf):
    """S5 + J4 + J5 + P10: the result record of every claim whose score line is good."""
    return _flat_results(_file_results(spark, sf)[0])


def q_score_file_errors(spark, sf):
    """Every line or claim without a partner, and every bad line, by name."""
    return _file_results(spark, sf)[1].groupBy("error").agg(F.count(F.lit(1)).alias("lines"))


def q_run_summary(spark, sf):
    """Counters and status of one published batch run."""
    from .runner import run_batch, run_folder

    folder = run_folder(spark)
    run = run_batch(spark, _inputs(spark, sf), run_ts=W.CATALOGUE_RUN_TS, folder=f"{folder}/run", publish_dir=f"{folder}/published")
    names = ["enriched_rows", "unknown_manufacturer", "fraud_results_rows", "flagged", "quality_results_rows", "concerns",
             "published_results", "published_quality", "audit_appended", "quality_breakdown_rows"]
    return run.summary(spark).filter(F.col("counter").isin(*names))


# -- sorted and filtered results ---------------------------------------------------

def q_results_sorted_by_manufacturer(spark, sf):
    """O1 on a text column, missing values last, then the next page by keyset."""
    r = _results(spark, sf).select("claim_id", "fraud_score", "manufacturer_name")
    first = QY.page_items(r, 1, PAGE_SIZE, sort_by="manufacturer_name", descending=False)
    last = first.orderBy(F.desc("manufacturer_name"), F.desc("claim_id")).limit(1).collect()
    if not last:
        return first
    after = QY.page_after(r, last[0].manufacturer_name, last[0].claim_id, PAGE_SIZE, sort_by="manufacturer_name", descending=False)
    return first.unionByName(after).select("claim_id", "manufacturer_name")


def q_results_by_date_and_manufacturer(spark, sf):
    """F3 + F4: results of one manufacturer scored on one day, sorted by claim date."""
    r = _results(spark, sf)
    name = r.select(F.min("manufacturer_name")).first()[0]
    kept = QY.filter_results(r, QY.ResultFilters(date_from="2025-01-01", date_to="2025-01-01", manufacturer=name))
    none = QY.filter_results(r, QY.ResultFilters(date_from="2025-01-02", manufacturer=name))
    rows = kept.unionByName(none)
    return QY.sort_results(rows, sort_by="claim_date").select("claim_id", "manufacturer_name", day_text("claim_date").alias("claim_date"))


def q_quality_by_category(spark, sf):
    """F5 on quality records: manufacturers whose breakdown has a category."""
    q = Q.quality_results(_results(spark, sf), RunSettings().model_version, W.CATALOGUE_RUN_TS)
    kept = QY.filter_results(q, QY.ResultFilters(category="unknown", score_min=0.0), "quality")
    return kept.select("manufacturer_id", r6("quality_score").alias("quality_score"))


def q_sku_ranking(spark, sf):
    """The full ranking of a manufacturer's SKUs by repairs."""
    full = Q.top_skus(Q.sku_breakdown(_enriched(spark, sf)), None)
    return full.select("manufacturer_id", "sku", "claim_count", "repair_count")


def q_export_rows(spark, sf):
    r = _results(spark, sf).select("claim_id", "fraud_score", "contributing_factors")
    out = QY.export_rows(r, limit=None)
    return out.select("claim_id", r6("fraud_score").alias("fraud_score"), "contributing_factors")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "watermark_incremental": q_watermark_incremental,
    "latest_contract_version": q_latest_contract_version,
    "enrich_claims": q_enrich_claims,
    "unknown_manufacturer_counts": q_unknown_manufacturer_counts,
    "distinct_skus": q_distinct_skus,
    "sku_batch_lookup": q_sku_batch_lookup,
    "sku_not_found": q_sku_not_found,
    "retry_replay": q_retry_replay,
    "manufacturer_frequency": q_manufacturer_frequency,
    "days_feature": q_days_feature,
    "one_hot": q_one_hot,
    "impute_median": q_impute_median,
    "scaler_params": q_scaler_params,
    "standard_scale": q_standard_scale,
    "inverse_scale": q_inverse_scale,
    "feature_matrix": q_feature_matrix,
    "minmax_scores": q_minmax_scores,
    "fraud_flags": q_fraud_flags,
    "contributing_factors": q_contributing_factors,
    "fraud_results": q_fraud_results,
    "parse_score_lines": q_parse_score_lines,
    "score_alignment_errors": q_score_alignment_errors,
    "manufacturer_quality": q_manufacturer_quality,
    "manufacturer_anomaly": q_manufacturer_anomaly,
    "category_breakdown": q_category_breakdown,
    "category_map": q_category_map,
    "sku_breakdown": q_sku_breakdown,
    "top_skus_by_repairs_3": _top(3),
    "top_skus_by_repairs_10": _top(10),
    "audit_entries": q_audit_entries,
    "audit_filter": q_audit_filter,
    "results_filtered_page": q_results_filtered_page,
    "page_summary": q_page_summary,
    "score_bounds": q_score_bounds,
    "claim_detail": q_claim_detail,
    "manufacturer_detail": q_manufacturer_detail,
    "reason_text": q_reason_text,
    "quality_reason_text": q_quality_reason_text,
    "fraud_prompts": q_fraud_prompts,
    "quality_prompts": q_quality_prompts,
    "export_rows": q_export_rows,
    "contributing_factors_compat": q_contributing_factors_compat,
    "serving_extract": q_serving_extract,
    "quality_results": q_quality_results,
    "audit_trail": q_audit_trail,
    "forest_scores": q_forest_scores,
    "forest_scores_fixed": q_forest_scores_fixed,
    "streaming_ingest": q_streaming_ingest,
    "claims_redelivered": q_claims_redelivered,
    "ingest_two_runs_same_day": q_ingest_two_runs_same_day,
    "results_from_score_files": q_results_from_score_files,
    "score_file_errors": q_score_file_errors,
    "run_summary": q_run_summary,
    "results_sorted_by_manufacturer": q_results_sorted_by_manufacturer,
    "results_by_date_and_manufacturer": q_results_by_date_and_manufacturer,
    "quality_by_category": q_quality_by_category,
    "sku_ranking": q_sku_ranking,
}
