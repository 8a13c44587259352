"""Ingestion and enrichment stages over CSV extracts derived from the test tables."""

import os
import tempfile

from pyspark.sql import functions as F

from claimlens.plans.runner import enrich_stage, ingest_stage
from claimlens.sources import warranty_views as views


def _write_csv(df, path):
    out = df
    for name, dtype in df.dtypes:
        if dtype == "timestamp":
            out = out.withColumn(name, F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"))
    out.write.mode("overwrite").option("header", True).csv(path)


def test_ingest_then_enrich(spark, sf_small):
    root = tempfile.mkdtemp(prefix="claimlens-stage-")
    raw, ing, enr, retry = (os.path.join(root, d) for d in ("raw", "ingested", "enriched", "retry"))
    claims = views.claims(spark, sf_small)
    _write_csv(views.contracts(spark, sf_small), f"{raw}/contracts")
    _write_csv(claims, f"{raw}/claims")
    _write_csv(views.sku_catalog(spark, sf_small), f"{raw}/sku_catalog")
    summary = ingest_stage(spark, raw, ing, "2025-01-01")
    assert summary["claims"]["rows"] == claims.count() and summary["claims"]["status"] == "success"
    # a later incremental run only keeps rows at or after the watermark
    later = ingest_stage(spark, raw, os.path.join(root, "ingested2"), "2025-01-02", since="2000-01-01T00:00:00Z")
    assert later["claims"]["rows"] == claims.filter(F.col("updated_at") >= F.lit("2000-01-01").cast("timestamp")).count()
    out = enrich_stage(spark, ing, enr, retry, "2025-01-01")
    assert out["rows"] == claims.count() and out["unknown_manufacturer"] > 0
    enriched = spark.read.parquet(enr)
    assert enriched.select("claim_id").distinct().count() == claims.count()
    # a second run on the same day keeps the first, and there is one current enriched table
    again = ingest_stage(spark, raw, ing, "2025-01-01", since="2000-01-01T00:00:00Z")
    assert 0 < again["claims"]["rows"] < claims.count()
    assert enrich_stage(spark, ing, enr, retry, "2025-01-02")["rows"] == claims.count()
    assert spark.read.parquet(enr).count() == claims.count()


def test_quarantine_and_retry_queue(spark):
    root = tempfile.mkdtemp(prefix="claimlens-stage-")
    raw, ing, enr, retry = (os.path.join(root, d) for d in ("raw", "ingested", "enriched", "retry"))
    for d in ("contracts", "claims", "sku_catalog"):
        os.makedirs(f"{raw}/{d}")
    with open(f"{raw}/contracts/a.csv", "w") as fh:
        fh.write("contract_id,customer_id,sku,start_date,end_date,contract_type,created_at,updated_at\n")
    with open(f"{raw}/claims/a.csv", "w") as fh:
        fh.write("claim_id,contract_id,sku,claim_date,claim_type,claim_amount,status,description,created_at,updated_at\n")
        fh.write("C1,K1,S1,2024-01-10,repair,1.0,open,x,2024-01-10T00:00:00,2024-01-10T00:00:00\n")
        fh.write("C2,K1,S1,2024-01-10,repair,lots,open,x,2024-01-10T00:00:00,2024-01-10T00:00:00\n")
        fh.write(",K1,S1,2024-01-10,repair,3.0,open,x,2024-01-10T00:00:00,2024-01-10T00:00:00\n")
        fh.write(",K1,S1,2024-01-10,repair,4.0,open,x,2024-01-10T00:00:00,2024-01-10T00:00:00\n")
    with open(f"{raw}/sku_catalog/a.csv", "w") as fh:
        fh.write("sku,manufacturer_id,manufacturer_name,product_category,product_name\nS1,M1,Acme,electronics,p\n")
    got = ingest_stage(spark, raw, ing, "2025-01-01")["claims"]
    assert (got["rows"], got["corrupt"], got["null_key"], got["status"]) == (1, 1, 2, "partial_failure")
    bad = spark.read.parquet(f"{ing}_quarantine/claims/corrupt").collect()
    assert len(bad) == 1 and "lots" in bad[0].record
    assert spark.read.parquet(f"{ing}_quarantine/claims/null_key").count() == 2
    # no catalog: the claims are queued once, however often the stage runs
    lone = f"{root}/lone"
    spark.read.parquet(f"{ing}/claims").write.partitionBy("dt", "run_id").parquet(f"{lone}/claims")
    assert enrich_stage(spark, lone, enr, retry, "2025-01-01")["queued"] == 1
    assert enrich_stage(spark, lone, enr, retry, "2025-01-01")["queued"] == 0
    # the catalog is back: queued claims are replayed, kept with the ingested ones, and the queue is empty
    out = enrich_stage(spark, ing, enr, retry, "2025-01-02")
    assert (out["rows"], out["replayed"], out["status"]) == (1, 1, "success") and not os.path.exists(retry)
    assert spark.read.parquet(enr).first().manufacturer_id == "M1"


def test_score_files_and_published_run(spark, sf_small):
    from claimlens.plans import warranty as W
    from claimlens.plans.runner import run_batch

    root = tempfile.mkdtemp(prefix="claimlens-run-")
    inputs = W.view_inputs(spark, sf_small)
    n = inputs.claims.count()
    scores = inputs.claims.select(F.concat_ws(",", "claim_id", F.length("description").cast("string")).alias("value"))
    scores.union(spark.createDataFrame([("C-none,0.5",), ("bad line",), ("C-x,NaN",)], "value string")).write.text(f"{root}/scores")
    run = run_batch(spark, inputs, folder=f"{root}/run1", scorer="files", score_lines=f"{root}/scores", publish_dir=f"{root}/published")
    assert run.counters["fraud_results_rows"] == n and run.counters["score_errors_rows"] == 3
    assert run.status == "partial_failure" and run.model_version == "scores"
    first = run.counters["audit_appended"]
    # the same run again adds nothing to the log; another scorer's entries are its own
    again = run_batch(spark, inputs, folder=f"{root}/run2", scorer="files", score_lines=f"{root}/scores", publish_dir=f"{root}/published")
    assert first > 0 and again.counters["audit_appended"] == 0
    other = run_batch(spark, inputs, folder=f"{root}/run3", publish_dir=f"{root}/published",
                      enriched=spark.read.parquet(run.tables["enriched"]))
    assert other.counters["audit_appended"] > 0 and "enriched" not in other.tables
    versions = {r.model_version for r in spark.read.parquet(f"{root}/published/audit_log").select("model_version").distinct().collect()}
    assert versions == {"scores", "distance-v1"}
    assert spark.read.json(f"{root}/published/fraud_results").count() == n
    counters = {r.counter: r.value for r in other.summary(spark).collect()}
    assert counters["fraud_results_rows"] == n and counters["audit_appended"] == other.counters["audit_appended"]


def test_batch_run_with_forest(spark, sf_small):
    from claimlens.config import RunSettings
    from claimlens.plans import warranty as W
    from claimlens.plans.runner import run_batch

    folder = tempfile.mkdtemp(prefix="claimlens-run-")
    run = run_batch(spark, W.view_inputs(spark, sf_small), RunSettings(num_trees=10, num_samples_per_tree=32),
                    folder=os.path.join(folder, "run"), scorer="forest")
    results = spark.read.parquet(run.tables["fraud_results"])
    assert results.count() == views.claims(spark, sf_small).count()
    assert results.agg(F.min("fraud_score"), F.max("fraud_score")).first() == (0.0, 1.0)
    manifest = spark.read.json(os.path.join(run.folder, "model", "manifest")).first()
    assert manifest.record_count == 320 and manifest.hyperparameters.num_trees == 10
    meta = spark.read.json(os.path.join(run.folder, "feature_metadata")).first()
    assert meta.feature_dim == 12
    assert spark.read.parquet(run.tables["audit_log"]).filter("event_type = 'fraud_flag'").count() == results.filter(
        "is_suspected_fraud").count()
    # results and audit entries carry the forest's version, and the newest forest can be reused
    assert {r.model_version for r in results.select("model_version").distinct().collect()} == {manifest.job_name}
    reused = run_batch(spark, W.view_inputs(spark, sf_small), RunSettings(num_trees=10, num_samples_per_tree=32),
                       folder=os.path.join(folder, "run2"), scorer="forest", models_dir=run.folder, reuse_model=True)
    same = spark.read.parquet(reused.tables["fraud_results"]).select("claim_id", "fraud_score")
    assert same.exceptAll(results.select("claim_id", "fraud_score")).count() == 0 and reused.model_version == run.model_version


def test_view_numbers_equal_the_formatter(spark):
    from pyspark.sql import functions as F

    from claimlens.sources.warranty_views import _numbered

    rows = spark.createDataFrame([(n,) for n in (None, 0, 7, 99999, 100000, -3, 2**40)], "n bigint")
    got = rows.select(_numbered("SKU-", F.col("n"), 5).alias("a"), F.format_string("SKU-%05d", F.col("n")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_scaled_features_are_not_stored(spark, sf_small):
    from claimlens.plans import catalogue as C

    frame = C._features(spark, sf_small).frame
    assert any("feature_base-" in f for f in frame.inputFiles()) and not any("/features-" in f for f in frame.inputFiles())


def test_score_files_are_compressed(spark, sf_small):
    from claimlens.plans import catalogue as C
    from claimlens.plans.stages import forget, stage_root
    from claimlens.sources.storage import file_names

    forget(spark)
    C._file_results(spark, sf_small)
    folders = [n for n in file_names(spark, stage_root(spark)) if n.startswith("score-files-")]
    newest = [n for f in folders for n in file_names(spark, f"{stage_root(spark)}/{f}") if n.startswith("part-")]
    assert newest and all(n.endswith(".txt.gz") for n in newest)
