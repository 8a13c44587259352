import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from claimlens.schemas import AUDIT_ENTRY
from claimlens.sinks import writers as K


def _tmp():
    return tempfile.mkdtemp(prefix="claimlens-sink-")


def test_partitioned_overwrite_keeps_other_days(spark):
    base = os.path.join(_tmp(), "claims")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "claim_id string, v int")
    assert K.write_partitioned(df, base, "2024-01-01")["rows"] == 2
    K.write_partitioned(df.limit(1), base, "2024-01-02")
    K.write_partitioned(df.limit(1), base, "2024-01-01")  # rewrite one day only
    counts = {r.dt: r["count"] for r in spark.read.parquet(base).groupBy(F.col("dt").cast("string").alias("dt")).count().collect()}
    assert counts == {"2024-01-01": 1, "2024-01-02": 1}


def test_same_day_runs_add_up_and_a_repeated_run_replaces_itself(spark):
    base = os.path.join(_tmp(), "claims")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "claim_id string, v int")
    K.write_partitioned(df, base, "2024-01-01", "run1")
    K.write_partitioned(df.limit(1), base, "2024-01-01", "run2")
    K.write_partitioned(df, base, "2024-01-01", "run1")
    assert spark.read.parquet(base).count() == 3


def test_retry_queue_takes_each_claim_version_once(spark):
    path = os.path.join(_tmp(), "retry")
    rows = [("a", dt.datetime(2025, 1, 1)), ("b", None)]
    df = spark.createDataFrame(rows, "claim_id string, updated_at timestamp")
    assert K.append_retry(df.limit(0), path) == 0
    assert K.append_retry(df, path) == 2 and K.append_retry(df, path) == 0
    newer = spark.createDataFrame([("a", dt.datetime(2025, 1, 2))], "claim_id string, updated_at timestamp")
    assert K.append_retry(newer.unionByName(df), path) == 1
    assert spark.read.parquet(path).count() == 3
    K.clear_retry(spark, path)
    assert K.append_retry(df, path) == 2


def test_unreadable_log_is_an_error_not_an_empty_log(spark):
    import pytest

    path = os.path.join(_tmp(), "audit")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as fh:
        fh.write("not parquet at all")
    row = ("fraud_flag", "claim", "C1", "v1", 0.9, (["claim_amount"], 0.7, None, None, None), dt.datetime(2025, 1, 1))
    with pytest.raises(Exception):
        K.append_audit(spark, spark.createDataFrame([row], AUDIT_ENTRY), path)
    assert os.listdir(path) == ["part-0.parquet"]


def test_serving_extract_needs_its_n(spark):
    import pytest

    df = spark.createDataFrame([("C1", 0.9, True)], "claim_id string, fraud_score double, is_suspected_fraud boolean")
    with pytest.raises(ValueError):
        K.write_fraud_results(df, os.path.join(_tmp(), "json"), os.path.join(_tmp(), "serving"))


def test_newest_model_or_an_error(spark):
    import pytest

    from claimlens.sources.files import latest_model

    folder = _tmp()
    with pytest.raises(FileNotFoundError):
        latest_model(spark, folder)
    for name, month in (("m1", 3), ("m2", 2)):
        K.write_manifest(spark, os.path.join(folder, name, "manifest"), f"job-{name}", f"{folder}/{name}/nodes", 1.0, 10, 100, 256, 12,
                         dt.datetime(2025, month, 1, tzinfo=dt.timezone.utc))
    assert latest_model(spark, folder) == (f"{folder}/m1/nodes", "job-m1")


def test_training_csv_has_no_header_or_id(spark):
    path = os.path.join(_tmp(), "train")
    df = spark.createDataFrame([("c1", 1.0, 2.0), ("c2", 3.0, 4.0), ("c3", 5.0, 6.0)], "claim_id string, a double, b double")
    assert K.write_training_csv(df, path) == 3
    lines = sorted(l for f in os.listdir(path) if f.endswith(".csv") for l in open(os.path.join(path, f)).read().splitlines())
    assert lines == ["1.0,2.0", "3.0,4.0", "5.0,6.0"]


def test_audit_append_is_idempotent(spark):
    path = os.path.join(_tmp(), "audit")
    row = ("fraud_flag", "claim", "C1", "v1", 0.9, (["claim_amount"], 0.7, None, None, None), dt.datetime(2025, 1, 1))
    entries = spark.createDataFrame([row], AUDIT_ENTRY)
    assert K.append_audit(spark, entries, path) == 1
    assert K.append_audit(spark, entries, path) == 0
    assert spark.read.parquet(path).count() == 1


def test_export_csv_and_results_json(spark):
    folder = _tmp()
    df = spark.createDataFrame([("C1", 0.9, True, ["a", "b"])],
                               "claim_id string, fraud_score double, is_suspected_fraud boolean, contributing_factors array<string>")
    assert K.export_csv(df, os.path.join(folder, "csv")) == 1
    back = spark.read.option("header", True).option("escape", '"').csv(os.path.join(folder, "csv")).collect()[0]
    assert json.loads(back.contributing_factors) == ["a", "b"]
    assert K.write_fraud_results(df, os.path.join(folder, "json"), os.path.join(folder, "serving"), 10) == 1
    assert spark.read.json(os.path.join(folder, "serving")).count() == 1


def test_manifest_and_latest_model(spark):
    from claimlens.sources.files import latest_manifest, read_json_records
    from claimlens.schemas import MODEL_MANIFEST

    folder = _tmp()
    K.write_manifest(spark, os.path.join(folder, "m1"), "job1", "models/m1/model", 1.0, 10, 100, 256, 12,
                     dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc))
    K.write_manifest(spark, os.path.join(folder, "m2"), "job2", "models/m2/model", 1.0, 10, 100, 256, 12,
                     dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc))
    manifests = read_json_records(spark, os.path.join(folder, "*"), MODEL_MANIFEST)
    assert latest_manifest(manifests).collect()[0].model_artifact_s3_path == "models/m2/model"
    missing = read_json_records(spark, os.path.join(folder, "nope"), MODEL_MANIFEST)
    assert missing.count() == 0


def test_feature_metadata_round_trip(spark):
    import pytest

    from claimlens.operators.features import feature_metadata
    from claimlens.sources.files import feature_dim

    folder = _tmp()
    K.write_json_document(feature_metadata(spark, "params.json", "2025-01-01T00:00:00"), os.path.join(folder, "meta"))
    assert feature_dim(spark, os.path.join(folder, "meta")) == 12
    with pytest.raises(FileNotFoundError):
        feature_dim(spark, os.path.join(folder, "missing"))


def test_results_json_reload_and_query(spark):
    """Results written as JSON lines or one JSON array load with the schema and answer queries."""
    from claimlens.operators import query as QY
    from claimlens.schemas import FRAUD_RESULT
    from claimlens.sources.files import read_json_records

    folder = _tmp()
    rows = [
        ("CLAIM-00001", "CONTRACT-1", 0.85, True, ["claim_amount"], "v1", dt.datetime(2025, 1, 2), "SKU-1", "Acme Corp",
         100.0, "repair", dt.date(2024, 6, 15), "electronics", "open", "x"),
        ("CLAIM-00002", "CONTRACT-2", 0.45, False, ["claim_type_repair"], "v1", dt.datetime(2025, 1, 2), "SKU-2", "Beta Inc",
         200.0, "refund", dt.date(2024, 7, 20), "appliances", "closed", "y"),
    ]
    df = spark.createDataFrame(rows, FRAUD_RESULT)
    K.write_fraud_results(df, os.path.join(folder, "lines"))
    back = read_json_records(spark, os.path.join(folder, "lines"), FRAUD_RESULT)
    assert back.count() == 2
    assert [r.claim_id for r in QY.page_items(back, 1, 1).collect()] == ["CLAIM-00001"]
    array_file = os.path.join(folder, "array.json")
    with open(array_file, "w") as fh:
        json.dump([{"claim_id": "CLAIM-9", "fraud_score": 0.1, "contributing_factors": []}], fh)
    arr = read_json_records(spark, array_file, FRAUD_RESULT, multi_line=True)
    assert [(r.claim_id, r.fraud_score) for r in arr.collect()] == [("CLAIM-9", 0.1)]
    assert read_json_records(spark, os.path.join(folder, "absent"), FRAUD_RESULT).count() == 0


def test_quality_json_and_parquet_writers(spark):
    folder = _tmp()
    q = spark.createDataFrame([("M1", 2.5, True), ("M2", 0.1, False)],
                              "manufacturer_id string, quality_score double, is_quality_concern boolean")
    assert K.write_quality_results(q, os.path.join(folder, "quality")) == 2
    assert spark.read.json(os.path.join(folder, "quality")).filter("is_quality_concern").count() == 1
    assert K.write_parquet(q, os.path.join(folder, "pq")) == 2


def test_audit_append_compares_null_versions_and_ids(spark):
    import tempfile

    from claimlens.schemas import AUDIT_ENTRY
    from claimlens.sinks.writers import append_audit

    names = AUDIT_ENTRY.fieldNames()
    entry = lambda entity, version: tuple({"event_type": "fraud_flag", "entity_type": "claim", "entity_id": entity, "model_version": version}.get(c) for c in names)
    rows = [entry("A", "v1"), entry("A", None), entry(None, "v1"), entry(None, None)]
    path = tempfile.mkdtemp(prefix="audit-") + "/log"
    assert append_audit(spark, spark.createDataFrame(rows, AUDIT_ENTRY), path) == 4
    assert append_audit(spark, spark.createDataFrame(rows, AUDIT_ENTRY), path) == 0
    assert append_audit(spark, spark.createDataFrame([*rows, entry("B", None)], AUDIT_ENTRY), path) == 1
    assert spark.read.parquet(path).count() == 5


def test_result_files_are_gzipped_and_read_back(spark):
    from claimlens.schemas import FRAUD_RESULT
    from claimlens.sources.files import read_json_records

    folder = _tmp()
    df = spark.range(2000).selectExpr("concat('C', id) AS claim_id", "'K1' AS contract_id", "id / 2000 AS fraud_score", "id > 1990 AS is_suspected_fraud", "array('a', 'b') AS contributing_factors")
    assert K.write_fraud_results(df, os.path.join(folder, "lines"), os.path.join(folder, "top"), 10) == 2000
    for name, n in (("lines", 2000), ("top", 10)):
        parts = [f for f in os.listdir(os.path.join(folder, name)) if f.startswith("part-")]
        assert parts and all(f.endswith(".json.gz") for f in parts)
        assert read_json_records(spark, os.path.join(folder, name), FRAUD_RESULT).select("claim_id").distinct().count() == n
