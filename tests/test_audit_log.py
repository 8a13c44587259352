import os
import tempfile

from claimlens.schemas import AUDIT_ENTRY
from claimlens.sinks.audit_log import AuditLog

NAMES = AUDIT_ENTRY.fieldNames()


def entry(entity, version="v1", score=1.0, kind="fraud_flag"):
    return tuple({"event_type": kind, "entity_type": "claim", "entity_id": entity, "model_version": version, "score": score}.get(c) for c in NAMES)


def log(spark, buckets=8):
    return AuditLog(spark, tempfile.mkdtemp(prefix="audit-"), buckets)


def files(a):
    return {os.path.join(d, f) for d, _, names in os.walk(a.path) for f in names if f.endswith(".parquet")}


def test_appends_are_idempotent_nulls_included(spark):
    a = log(spark)
    rows = spark.createDataFrame([entry("A"), entry("A"), entry("A", None), entry(None), entry(None, None), entry("A", kind="x")], AUDIT_ENTRY)
    assert a.append(rows) == 5
    before = files(a)
    assert a.append(rows) == 0 and files(a) == before
    assert a.append(spark.createDataFrame([entry("B", None), entry("A")], AUDIT_ENTRY)) == 1
    assert a.read().count() == 6 and a.entries_of("claim", None).count() == 2 and a.entries_of("claim", "A").count() == 3


def test_few_entries_touch_few_buckets(spark):
    a = log(spark, 16)
    a.append(spark.createDataFrame([entry(f"E{i}") for i in range(400)], AUDIT_ENTRY))
    before = files(a)
    assert len({os.path.dirname(f) for f in before}) == 16
    assert a.append(spark.createDataFrame([entry("E7"), entry("E7", "v2")], AUDIT_ENTRY)) == 1
    assert len({os.path.dirname(f) for f in files(a) - before}) == 1
    assert len({os.path.dirname(f) for f in a.entries_of("claim", "E7").inputFiles()}) == 1
    assert a.entries_of("claim", "E7").count() == 2 and a.entries_of("claim", "nobody").count() == 0


def test_empty_log_and_no_entries(spark):
    a = log(spark)
    assert a.read().count() == 0 and a.append(spark.createDataFrame([], AUDIT_ENTRY)) == 0 and a.entries_of(None, "A").count() == 0
