"""Tables that follow deltas: upsert by bucket, signed rollups, late rows, restarts."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from claimlens.operators import rollup as R
from claimlens.operators.ingest import latest_version
from claimlens.sinks.buckets import BucketTable

SCHEMA = "claim_id string, sku string, claim_type string, claim_amount double, updated_at timestamp"


def at(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def frame(spark, rows):
    return spark.createDataFrame([(k, s, t, a, None if d is None else at(d)) for k, s, t, a, d in rows], SCHEMA)


def some_rows(rng, n, keys):
    kinds = ["repair", "refund", None]
    return [(f"C{rng.randrange(keys)}", f"S{rng.randrange(6)}", rng.choice(kinds), rng.choice([1.0, 2.5, None]), rng.choice([None, *range(9)])) for _ in range(n)]


def table(spark, buckets=8):
    path = tempfile.mkdtemp(prefix="buckets-")
    return BucketTable(spark, path, frame(spark, []).schema, "claim_id", ["updated_at"], buckets)


def files(t):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{t.path}/data") for f in names if f.endswith(".parquet")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_deltas_in_any_order_give_the_full_recomputation(spark):
    rng = random.Random(1)
    deltas = [some_rows(rng, 60, 40) for _ in range(3)]
    every = frame(spark, [r for d in deltas for r in d])
    want = rows_of(latest_version(every, "claim_id", ["updated_at"]))
    for order in ((0, 1, 2), (2, 0, 1), (0, 0, 2, 1)):
        t = table(spark)
        for i in order:
            t.upsert(frame(spark, deltas[i]))
        assert rows_of(t.current()) == want


def test_only_touched_buckets_are_read_and_written(spark):
    t = table(spark, buckets=16)
    base = frame(spark, [(f"C{i}", "S1", "repair", 1.0, 1) for i in range(300)])
    t.upsert(base)
    before, held = files(t), t.manifest()[1]
    assert set(held) == set(range(16))
    one = base.filter(t.bucket_of(F.col("claim_id")) == 5)
    commit = t.upsert(one.withColumn("updated_at", F.lit(at(3))))
    assert commit.buckets == [5] and commit.changes.count() == one.count()
    assert all("bucket=5" in f for f in files(t) - before) and before <= files(t)
    assert {b for b, c in t.manifest()[1].items() if c != held[b]} == {5}
    read = t.current([5]).inputFiles()
    assert read and all("commit=2/bucket=5" in f for f in read)
    found = t.lookup("C17")
    assert found.count() == 1 and len({os.path.dirname(f) for f in found.inputFiles()}) == 1


def test_repeats_change_nothing_and_late_rows_are_told(spark):
    t = table(spark)
    rows = frame(spark, [("A", "S1", "repair", 1.0, 5), ("B", "S1", None, None, None)])
    t.upsert(rows)
    before = files(t)
    again = t.upsert(rows.unionByName(frame(spark, [("A", "S9", "refund", 9.0, 2)])))
    assert again.buckets == [] and again.changes.count() == 0 and files(t) == before
    late = t.upsert(frame(spark, [("A", "S9", "refund", 9.0, 2)]))
    assert [r.sku for r in late.late.collect()] == ["S9"] and files(t) == before
    tie = t.upsert(frame(spark, [("A", "S2", "repair", 1.0, 5)]))  # same time: the other columns decide, as in latest_version
    assert [(r.old.sku, r.new.sku) for r in tie.changes.collect()] == [("S1", "S2")]


def test_refused_and_empty_input(spark):
    t = table(spark)
    assert t.current().count() == 0 and t.upsert(frame(spark, [])).buckets == [] and t.lookup("x").count() == 0
    with pytest.raises(ValueError, match="without claim_id"):
        t.upsert(frame(spark, [(None, "S", None, None, 1)]))
    t.upsert(frame(spark, [("A", "S", None, None, 1)]))
    with pytest.raises(ValueError, match="laid out"):
        BucketTable(spark, t.path, t.schema, "claim_id", ["updated_at"], 9).current()


def test_a_commit_without_manifest_is_not_seen(spark):
    t = table(spark)
    t.upsert(frame(spark, [("A", "S1", "repair", 1.0, 1)]))
    os.makedirs(f"{t.path}/data/commit=2/bucket=0")  # an attempt that failed after writing
    frame(spark, [("A", "S9", "refund", 1.0, 9)]).write.mode("overwrite").parquet(f"{t.path}/data/commit=2/bucket=0")
    assert [r.sku for r in t.current().collect()] == ["S1"]
    t.upsert(frame(spark, [("A", "S3", "repair", 1.0, 2)]))
    assert [r.sku for r in t.current().collect()] == ["S3"]


def test_merged_rollups_equal_the_full_one(spark):
    catalog = spark.createDataFrame(
        [("S0", "M1", "one", "toys"), ("S1", "M1", "one", None), ("S2", "M2", "two", "toys"), ("S3", "", "none", "toys"), ("S4", "M2", "two", "toys")],
        "sku string, manufacturer_id string, manufacturer_name string, product_category string",
    )
    rng, t, parts = random.Random(3), table(spark), []
    for n in (80, 40, 40):
        delta = frame(spark, some_rows(rng, n, 50))
        for _ in range(2):  # every delta comes twice
            parts.append(R.rollup_delta(t.upsert(delta).changes, catalog))
    merged = R.merge_rollups(*parts)
    whole = t.current().select(F.lit(None).cast(t.schema).alias("old"), F.struct(*t.schema.fieldNames()).alias("new"))
    assert rows_of(merged) == rows_of(R.merge_rollups(R.rollup_delta(whole, catalog)))
    assert rows_of(R.merge_rollups(R.merge_rollups(*parts[:3]), R.merge_rollups(*parts[3:]))) == rows_of(merged)
    plain = {}
    for r in t.current().collect():
        owner = {"S0": "M1", "S1": "M1", "S2": "M2", "S4": "M2"}.get(r.sku)
        if owner:
            n, repairs = plain.get(owner, (0, 0))
            plain[owner] = (n + 1, repairs + (r.claim_type == "repair"))
    got = {r.manufacturer_id: (r.total_claims, r.repair_count) for r in R.rollup_by(merged, "manufacturer_id").collect()}
    assert got == plain


def test_retracted_groups_go(spark):
    catalog = spark.createDataFrame([("S0", "M1", "one", "toys"), ("S1", "M2", "two", "toys")], "sku string, manufacturer_id string, manufacturer_name string, product_category string")
    t = table(spark)
    first = R.rollup_delta(t.upsert(frame(spark, [("A", "S0", "repair", 1.0, 1)])).changes, catalog)
    moved = R.rollup_delta(t.upsert(frame(spark, [("A", "S1", "refund", 1.0, 2)])).changes, catalog)
    assert rows_of(R.merge_rollups(first, moved).select("manufacturer_id", "claims", "repairs")) == [("M2", 1, 0)]


def test_latest_version_takes_one_exchange_of_the_rows(spark):
    df = frame(spark, some_rows(random.Random(2), 50, 10))
    plan = latest_version(df, "claim_id", ["updated_at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan and "Join" not in plan


def test_a_first_load_is_staged_once_and_large_buckets_are_several_files(spark, monkeypatch):
    from claimlens.sinks import buckets as B

    t = table(spark)
    rows = some_rows(random.Random(4), 300, 200)
    commit = t.upsert(frame(spark, rows))
    staged = [f for f in os.listdir(f"{t.path}/staged")]
    assert len(staged) == 1 and os.listdir(f"{t.path}/staged/{staged[0]}") == ["newest"]  # no second copy beside it
    assert commit.late.count() == 0 and commit.changes.filter("old is not null").count() == 0
    assert rows_of(commit.changes.select("new.*")) == rows_of(t.current())
    monkeypatch.setattr(B, "TASK_BYTES", 500)
    t.upsert(frame(spark, some_rows(random.Random(5), 300, 200)).filter("updated_at is not null"))
    files = [len([f for f in os.listdir(folder) if f.endswith(".parquet")]) for folder in t.folders()]
    assert max(files) > 1
    both = frame(spark, rows).unionByName(frame(spark, some_rows(random.Random(5), 300, 200)).filter("updated_at is not null"))
    assert rows_of(t.current()) == rows_of(latest_version(both, "claim_id", ["updated_at"]))
