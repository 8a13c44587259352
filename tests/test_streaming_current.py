import datetime as dt
import os
import random
import tempfile
import time

from pyspark.sql import functions as F

from claimlens.operators.ingest import latest_version
from claimlens.streaming.current import change_schema, current_claims, follow_claims

HEADER = "claim_id,contract_id,sku,claim_date,claim_type,claim_amount,status,description,created_at,updated_at\n"


def line(claim, status, day, amount="1.0"):
    return f"{claim},K1,S1,2024-01-10,repair,{amount},{status},x,2024-01-10T00:00:00,2024-01-{day:02d}T00:00:00\n"


def folders():
    root = tempfile.mkdtemp(prefix="follow-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    return src, os.path.join(root, "table"), os.path.join(root, "check")


def put(src, name, *lines):
    with open(os.path.join(src, name), "w") as fh:
        fh.write(HEADER + "".join(lines))


def statuses(spark, target):
    return {r.claim_id: r.status for r in current_claims(spark, target, buckets=4).collect()}


def test_changes_late_rows_repeats_and_restart(spark):
    src, target, check = folders()
    put(src, "a.csv", line("A", "open", 5), line("A", "open", 5), line("B", "open", 3))
    first = follow_claims(spark, src, target, check, buckets=4)
    assert first == {"insert": 2, "update": 0, "late": 0, "repeat": 1, "unread": 0}
    # a new start from the checkpoint: nothing is read twice, the state is there
    put(src, "b.csv", line("A", "closed", 9), line("A", "old", 2), line("B", "open", 3), line("C", "open", 1, "many"), line("", "open", 1))
    second = follow_claims(spark, src, target, check, buckets=4)
    assert second == {"insert": 0, "update": 1, "late": 1, "repeat": 1, "unread": 2}
    assert statuses(spark, target) == {"A": "closed", "B": "open"}
    feed = spark.read.parquet(f"{target}/changes").filter("change = 'update'").collect()
    assert [(r.claim_id, r.old_status, r.status) for r in feed] == [("A", "open", "closed")]
    assert [r.status for r in spark.read.parquet(f"{target}/history").collect()] == ["old"]
    assert sum(follow_claims(spark, src, target, check, buckets=4).values()) == 0
    assert statuses(spark, target) == {"A": "closed", "B": "open"}


def test_idle_state_is_dropped_and_the_table_stays_right(spark):
    src, target, check = folders()
    put(src, "a.csv", line("A", "closed", 9))
    follow_claims(spark, src, target, check, buckets=4, idle_ms=1)
    time.sleep(0.1)
    put(src, "b.csv", line("B", "open", 1))
    follow_claims(spark, src, target, check, buckets=4, idle_ms=1)  # A's timer runs here
    put(src, "c.csv", line("A", "old", 2))
    third = follow_claims(spark, src, target, check, buckets=4, idle_ms=1)
    assert third["insert"] == 1 and third["late"] == 0  # forgotten, so it comes as new
    assert statuses(spark, target) == {"A": "closed", "B": "open"}  # the table compares versions itself


def test_random_deliveries_equal_the_latest_versions(spark):
    rng = random.Random(4)
    schema = spark.createDataFrame([], "claim_id string, status string, amount double, updated_at timestamp, day date").schema
    root = tempfile.mkdtemp(prefix="follow-")
    sent, kinds = [], {}
    for _ in range(3):
        rows = [
            (f"C{rng.randrange(12)}", rng.choice(["a", "b", None]), rng.choice([1.0, None]),
             rng.choice([None, *[dt.datetime(2024, 1, d) for d in (1, 2, 3)]]), rng.choice([None, dt.date(2024, 2, 2)]))
            for _ in range(25)
        ]
        sent += rows
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/src")
        for kind, n in follow_claims(spark, f"{root}/src", f"{root}/t", f"{root}/c", schema, "parquet", buckets=4).items():
            kinds[kind] = kinds.get(kind, 0) + n
    want = latest_version(spark.createDataFrame(sent, schema), "claim_id", ["updated_at"])
    got = current_claims(spark, f"{root}/t", schema, buckets=4)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sum(kinds.values()) == len(sent) and kinds["insert"] == got.count()
    assert spark.read.schema(schema).parquet(f"{root}/t/history").count() == kinds["late"]
    feed = spark.read.schema(change_schema(schema)).parquet(f"{root}/t/changes")
    assert feed.filter(F.col("change") == "update").count() == kinds["update"]


def test_state_is_per_cell_and_the_feed_per_row(spark):
    """Python is called once per cell, not per key; whole numbers beside nulls stay exact."""
    rng, root = random.Random(5), tempfile.mkdtemp(prefix="follow-")
    schema = spark.createDataFrame([], "claim_id string, big bigint, updated_at timestamp, status string").schema
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[2], r[1], r[3]))
    held, want = {}, []
    for _ in range(3):
        rows = [
            (f"C{rng.randrange(90)}", rng.choice([None, 2**62 + 1, 2**62 + 3]), rng.choice([None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)]), rng.choice(["a", None]))
            for _ in range(150)
        ]
        for r in sorted(rows, key=order):
            old = held.get(r[0])
            kind = "insert" if old is None else "update" if order(r) > order(old) else "late" if order(r) < order(old) else "repeat"
            want.append((kind, *r, *(old or (None,) * 4)))
            if kind in ("insert", "update"):
                held[r[0]] = r
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{root}/src")
        follow_claims(spark, f"{root}/src", f"{root}/t", f"{root}/c", schema, "parquet", buckets=4, cells=3)
    feed = spark.read.schema(change_schema(schema)).parquet(f"{root}/t/feed").drop("batch")
    assert sorted(map(tuple, feed.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, current_claims(spark, f"{root}/t", schema, buckets=4).collect()), key=str) == sorted(held.values(), key=str)
    assert spark.read.format("statestore").load(f"{root}/c/feed").count() == 3


def test_tables_of_a_stream_are_zstd(spark):
    import glob

    root = tempfile.mkdtemp(prefix="follow-zstd-")
    schema = spark.createDataFrame([], "claim_id string, status string, updated_at timestamp").schema
    spark.createDataFrame([("A", "new", None), ("A", "old", None)], schema).write.parquet(f"{root}/src")
    follow_claims(spark, f"{root}/src", f"{root}/t", f"{root}/ckpt", schema, "parquet", buckets=2, cells=2)
    files = [f for kind in ("feed", "changes", "current/data") for f in glob.glob(f"{root}/t/{kind}/**/*.parquet", recursive=True)]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
