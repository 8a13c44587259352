import datetime as dt
import os
import tempfile


from claimlens.operators import enrich as E
from claimlens.operators.ingest import apply_watermark, latest_version, nan_to_null, split_corrupt
from claimlens.sources.files import read_entity_csv


def test_watermark_inclusive_and_typed(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 2)), ("c", dt.datetime(2023, 12, 31, 23, 59))],
        "claim_id string, updated_at timestamp",
    )
    got = sorted(r.claim_id for r in apply_watermark(df, "2024-01-01T00:00:00+00:00").collect())
    assert got == ["a", "b"]
    assert apply_watermark(df, None).count() == 3


def test_latest_version_per_key(spark):
    df = spark.createDataFrame(
        [("c1", "old", dt.datetime(2024, 1, 1), "2024-01-01"), ("c1", "new", dt.datetime(2024, 2, 1), "2024-02-01"),
         ("c2", "only", dt.datetime(2024, 1, 1), "2024-01-01")],
        "claim_id string, status string, updated_at timestamp, dt string",
    )
    out = {r.claim_id: r.status for r in latest_version(df, "claim_id", ["updated_at", "dt"]).collect()}
    assert out == {"c1": "new", "c2": "only"}


def test_latest_version_ties_nulls_and_null_keys(spark):
    rows = [
        ("a", dt.datetime(2024, 1, 1), "x"), ("a", dt.datetime(2024, 1, 1), "y"), ("a", dt.datetime(2023, 1, 1), "z"),
        ("b", None, "p"), ("b", None, "q"), ("c", None, "old"), ("c", dt.datetime(2024, 1, 1), "new"),
        ("d", dt.datetime(2024, 1, 1), "same"), ("d", dt.datetime(2024, 1, 1), "same"), ("e", dt.datetime(2024, 1, 1), None),
        (None, dt.datetime(2024, 1, 1), "n1"), (None, dt.datetime(2024, 1, 2), "n2"), (None, dt.datetime(2024, 1, 2), "n2"),
    ]
    df = spark.createDataFrame(rows, "k string, updated_at timestamp, v string")
    got = sorted(((r.k or "", r.v or "") for r in latest_version(df, "k", ["updated_at"]).collect()))
    assert got == [("", "n1"), ("", "n2"), ("", "n2"), ("a", "y"), ("b", "q"), ("c", "new"), ("d", "same"), ("e", "")]
    assert latest_version(df.limit(0), "k", ["updated_at"]).collect() == []


def test_header_in_another_order_is_an_error(spark):
    import pytest

    folder = tempfile.mkdtemp(prefix="claimlens-csv-")
    path = os.path.join(folder, "sku_catalog.csv")
    with open(path, "w") as fh:
        fh.write("manufacturer_id,sku,manufacturer_name,product_category,product_name\nM1,SKU1,Acme,electronics,p\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_entity_csv(spark, path, "sku_catalog").collect()


def test_csv_with_schema_keeps_corrupt_rows(spark):
    folder = tempfile.mkdtemp(prefix="claimlens-csv-")
    path = os.path.join(folder, "claims.csv")
    with open(path, "w") as fh:
        fh.write("claim_id,contract_id,sku,claim_date,claim_type,claim_amount,status,description,created_at,updated_at\n")
        fh.write("C1,K1,S1,2024-01-10,repair,12.5,open,ok,2024-01-10T00:00:00,2024-01-10T00:00:00\n")
        fh.write("C2,K2,S2,2024-01-11,refund,not-a-number,open,bad,2024-01-11T00:00:00,2024-01-11T00:00:00\n")
    df = read_entity_csv(spark, path, "claims").cache()
    good, bad = split_corrupt(df)
    assert [r.claim_id for r in good.collect()] == ["C1"]
    assert good.collect()[0].claim_date == dt.date(2024, 1, 10)
    assert bad.count() == 1


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", 1.0)], "k string, v double")
    out = {r.k: r.v for r in nan_to_null(df).collect()}
    assert out == {"a": None, "b": 1.0}


def test_enrich_and_lookup(spark):
    claims = spark.createDataFrame([("1", "S1"), ("2", "S9"), ("3", "S9")], "claim_id string, sku string")
    catalog = spark.createDataFrame(
        [("S1", "M1", "Acme", "electronics", "p"), ("S1", "M1", "Acme", "electronics", "q")],
        "sku string, manufacturer_id string, manufacturer_name string, product_category string, product_name string",
    )
    cat = E.dedupe_catalog(catalog)
    assert cat.count() == 1
    out = {r.claim_id: (r.manufacturer_id, r.manufacturer_unknown) for r in E.enrich_claims(claims, cat).collect()}
    assert out == {"1": ("M1", False), "2": (None, True), "3": (None, True)}
    found, missing = E.sku_lookup(claims, cat)
    assert [r.sku for r in found.collect()] == ["S1"]
    assert sorted(r.sku for r in missing.collect()) == ["S9", "S9"]  # repeats kept
    enriched, retry = E.enrich_or_queue(claims, None)
    assert enriched is None and retry.count() == 3


def test_retry_replay_latest_wins(spark):
    ingested = spark.createDataFrame([("1", "a", dt.datetime(2024, 1, 1))], "claim_id string, sku string, updated_at timestamp")
    retry = spark.createDataFrame([("1", "b", dt.datetime(2024, 1, 2)), ("2", "c", dt.datetime(2024, 1, 2))],
                                  "claim_id string, sku string, updated_at timestamp")
    out = {r.claim_id: r.sku for r in E.replay_retry(ingested, retry).collect()}
    assert out == {"1": "b", "2": "c"}


def test_latest_version_sorts_rows_only_once(spark):
    """No sort in the scan tasks, which hold a whole file split: one after the exchange."""
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 1)], "k string, v int")
    plan = latest_version(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.index("Sort [") < plan.index("Exchange hashpartitioning")
    assert sorted((r.k or "", r.v) for r in latest_version(df, "k", ["v"]).collect()) == [("", 1), ("A", 2), ("B", 1)]


def test_only_rows_of_repeated_keys_are_exchanged(spark, monkeypatch):
    from claimlens.operators import ingest as G

    rows = [(f"K{i % 40}" if i % 7 else None, i % 3, f"v{i % 11}") for i in range(90)]
    df = spark.createDataFrame(rows + [("once", 1, "a"), ("twice", 1, "a"), ("twice", None, "b")], "k string, v int, w string")
    key = lambda d: sorted(map(str, d.collect()))
    repeated = lambda d: G.repeated_keys(d, "k").cache()
    want = key(latest_version(df, "k", ["v"]))
    assert key(G.latest_of_repeated(df, "k", ["v"], repeated(df))) == want
    monkeypatch.setattr(G, "FEW_REPEATED", 1)  # many keys repeat: one exchange of all rows
    assert key(G.latest_of_repeated(df, "k", ["v"], repeated(df))) == want
    single = df.filter("k is null or k in ('once', 'K1')").dropDuplicates(["k", "v", "w"]).filter("k is null or k = 'once'").localCheckpoint()
    plan = G.latest_of_repeated(single, "k", ["v"], repeated(single))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString() and key(plan) == key(latest_version(single, "k", ["v"]))
