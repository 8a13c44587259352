"""Plan shape checks: pushdown, pruning, top-k, no cartesian products."""

from claimlens.operators import quality as Q
from claimlens.operators.ingest import apply_watermark
from claimlens.plans import catalogue as C
from claimlens.sources import warranty_views as views


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_pushed_to_scan(spark, sf_small):
    df = apply_watermark(spark.read.parquet(f"{sf_small}/lineitem.parquet").withColumnRenamed("l_shipdate", "updated_at"),
                         "2000-01-01T00:00:00Z")
    text = _plan(df)
    assert "PushedFilters" in text and "GreaterThanOrEqual(l_shipdate" in text


def test_column_pruning_on_claims_scan(spark, sf_small):
    plan = _plan(views.claims(spark, sf_small).select("claim_id"))
    read_schemas = [seg.split(">")[0] for seg in plan.split("ReadSchema: ")[1:]]
    assert read_schemas and all("l_extendedprice" not in rs for rs in read_schemas)


def test_topk_uses_group_limit(spark, sf_small):
    t = Q.top_skus(Q.sku_breakdown(C._enriched(spark, sf_small)), 3)
    t.collect()
    assert "WindowGroupLimit" in _plan(t)


def test_no_cartesian_product_in_results(spark, sf_small):
    text = _plan(C._results(spark, sf_small)) + _plan(C.q_manufacturer_quality(spark, sf_small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_concurrent_stage_builds_once(spark):
    import threading

    from claimlens.plans.stages import stage

    calls = []

    def build():
        calls.append(1)
        return spark.range(10)

    out = []
    threads = [threading.Thread(target=lambda: out.append(stage(spark, "file:///no/such/input", "t", build).count())) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert out == [10, 10, 10] and len(calls) == 1


def test_suggested_conf_is_only_a_suggestion(spark):
    from claimlens.session import session_conf, suggested_conf

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    conf = suggested_conf(spark, 10**15)
    # the test session configured its width explicitly, so it is kept
    assert "spark.sql.shuffle.partitions" not in conf and conf
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "7m", "spark.claimlens.test": "x"}):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "7m"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before and spark.conf.get("spark.claimlens.test", None) is None


def test_latest_version_has_no_sort_aggregate(spark, sf_small):
    from claimlens.operators.ingest import latest_version

    plan = latest_version(C.contract_versions(spark, sf_small), "contract_id", ["updated_at"])
    plan.collect()
    assert "SortAggregate" not in _plan(plan)


def test_scaler_queries_read_staged_statistics(spark, sf_small):
    for q in (C.q_standard_scale, C.q_inverse_scale, C.q_scaler_params, C.q_impute_median):
        text = _plan(q(spark, sf_small))
        assert "Exchange hashpartitioning(name" not in text and "percentile_approx" not in text


def test_deep_page_by_keyset_is_one_small_topk(spark, sf_small):
    from claimlens.operators import query as QY

    page = QY.page_after(C._results(spark, sf_small), 0.2, "CLAIM", 50)
    assert "limit=50," in _plan(page).replace(" ", "")


def test_changed_input_is_another_stage(spark, tmp_path):
    from claimlens.plans.stages import forget, stage, stage_root
    from claimlens.sources.storage import path_exists

    folder = str(tmp_path / "in")
    spark.range(3).write.parquet(folder)
    read = lambda: stage(spark, folder, "copy", lambda: spark.read.parquet(folder)).count()
    assert read() == 3
    spark.range(4).write.mode("append").parquet(folder)
    assert read() == 7
    assert path_exists(spark, stage_root(spark))


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from claimlens import session

    assert session.is_local_master("local[8]") and not session.is_local_master("local-cluster[3,2,3000]")

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_claims_are_exchanged_once_up_to_enrichment(spark, sf_small):
    """Where neither parts nor catalog can be broadcast, one exchange by sku serves both joins, and none ranks claims by id."""
    from claimlens.operators.enrich import enrich_claims
    from claimlens.plans import warranty as W
    from claimlens.session import session_conf

    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        inputs = W.view_inputs(spark, sf_small)
        exchanges = [line for line in _plan(enrich_claims(inputs.claims, inputs.catalog)).splitlines() if "Exchange hashpartitioning" in line]
    assert len([e for e in exchanges if "hashpartitioning(sku" in e or "hashpartitioning(part_sku" in e]) == len(exchanges)
    assert not any("claim_id" in e for e in exchanges) and len(exchanges) <= 4  # claims, parts, catalog by sku (its rows without one apart)


def test_features_carry_no_column_that_no_result_has(spark, sf_small):
    base = C._feature_base(spark, sf_small)
    assert not {"created_at", "updated_at", "manufacturer_unknown"} & set(base.columns)
    assert {"claim_id", "contract_id", "status", "description", "manufacturer_id", "claim_amount_raw"} <= set(base.columns)
