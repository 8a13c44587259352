"""Batch run with stage outputs written as tables (the lineage cuts).

A production run writes each stage as Parquet under a run folder inside the
cluster's shared ``spark.checkpoint.dir`` (or a caller-given folder). Later
stages read those tables, so a lost executor only re-runs work of its own stage.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from contextlib import nullcontext
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import RunSettings, feature_columns
from ..operators.audit import audit_entries
from ..operators.enrich import dedupe_catalog, enrich_or_queue, replay_retry
from ..operators.features import engineer_features, feature_matrix, feature_metadata, scaler_params_map
from ..operators.forest import sample_for_trees, score_forest, train_forest
from ..operators.ingest import apply_watermark, latest_version, nan_to_null, split_corrupt, split_null_key, stage_status
from ..operators.quality import quality_breakdown, quality_results
from ..operators.scoring import contributing_factors, flag_fraud, fraud_results, normalize_scores, results_from_scores
from ..schemas import ENTITY_KEYS, ENTITY_SCHEMAS
from ..session import ensure_checkpoint_dir, session_conf, suggested_conf
from ..sinks import writers as K
from ..sources.files import latest_model, read_entity_csv
from ..sources.score_lines import key_score_lines, parse_score_lines, read_score_lines
from ..sources.storage import delete_path, read_if_exists
from . import warranty as W


def run_folder(spark: SparkSession, base: str | None = None) -> str:
    """A fresh folder for this run's stage tables in shared storage."""
    return f"{(base or ensure_checkpoint_dir(spark)).rstrip('/')}/claimlens-run-{uuid.uuid4().hex[:12]}"


@dataclass
class BatchRun:
    folder: str
    tables: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    model_version: str = ""
    status: str = "success"

    def store(self, spark: SparkSession, df: DataFrame, name: str, **metrics) -> DataFrame:
        """Write a stage, count ``metrics`` (and rows) while it is written, read it back."""
        path, observed = f"{self.folder}/{name}", Observation(name)
        t0 = time.time()
        counts = [F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]]
        df.observe(observed, *counts).write.mode("overwrite").option("compression", "zstd").parquet(path)
        self.seconds[name] = round(time.time() - t0, 3)
        self.tables[name] = path
        got = observed.get
        self.counters[f"{name}_rows"] = got["rows"]
        self.counters.update({k: got[k] for k in metrics})
        return spark.read.schema(df.schema).parquet(path)

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row per counter of the run, with its status and model version."""
        rows = [(k, int(v), self.status, self.model_version) for k, v in sorted(self.counters.items())]
        return spark.createDataFrame(rows, "counter string, value long, status string, model_version string")


def run_batch(
    spark: SparkSession,
    inputs: W.Inputs,
    settings: RunSettings = RunSettings(),
    run_ts: _dt.datetime | None = None,
    folder: str | None = None,
    scorer: str = "distance",
    input_bytes: int | None = None,
    enriched: DataFrame | None = None,
    score_lines: DataFrame | str | None = None,
    models_dir: str | None = None,
    reuse_model: bool = False,
    publish_dir: str | None = None,
) -> BatchRun:
    """enrich -> features -> score/explain -> results -> quality -> audit -> publish.

    ``enriched`` (the stored output of :func:`enrich_stage`) replaces the enrichment step.
    ``scorer``: "distance"; "forest" trains a random cut forest (node table, headerless
    training CSV and manifest below ``models_dir``) or, with ``reuse_model``, scores by
    the newest one stored there (none is an error); "files" takes raw scores from keyed
    ``score_lines`` (a path, or lines with ``claim_id`` and ``value``) and counts every line or
    claim that finds no partner. The model version of results and audit entries names what
    scored them. ``publish_dir`` gets the result sinks; its audit log is appended to, never
    rewritten. ``input_bytes`` sizes the shuffles of this run only.
    """
    conf = suggested_conf(spark, input_bytes) if input_bytes else {}
    with session_conf(spark, conf) if conf else nullcontext():
        return _run_batch(spark, inputs, settings, run_ts, folder, scorer, enriched, score_lines, models_dir, reuse_model, publish_dir)


def _run_batch(spark, inputs, settings, run_ts, folder, scorer, enriched, score_lines, models_dir, reuse_model, publish_dir) -> BatchRun:
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run = BatchRun(folder or run_folder(spark))
    if enriched is None:
        unknown = F.count_if(F.col("manufacturer_unknown"))
        enriched = run.store(spark, W.enriched_table(inputs), "enriched", unknown_manufacturer=unknown)
    t0 = time.time()
    fs = engineer_features(enriched, inputs.contracts, settings, lambda df, name: run.store(spark, df, name))
    run.seconds["features_chain"] = round(time.time() - t0, 3)
    features = run.store(spark, fs.frame, "features")
    matrix = run.store(spark, feature_matrix(features), "feature_matrix")
    t0 = time.time()
    params_path = f"{run.folder}/scaler_params"
    K.write_json_document(scaler_params_map(fs.params), params_path)
    K.write_json_document(feature_metadata(spark, params_path, run_ts.isoformat()), f"{run.folder}/feature_metadata")
    run.seconds["metadata_json"] = round(time.time() - t0, 3)

    run.model_version, errors = settings.model_version, None
    params = fs.params if settings.compat_double_scale else None
    if scorer == "files":
        run.model_version = "scores" if settings.model_version == RunSettings.model_version else settings.model_version
        lines = key_score_lines(read_score_lines(spark, score_lines)) if isinstance(score_lines, str) else score_lines
        parsed = run.store(spark, parse_score_lines(lines), "score_lines")
        results, errors = results_from_scores(features, parsed, replace(settings, model_version=run.model_version), run_ts)
    else:
        if scorer == "forest":
            raw = _forest_scored(spark, run, matrix, settings, run_ts, models_dir, reuse_model)
            scored = flag_fraud(normalize_scores(features.join(raw, "claim_id")), settings.fraud_threshold)
            scored = contributing_factors(scored, params)
        else:
            scored = W.score_features(W.FeatureSet(features, fs.params), settings)
        results = fraud_results(scored, run.model_version, run_ts)
    flagged = F.count_if(F.col("is_suspected_fraud"))
    results = run.store(spark, results, "fraud_results", flagged=flagged)
    if errors is not None:
        run.store(spark, errors, "score_errors")
    concerns = F.count_if(F.col("is_quality_concern"))
    quality = quality_results(results, run.model_version, run_ts, settings.quality_threshold)
    quality = run.store(spark, quality, "quality_results", concerns=concerns)
    breakdown = run.store(spark, quality_breakdown(results), "quality_breakdown")
    entries = audit_entries(results, quality, run_ts, settings.fraud_threshold, settings.quality_threshold)
    entries = run.store(spark, entries, "audit_log")
    if publish_dir:
        publish(spark, run, results, quality, breakdown, entries, publish_dir)
    run.status = stage_status(run.counters["fraud_results_rows"], run.counters.get("score_errors_rows", 0))
    return run


def publish(spark: SparkSession, run: BatchRun, results: DataFrame, quality: DataFrame, breakdown: DataFrame,
            entries: DataFrame, publish_dir: str) -> None:
    """K6-K8: the result sinks of a run. Result files are replaced; the audit log grows."""
    base, t0 = publish_dir.rstrip("/"), time.time()
    run.counters["published_results"] = K.write_fraud_results(results, f"{base}/fraud_results")
    run.counters["published_quality"] = K.write_quality_results(
        quality, f"{base}/quality_results", breakdown, f"{base}/quality_breakdown"
    )
    run.counters["audit_appended"] = K.append_audit(spark, entries, f"{base}/audit_log")
    run.seconds["publish"] = round(time.time() - t0, 3)


def _forest_scored(spark, run: BatchRun, matrix: DataFrame, settings: RunSettings, run_ts, models_dir, reuse: bool) -> DataFrame:
    """``claim_id, raw_score`` by a new or the newest stored forest; only the key and the 12
    features go through Python."""
    cols = feature_columns()
    if reuse:
        nodes_path, run.model_version = latest_model(spark, models_dir)
    else:
        t0 = time.time()
        run.model_version = f"claimlens-forest-{run_ts:%Y%m%d%H%M%S}"
        model = f"{models_dir.rstrip('/')}/{run.model_version}" if models_dir else f"{run.folder}/model"
        nodes_path = f"{model}/nodes"
        sample = run.store(spark, sample_for_trees(matrix, cols, settings.num_trees, settings.num_samples_per_tree, settings.seed), "training_sample")
        records = K.write_training_csv(sample.select("claim_id", *[sample["x"][i].alias(c) for i, c in enumerate(cols)]), f"{run.folder}/training_csv")
        K.write_parquet(train_forest(sample, settings.seed), nodes_path)
        K.write_manifest(spark, f"{model}/manifest", run.model_version, nodes_path, time.time() - t0, records,
                         settings.num_trees, settings.num_samples_per_tree, len(cols), run_ts)
        run.seconds["train"] = round(time.time() - t0, 3)
    run.tables["forest_nodes"] = nodes_path
    return run.store(spark, score_forest(matrix, spark.read.parquet(nodes_path), cols).select("claim_id", "raw_score"), "forest_scored")


def ingest_stage(spark: SparkSession, raw_dir: str, out_dir: str, dt: str, since: str | _dt.datetime | None = None,
                 run_id: str | None = None, quarantine_dir: str | None = None) -> dict:
    """Ingestion: CSV extracts of contracts, claims and catalog -> one partition per run.

    Each extract is parsed once, into a scratch table. Rows that do not parse and rows without
    a key go to the quarantine tables (below ``quarantine_dir``, by default beside the output);
    the others, from the watermark on, to ``dt=<dt>/run_id=<run_id>``. Returns row, corrupt,
    null-key and status counters per entity.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    quarantine = quarantine_dir or f"{out_dir.rstrip('/')}_quarantine"
    scratch, summary = run_folder(spark), {}
    for entity in ENTITY_SCHEMAS:
        path = f"{scratch}/{entity}"
        read_entity_csv(spark, f"{raw_dir}/{entity}", entity).write.parquet(path)
        good, bad = split_corrupt(spark.read.parquet(path))
        keyed, no_key = split_null_key(nan_to_null(good), ENTITY_KEYS[entity])
        bound = since if entity != "sku_catalog" else None
        counters = K.write_partitioned(apply_watermark(keyed, bound), f"{out_dir}/{entity}", dt, run_id)
        corrupt = K.write_quarantine(bad, "corrupt", quarantine, entity, dt, run_id)
        null_key = K.write_quarantine(no_key, "null_key", quarantine, entity, dt, run_id)
        summary[entity] = {**counters, "corrupt": corrupt, "null_key": null_key, "run_id": run_id,
                           "status": stage_status(counters["rows"], corrupt + null_key)}
    delete_path(spark, scratch)
    return summary


def enrich_stage(spark: SparkSession, ingested_dir: str, out_dir: str, retry_dir: str, dt: str) -> dict:
    """Enrichment over every ingested partition, latest version per key.

    Writes the one current enriched table. With no catalog, the claims that are not
    queued yet are queued and nothing is overwritten (D6). Queued claims are replayed, stored
    with the ingested ones, and only then is the queue emptied.
    """
    claims = spark.read.parquet(f"{ingested_dir}/claims").drop("dt", "run_id")
    retry = read_if_exists(spark, retry_dir)
    catalog = read_if_exists(spark, f"{ingested_dir}/sku_catalog")
    if catalog is not None:
        catalog = dedupe_catalog(catalog.drop("run_id"), ["dt"]).drop("dt")
    latest = latest_version(claims, "claim_id", ["updated_at"]) if retry is None else replay_retry(claims, retry)
    enriched, queued = enrich_or_queue(latest, catalog)
    if enriched is None:
        return {"rows": 0, "queued": K.append_retry(queued, retry_dir), "status": "partial_failure"}
    counters = K.write_current(enriched, out_dir, dt, unknown_manufacturer=F.count_if(F.col("manufacturer_unknown")))
    replayed = 0
    if retry is not None:
        replayed = K.write_partitioned(retry, f"{ingested_dir}/claims", dt, f"replay-{uuid.uuid4().hex[:12]}")["rows"]
        K.clear_retry(spark, retry_dir)
    return {**counters, "queued": 0, "replayed": replayed, "status": "success"}
