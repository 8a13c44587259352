"""End-to-end plans over the warranty entities.

Each function returns a lazy DataFrame; nothing runs until a sink or the
caller acts. Stage boundaries that a production run would write out are marked
with ``Stage`` objects so a runner can materialise them (see ``runner.py``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import RunSettings
from ..operators.enrich import dedupe_catalog, enrich_claims
from ..operators.features import FeatureSet, engineer_features  # noqa: F401
from ..operators.ingest import latest_of_repeated, latest_version, repeated_keys
from ..operators.quality import quality_results
from ..operators.scoring import contributing_factors, distance_score, flag_fraud, fraud_results, normalize_scores
from ..sources import warranty_views as views
from .stages import stage

# one fixed timestamp for catalogue queries, so their output is reproducible
CATALOGUE_RUN_TS = _dt.datetime(2025, 1, 1, 0, 0, 0)


@dataclass
class Inputs:
    claims: DataFrame
    contracts: DataFrame
    catalog: DataFrame


def view_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Warranty entities over the test tables, latest version per key.

    The hashes of repeated claim ids are a stage table: whole claims are exchanged only where an id comes again.
    """
    claims = views.claims(spark, sf_dir, by_sku=True)
    repeated = stage(spark, sf_dir, "repeated_claims", lambda: repeated_keys(views.claims(spark, sf_dir), "claim_id"))
    return Inputs(
        claims=latest_of_repeated(claims, "claim_id", ["updated_at"], repeated),
        contracts=latest_version(views.contracts(spark, sf_dir), "contract_id", ["updated_at"]),
        catalog=dedupe_catalog(views.sku_catalog(spark, sf_dir)),
    )


def enriched_claims(inputs: Inputs) -> DataFrame:
    return enrich_claims(inputs.claims, inputs.catalog)


def enriched_table(inputs: Inputs) -> DataFrame:
    """Enriched claims as they are stored: sorted in each file, so that sums over them don't depend on the order
    of an exchange, and what neighbours of a SKU share takes little space in files and in the next exchange."""
    return enriched_claims(inputs).sortWithinPartitions("sku", "claim_id")


def claim_features(inputs: Inputs, settings: RunSettings = RunSettings()) -> FeatureSet:
    return engineer_features(enriched_claims(inputs), inputs.contracts, settings)


def score_features(features: FeatureSet, settings: RunSettings = RunSettings()) -> DataFrame:
    """Distance scoring (M3) -> normalise (X3) -> flag (F8) -> explain."""
    scored = normalize_scores(distance_score(features.frame))
    scored = flag_fraud(scored, settings.fraud_threshold)
    params = features.params if settings.compat_double_scale else None
    return contributing_factors(scored, params)


def claim_results(
    inputs: Inputs, settings: RunSettings = RunSettings(), run_ts: _dt.datetime = CATALOGUE_RUN_TS
) -> DataFrame:
    """P10 result rows for every claim."""
    scored = score_features(claim_features(inputs, settings), settings)
    return fraud_results(scored, settings.model_version, run_ts)


def manufacturer_results(
    results: DataFrame, settings: RunSettings = RunSettings(), run_ts: _dt.datetime = CATALOGUE_RUN_TS
) -> DataFrame:
    return quality_results(results, settings.model_version, run_ts, settings.quality_threshold)
