"""Per-claim anomaly results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CONTINUOUS_FEATURES, FRAUD_THRESHOLD, TOP_FACTORS, feature_columns
from ..functions.scalar import minmax_normalize, top_k_names
from .stats import with_scalars

RESULT_CLAIM_COLUMNS = (
    "sku",
    "manufacturer_name",
    "claim_amount",
    "claim_type",
    "claim_date",
    "product_category",
    "status",
    "description",
)


def distance_score(features: DataFrame, cols: Sequence[str] = CONTINUOUS_FEATURES) -> DataFrame:
    """M3: raw score = sum of squared scaled continuous features."""
    total: Column = F.lit(0.0)
    for c in cols:
        total = total + F.col(c) * F.col(c)
    return features.withColumn("raw_score", total)


def score_bounds_table(scored: DataFrame, column: str = "raw_score") -> DataFrame:
    """A5: global min and max of the raw scores (one row)."""
    return scored.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def normalize_scores(scored: DataFrame, column: str = "raw_score", out: str = "fraud_score") -> DataFrame:
    """Min-max normalise to [0, 1] over the whole table (all-equal -> 0)."""
    b = F.col("_bounds")
    tagged = with_scalars(scored, "_bounds", score_bounds_table(scored, column))
    return tagged.withColumn(out, minmax_normalize(F.col(column), b["lo"], b["hi"])).drop("_bounds")


def flag_fraud(df: DataFrame, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """F8: strictly above the threshold."""
    return df.withColumn("is_suspected_fraud", F.col("fraud_score") > F.lit(threshold))


def deviation(value: Column, mean: Column | None = None, std: Column | None = None) -> Column:
    """|v - mean| / std when params are given (std <= 0 -> 0), else |v|."""
    if mean is None:
        return F.abs(value)
    std = F.coalesce(std, F.lit(1.0)) if std is not None else F.lit(1.0)
    return F.when(std > 0, F.abs(value - mean) / std).otherwise(F.lit(0.0))


def contributing_factors(
    features: DataFrame,
    params: DataFrame | None = None,
    cols: Sequence[str] | None = None,
    k: int = TOP_FACTORS,
) -> DataFrame:
    """The ``k`` features with the largest deviation, descending.

    Without ``params`` the deviation of a scaled feature is ``|v|`` (its
    z-score). Passing the scaler params reproduces the reference's double
    standardisation (D1).
    """
    cols = list(cols or feature_columns())
    p = None
    if params is not None:
        features = with_scalars(features, "_scaler", params)
        p = F.col("_scaler")
    scores = []
    for c in cols:
        if p is not None and f"{c}__mean" in params.columns:
            scores.append((c, deviation(F.col(c), p[f"{c}__mean"], p[f"{c}__std"])))
        else:
            scores.append((c, deviation(F.col(c))))
    out = features.withColumn("contributing_factors", top_k_names(scores, k))
    return out.drop("_scaler") if p is not None else out


def fraud_results(scored: DataFrame, model_version: str, scored_at) -> DataFrame:
    """P10: the per-claim result record (claim fields travel with the features,
    so no join back to the enriched claims is needed)."""
    return scored.select(
        "claim_id",
        F.coalesce(F.col("contract_id"), F.lit("")).alias("contract_id"),
        "fraud_score",
        "is_suspected_fraud",
        "contributing_factors",
        F.lit(model_version).alias("model_version"),
        F.lit(scored_at).cast("timestamp").alias("scored_at"),
        *[
            (F.col("claim_amount_raw").alias(c) if c == "claim_amount" and "claim_amount_raw" in scored.columns else F.col(c))
            for c in RESULT_CLAIM_COLUMNS
        ],
        # kept for quality aggregation; not part of the published record
        "manufacturer_id",
    )


def join_scores(scores: DataFrame, features: DataFrame) -> DataFrame:
    """(claim_id, raw_score) rows with the claim fields and features they score.

    ``scores`` are matched rows of :func:`align_scores`, so each has its features.
    """
    return features.join(scores.select("claim_id", "raw_score"), "claim_id")


def results_from_scores(features: DataFrame, parsed: DataFrame, settings, scored_at) -> tuple[DataFrame, DataFrame]:
    """S5 + J5 + J4 + P10: (results, errors) from keyed, parsed score lines.

    Lines that do not parse, have no key or repeat one (the greatest score counts), and
    claims or scores without a partner are errors by name; the matched scores are normalised
    over each other, flagged and explained like any others.
    """
    good = parsed.filter(F.col("parse_error").isNull() & F.col("claim_id").isNotNull())
    scores = good.groupBy("claim_id").agg(F.max("raw_score").alias("raw_score"), F.count(F.lit(1)).alias("_n"))
    matched, unmatched = align_scores(features, scores)
    scored = flag_fraud(normalize_scores(join_scores(matched, features)), settings.fraud_threshold)
    results = fraud_results(contributing_factors(scored), settings.model_version, scored_at)
    bad = parsed.filter(F.col("parse_error").isNotNull() | F.col("claim_id").isNull()).select(
        "claim_id", F.coalesce("parse_error", F.lit("no claim id")).alias("error")
    )
    repeated = scores.filter("_n > 1").select("claim_id", F.lit("repeated score").alias("error"))
    return results, unmatched.unionByName(bad).unionByName(repeated)


def align_scores(features: DataFrame, scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keyed (not positional) alignment of features and scores.

    Returns (matched rows, errors). Errors name the side that is missing.
    """
    f = features.select("claim_id", F.lit(True).alias("_has_features"))
    s = scores.select("claim_id", "raw_score", F.lit(True).alias("_has_score"))
    both = f.join(s, "claim_id", "full_outer")
    matched = both.filter(F.col("_has_features") & F.col("_has_score")).select("claim_id", "raw_score")
    errors = both.filter(F.col("_has_features").isNull() | F.col("_has_score").isNull()).select(
        "claim_id",
        F.when(F.col("_has_score").isNull(), F.lit("missing_score"))
        .otherwise(F.lit("missing_features"))
        .alias("error"),
    )
    return matched, errors
