"""Feature engineering.

The chain is one lazy plan. Global values (medians, means, deviations) enter
rows as scalar subqueries, never through ``collect``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORICAL_FEATURES, CONTINUOUS_FEATURES, UNKNOWN, RunSettings, feature_columns
from ..functions.scalar import as_date
from .joins import stored_lookup
from .stats import mean_std_table, median_table, with_scalars

DAYS = "days_between_contract_start_and_claim"
FREQUENCY = "manufacturer_claim_frequency"
RAW_AMOUNT = "claim_amount_raw"  # the unscaled amount, kept for result records


def manufacturer_frequency(claims: DataFrame) -> DataFrame:
    """A2: claim count per manufacturer (null manufacturer is its own group)."""
    return claims.groupBy("manufacturer_id").agg(F.count(F.lit(1)).alias(FREQUENCY))


def stored_frequency(claims: DataFrame) -> DataFrame:
    """The claim counts of known manufacturers as a stored lookup table."""
    return stored_lookup(manufacturer_frequency(claims).filter(F.col("manufacturer_id").isNotNull()))


def with_manufacturer_frequency(claims: DataFrame, frequency: DataFrame | None = None) -> DataFrame:
    """Attach each claim's manufacturer frequency (of ``claims``, if no ``frequency`` is given).

    The count table has one row per manufacturer (map-side combined, so a
    manufacturer with a third of all claims is one row per task). It is stored,
    so Spark knows its bytes and broadcasts it below the session's threshold:
    the claims are then not shuffled by a skewed key. A null manufacturer never
    matches, so its claims get null (then imputed).
    """
    freq = stored_frequency(claims) if frequency is None else frequency
    return claims.join(freq, "manufacturer_id", "left").select(
        *claims.columns, F.col(FREQUENCY).cast("double").alias(FREQUENCY)
    )


def with_contract_start(claims: DataFrame, contracts: DataFrame) -> DataFrame:
    """Attach ``start_date`` from contracts (deduplicated upstream)."""
    starts = contracts.select("contract_id", F.col("start_date").alias("_start"))
    return claims.join(starts, "contract_id", "left").select(
        *[F.col(c) for c in claims.columns if c != "start_date"], F.col("_start").alias("start_date")
    )


def with_days_feature(df: DataFrame) -> DataFrame:
    """Days from contract start to claim, as double (null if either is missing)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    claim_date = as_date(F.col("claim_date"), types["claim_date"])
    start_date = as_date(F.col("start_date"), types["start_date"])
    return df.withColumn(DAYS, F.datediff(claim_date, start_date).cast("double"))


def one_hot_exprs(categorical: Sequence[tuple[str, Sequence[str]]] = CATEGORICAL_FEATURES) -> dict[str, Column]:
    """``<col>_<value>`` = 1 when equal; ``<col>_unknown`` = 1 when null.

    A non-null value outside the known list sets every column to 0.
    """
    exprs: dict[str, Column] = {}
    for name, values in categorical:
        for v in values:
            exprs[f"{name}_{v}"] = F.coalesce(F.col(name) == F.lit(v), F.lit(False)).cast("tinyint")
        exprs[f"{name}_{UNKNOWN}"] = F.col(name).isNull().cast("tinyint")
    return exprs


def one_hot_encode(df: DataFrame, categorical: Sequence[tuple[str, Sequence[str]]] = CATEGORICAL_FEATURES) -> DataFrame:
    return df.withColumns(one_hot_exprs(categorical))


def impute_median(
    df: DataFrame,
    cols: Sequence[str] = CONTINUOUS_FEATURES,
    settings: RunSettings = RunSettings(),
    medians: DataFrame | None = None,
) -> DataFrame:
    """P5 + A3: null -> column median (lower median), or 0.0 for an all-null column.

    ``medians`` (one row, one column per feature) may be given precomputed.
    """
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    if medians is None:
        medians = median_table(df, present, settings.exact_median, settings.median_relative_error)
    tagged = with_scalars(df, "_medians", medians)
    return tagged.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c], F.lit(0.0)) for c in present}
    ).drop("_medians")


@dataclass
class Scaled:
    frame: DataFrame
    params: DataFrame  # one row: <col>__mean, <col>__std (std already fixed to 1 when 0/null)


def scaler_params(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4 + D18: mean and sample std; mean null -> 0, std null or 0 -> 1."""
    raw = mean_std_table(df, cols)
    fixed = []
    for c in cols:
        fixed.append(F.coalesce(F.col(f"{c}__mean"), F.lit(0.0)).alias(f"{c}__mean"))
        std = F.col(f"{c}__std")
        fixed.append(F.when(std.isNull() | (std == 0.0), F.lit(1.0)).otherwise(std).alias(f"{c}__std"))
    return raw.select(*fixed)


def standard_scale(
    df: DataFrame, cols: Sequence[str] = CONTINUOUS_FEATURES, params: DataFrame | None = None
) -> Scaled:
    """(x - mean) / std; columns missing from ``df`` are skipped.

    ``params`` (one row from ``scaler_params``) may be given precomputed.
    """
    present = [c for c in cols if c in df.columns]
    if params is None:
        params = scaler_params(df, present)
    if not present:
        return Scaled(df, params)
    p = F.col("_scaler")
    scaled = with_scalars(df, "_scaler", params).withColumns(
        {c: (F.col(c) - p[f"{c}__mean"]) / p[f"{c}__std"] for c in present}
    )
    return Scaled(scaled.drop("_scaler"), params)


def inverse_scale(df: DataFrame, params: DataFrame, cols: Sequence[str] = CONTINUOUS_FEATURES) -> DataFrame:
    """X * std + mean (round trip of ``standard_scale``)."""
    p = F.col("_scaler")
    out = with_scalars(df, "_scaler", params).withColumns(
        {c: F.col(c) * p[f"{c}__std"] + p[f"{c}__mean"] for c in cols if c in df.columns}
    )
    return out.drop("_scaler")


def scaler_params_map(params: DataFrame, cols: Sequence[str] = CONTINUOUS_FEATURES) -> DataFrame:
    """Scaler params as ``map<string, struct<mean, std>>`` (the JSON sink's shape)."""
    return params.select(
        F.create_map(
            *[
                item
                for c in cols
                for item in (
                    F.lit(c),
                    F.struct(F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std")),
                )
            ]
        ).alias("scaler_params")
    )


@dataclass
class FeatureSet:
    frame: DataFrame  # enriched claim columns + 12 scaled feature columns
    params: DataFrame  # scaler params (one row)


def feature_base(enriched: DataFrame, contracts: DataFrame) -> DataFrame:
    """Unscaled features: frequency, start date, days, one-hot.

    The count table reads only the enriched claims. Columns are added after the contract join, which
    exchanges whole rows.
    """
    frequency = stored_frequency(enriched)
    base = with_contract_start(enriched, contracts).withColumn(RAW_AMOUNT, F.col("claim_amount"))
    return one_hot_encode(with_days_feature(with_manufacturer_frequency(base, frequency)))


def engineer_features(
    enriched: DataFrame,
    contracts: DataFrame,
    settings: RunSettings = RunSettings(),
    materialize: Callable[[DataFrame, str], DataFrame] | None = None,
) -> FeatureSet:
    """The whole feature chain: frequency, start date, days, one-hot, impute, scale.

    ``materialize`` (if given) stores the unscaled base and the two one-row
    statistics tables, so each global pass (medians, then means and deviations)
    runs exactly once over a stored table instead of re-running the joins.
    """
    base = feature_base(enriched, contracts)
    cols = list(CONTINUOUS_FEATURES)
    if materialize is None:
        scaled = standard_scale(impute_median(base, cols, settings), cols)
        return FeatureSet(scaled.frame, scaled.params)
    base = materialize(base, "feature_base")
    medians = materialize(median_table(base, cols, settings.exact_median, settings.median_relative_error), "medians")
    imputed = impute_median(base, cols, settings, medians)
    params = materialize(scaler_params(imputed, cols), "scaler_params_table")
    scaled = standard_scale(imputed, cols, params)
    return FeatureSet(scaled.frame, params)


def feature_matrix(features: DataFrame) -> DataFrame:
    """``claim_id`` + the 12 features in fixed order."""
    return features.select("claim_id", *feature_columns())


def feature_metadata(spark, scaler_params_path: str, created_at: str) -> DataFrame:
    """Feature list, types and dimension as a one-row DataFrame."""
    from ..schemas import FEATURE_METADATA

    cols = feature_columns()
    types = {c: ("continuous" if c in CONTINUOUS_FEATURES else "one_hot") for c in cols}
    return spark.createDataFrame([(cols, types, len(cols), scaler_params_path, created_at)], FEATURE_METADATA)
