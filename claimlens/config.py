"""Fixed values and tunable settings.

The constants in the "fixed values" block must equal the values of the system
this engine replaces, otherwise flags, labels and reason texts would differ.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (thresholds, enumerations, labels, limits)
# ---------------------------------------------------------------------------
FRAUD_THRESHOLD = 0.7
QUALITY_THRESHOLD = 2.0

NUM_TREES = 100
NUM_SAMPLES_PER_TREE = 256

CLAIM_TYPES = ("repair", "replacement", "refund")
PRODUCT_CATEGORIES = ("electronics", "appliances", "automotive", "furniture")
CONTRACT_TYPES = ("standard", "extended", "premium")
CLAIM_STATUSES = ("open", "closed", "pending")

# continuous features, in matrix order (the last one is derived)
CONTINUOUS_FEATURES = (
    "claim_amount",
    "days_between_contract_start_and_claim",
    "manufacturer_claim_frequency",
)
# categorical column -> known values; each also gets an `_unknown` column
CATEGORICAL_FEATURES = (
    ("claim_type", CLAIM_TYPES),
    ("product_category", PRODUCT_CATEGORIES),
)

FRAUD_REASON_CUTS = (0.4, 0.7)
FRAUD_REASONS = (
    "Within normal range",
    "Slightly elevated — minor deviations",
    "Suspected fraud",
)
QUALITY_REASON_CUTS = (1.0, 2.0)
QUALITY_REASONS = (
    "Within normal range",
    "Slightly elevated repair rate",
    "Quality concern",
)

FACTOR_LABELS = {
    "claim_amount": "High claim amount",
    "days_between_contract_start_and_claim": "Claim filed unusually fast",
    "manufacturer_claim_frequency": "Manufacturer has many claims",
    "claim_type_repair": "Repair-type claim",
    "claim_type_replacement": "Replacement-type claim",
    "claim_type_refund": "Refund-type claim",
    "claim_type_unknown": "Unknown claim type",
    "product_category_electronics": "Electronics product",
    "product_category_appliances": "Appliances product",
    "product_category_automotive": "Automotive product",
    "product_category_furniture": "Furniture product",
    "product_category_unknown": "Unknown product category",
}
FRAUD_FLAG_PREFIX = "Suspected fraud — "
QUALITY_FLAG_PREFIX = "Quality concern — "

# Text formats; {name} is a value of the row. The reason texts are fixed values; the
# review texts (data, then instruction) are this library's own wording.
QUALITY_REASON_DETAIL = "{rate_pct}% repair rate"
QUALITY_REASON_TOP_SKU = " — top: {sku} ({sku_rate_pct}% repairs)"
FRAUD_PROMPT = (
    "A warranty claim was marked as unusual. Facts on record:\n"
    "claim {claim_id}, filed {claim_date}, type {claim_type}, state {status}\n"
    "amount {claim_amount}, category {product_category}\n"
    "text of the claim: {description}\n"
    "contract {contract_id}, item {sku}, made by {manufacturer_name}\n"
    "unusualness on a scale of 0 to 1: {fraud_score}\n"
    "features that drove it, strongest first: {contributing_factors}"
)
FRAUD_INSTRUCTION = (
    "Act as a reviewer of warranty claims. In at most 150 words, say which of the facts explain the mark, "
    "what an honest reason for them could be, and which documents would settle it. "
    "Do not call the claim fraudulent; end with one word: approve, query or escalate."
)
QUALITY_PROMPT = (
    "A manufacturer's repair rate stands out. Facts on record:\n"
    "{manufacturer_name} (id {manufacturer_id})\n"
    "{repair_count} of {total_claims} claims are repairs, {rate_pct} percent; {non_repair_count} are not\n"
    "distance from its peers in standard deviations: {quality_score}\n"
    "by product category:\n"
    "{categories_text}\n"
    "items with most repairs:\n"
    "{skus_text}"
)
QUALITY_INSTRUCTION = (
    "Act as a quality engineer. In at most 200 words, say whether the repairs gather in one category or in a few "
    "items, what that suggests about the cause, and how sure the numbers allow one to be. "
    "End with the one check that should come first."
)
QUALITY_PROMPT_CATEGORY_LINE = "* {category}: {repair_count} repairs in {claim_count} claims, {rate_pct} percent"
QUALITY_PROMPT_SKU_LINE = "* {sku}: {repair_count} repairs in {claim_count} claims, {rate_pct} percent"
NO_CATEGORY_TEXT = "* none on record"
NO_SKU_TEXT = "* none on record"
MISSING_TEXT = "not given"

MAX_PAGE_SIZE = 500  # of the service surface (plans.results_api)
DEFAULT_PAGE_SIZE = 50
TOP_FACTORS = 3
UNKNOWN = "unknown"
# ---------------------------------------------------------------------------


def one_hot_columns() -> list[str]:
    cols: list[str] = []
    for name, values in CATEGORICAL_FEATURES:
        cols.extend(f"{name}_{v}" for v in values)
        cols.append(f"{name}_{UNKNOWN}")
    return cols


def feature_columns() -> list[str]:
    """The 12 model inputs in matrix order: 3 continuous, then 9 one-hot."""
    return list(CONTINUOUS_FEATURES) + one_hot_columns()


@dataclass(frozen=True)
class RunSettings:
    """Knobs of one run. Defaults reproduce the reference behaviour."""

    fraud_threshold: float = FRAUD_THRESHOLD
    quality_threshold: float = QUALITY_THRESHOLD
    model_version: str = "distance-v1"
    # exact lower median (percentile_disc) or the approximate sketch
    exact_median: bool = True
    median_relative_error: float = 0.001
    # reproduce the double standardisation of contributing factors
    compat_double_scale: bool = False
    num_trees: int = NUM_TREES
    num_samples_per_tree: int = NUM_SAMPLES_PER_TREE
    seed: int = 42
