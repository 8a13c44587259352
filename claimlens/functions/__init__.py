"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from .scalar import (  # noqa: F401
    as_date,
    factor_labels,
    minmax_normalize,
    or_unknown,
    reason_category,
    safe_ratio,
    top_k_names,
    utc_bound,
    zscore,
)
