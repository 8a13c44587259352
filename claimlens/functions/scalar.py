"""Scalar column functions (X1-X15). Each returns a Column built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FACTOR_LABELS, UNKNOWN

# population std below this counts as zero (float residue when all rates agree)
STD_EPSILON = 1e-12


def as_date(col: Column, dtype: T.DataType) -> Column:
    """A date column; malformed text becomes null instead of failing."""
    if isinstance(dtype, T.StringType):
        return F.try_to_date(col)
    return col.cast("date")


def minmax_normalize(x: Column, lo: Column, hi: Column) -> Column:
    """Map to [0, 1]; all-equal input maps to 0.0."""
    return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / std, or 0.0 when std is (numerically) zero or null."""
    return F.when(std > F.lit(STD_EPSILON), (x - mean) / std).otherwise(F.lit(0.0))


def safe_ratio(num: Column, den: Column) -> Column:
    """Num / den, 0.0 when den is 0 (ANSI-safe)."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def or_unknown(col: Column) -> Column:
    """Null (or empty) key becomes the literal ``unknown``."""
    return F.when(col.isNull() | (col == ""), F.lit(UNKNOWN)).otherwise(col)


def reason_category(score: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Bucket a score into reason labels; null score gives ''."""
    low, high = cuts
    return (
        F.when(score.isNull(), F.lit(""))
        .when(score < F.lit(low), F.lit(labels[0]))
        .when(score < F.lit(high), F.lit(labels[1]))
        .otherwise(F.lit(labels[2]))
    )


def factor_labels(factors: Column) -> Column:
    """Feature names -> readable labels (unknown names pass through)."""
    pairs = []
    for name, label in FACTOR_LABELS.items():
        pairs.extend([F.lit(name), F.lit(label)])
    lookup = F.create_map(*pairs)
    return F.transform(factors, lambda f: F.coalesce(F.element_at(lookup, f), f))


def top_k_names(scores: Sequence[tuple[str, Column]], k: int) -> Column:
    """Names of the k largest scores, descending; ties keep list order."""
    entries = [
        F.struct((-score).alias("neg"), F.lit(i).alias("pos"), F.lit(name).alias("name"))
        for i, (name, score) in enumerate(scores)
    ]
    ranked = F.slice(F.sort_array(F.array(*entries)), 1, k)  # compiled; array_sort calls a comparator expression per pair
    return F.transform(ranked, lambda e: e["name"])


def utc_bound(value: str | _dt.datetime | _dt.date | None, upper: bool = False) -> _dt.datetime | None:
    """Parse a filter bound to a naive UTC datetime.

    Accepts ISO strings with ``Z`` or an offset and date-only strings. A
    date-only *upper* bound covers the whole day.
    """
    if value is None or value == "":
        return None
    date_only = False
    if isinstance(value, _dt.datetime):
        parsed = value
    elif isinstance(value, _dt.date):
        parsed, date_only = _dt.datetime(value.year, value.month, value.day), True
    else:
        text = value.strip().replace("Z", "+00:00")
        date_only = len(text) == 10
        parsed = _dt.datetime.fromisoformat(text)
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    if date_only and upper:
        parsed = parsed + _dt.timedelta(days=1) - _dt.timedelta(microseconds=1)
    return parsed
