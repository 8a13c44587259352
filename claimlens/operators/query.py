"""Result queries: filter, sort, page, bounds, lookups, reason texts,
prompts and export (F3-F9, O1-O3, A11, X9-X15, P12, P13, K9)."""

from __future__ import annotations

import datetime as _dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    DEFAULT_PAGE_SIZE,
    FRAUD_FLAG_PREFIX,
    FRAUD_INSTRUCTION,
    FRAUD_PROMPT,
    FRAUD_REASON_CUTS,
    FRAUD_REASONS,
    MISSING_TEXT,
    NO_CATEGORY_TEXT,
    NO_SKU_TEXT,
    QUALITY_FLAG_PREFIX,
    QUALITY_INSTRUCTION,
    QUALITY_PROMPT,
    QUALITY_PROMPT_CATEGORY_LINE,
    QUALITY_PROMPT_SKU_LINE,
    QUALITY_REASON_CUTS,
    QUALITY_REASON_DETAIL,
    QUALITY_REASON_TOP_SKU,
    QUALITY_REASONS,
)
from ..functions.scalar import factor_labels, reason_category, utc_bound
from ..functions.text import fixed, render

KEYS = {"fraud": ("claim_id", "fraud_score"), "quality": ("manufacturer_id", "quality_score")}


@dataclass(frozen=True)
class ResultFilters:
    date_from: str | _dt.datetime | None = None
    date_to: str | _dt.datetime | None = None
    manufacturer: str | None = None
    category: str | None = None
    score_min: float | None = None
    score_max: float | None = None
    reason: str | None = None
    # The reference's "flagged" lists return every row by score; opt in to filter on the flag
    flagged_only: bool = False


def reason_of(kind: str) -> Column:
    """X9 for fraud or quality rows."""
    if kind == "fraud":
        return reason_category(F.col("fraud_score"), FRAUD_REASON_CUTS, FRAUD_REASONS)
    return reason_category(F.col("quality_score"), QUALITY_REASON_CUTS, QUALITY_REASONS)


def filter_results(df: DataFrame, filters: ResultFilters, kind: str = "fraud") -> DataFrame:
    """Every given filter must hold (all predicates are plain columns,
    so they push into a Parquet scan of stored results)."""
    _, score_col = KEYS[kind]
    out = df
    lo, hi = utc_bound(filters.date_from), utc_bound(filters.date_to, upper=True)
    if lo is not None or hi is not None:
        ts = F.col("scored_at")
        out = out.filter(ts.isNotNull())
        if lo is not None:
            out = out.filter(ts >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            out = out.filter(ts <= F.lit(hi).cast("timestamp"))
    if filters.manufacturer:
        out = out.filter(F.col("manufacturer_name") == filters.manufacturer)
    if filters.category:
        if "product_category_breakdown" in df.columns:
            out = out.filter(F.map_contains_key("product_category_breakdown", filters.category))
        else:
            out = out.filter(F.col("product_category") == filters.category)
    score = F.col(score_col)
    if filters.score_min is not None:
        out = out.filter(score.isNull() | (score >= F.lit(float(filters.score_min))))
    if filters.score_max is not None:
        out = out.filter(score.isNull() | (score <= F.lit(float(filters.score_max))))
    if filters.reason:
        out = out.filter(reason_of(kind) == F.lit(filters.reason))
    if filters.flagged_only:
        out = out.filter(F.col("is_suspected_fraud" if kind == "fraud" else "is_quality_concern"))
    return out


def sort_results(df: DataFrame, kind: str = "fraud", sort_by: str | None = None, descending: bool = True) -> DataFrame:
    """O1: sort by any column (missing number -> 0, other missing values last), key as the
    unique tie-break."""
    value = sort_value(df, kind, sort_by)
    return df.orderBy(value.desc_nulls_last() if descending else value.asc_nulls_last(), F.col(KEYS[kind][0]).asc())


def sort_value(df: DataFrame, kind: str, sort_by: str | None) -> Column:
    col = sort_by or KEYS[kind][1]
    if col not in df.columns:
        return F.lit(0.0)  # a whole number would be read as a column position
    return F.coalesce(F.col(col), F.lit(0)) if isinstance(df.schema[col].dataType, T.NumericType) else F.col(col)


def page_after(df: DataFrame, last_value, last_key, page_size: int = DEFAULT_PAGE_SIZE, kind: str = "fraud",
               sort_by: str | None = None, descending: bool = True) -> DataFrame:
    """O2 by keyset: the page after the row with this sort value and key.

    Any page costs one top-k of ``page_size`` rows; ``page_items`` with a page number keeps
    page x size rows per task and is for shallow pages. ``last_value`` None means that the
    last row's value was missing.
    """
    key, value = F.col(KEYS[kind][0]), sort_value(df, kind, sort_by)
    if last_value is None:
        later = value.isNull() & (key > last_key)
    else:
        further = value < F.lit(last_value) if descending else value > F.lit(last_value)
        later = further | value.isNull() | ((value == F.lit(last_value)) & (key > last_key))
    return sort_results(df.filter(later), kind, sort_by, descending).limit(page_size)


def page_items(df: DataFrame, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE, kind: str = "fraud",
               sort_by: str | None = None, descending: bool = True) -> DataFrame:
    """O2: one page of the sorted rows (planned as a top-k, not a full sort)."""
    page, page_size = _check_page(page, page_size)
    ordered = sort_results(df, kind, sort_by, descending)
    return ordered.offset((page - 1) * page_size).limit(page_size)


def page_summary(df: DataFrame, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """O2: total rows and page count (at least one page)."""
    page, page_size = _check_page(page, page_size)
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"),
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        F.greatest(F.lit(1), F.ceil(total / F.lit(float(page_size)))).cast("bigint").alias("total_pages"),
    )


def _check_page(page: int, page_size: int) -> tuple[int, int]:
    if page < 1:
        raise ValueError("page must be >= 1")
    if page_size < 1:
        raise ValueError("page_size must be >= 1")
    return page, page_size


def total_pages(total: int, page_size: int) -> int:
    return max(1, math.ceil(total / page_size))


def score_bounds(df: DataFrame, score_col: str) -> DataFrame:
    """min/max rounded to 2 places; empty input gives 0.0 / 1.0."""
    return df.agg(
        F.coalesce(F.round(F.min(score_col), 2), F.lit(0.0)).alias("min"),
        F.coalesce(F.round(F.max(score_col), 2), F.lit(1.0)).alias("max"),
    )


def lookup(df: DataFrame, key_col: str, value) -> DataFrame:
    """point lookup (empty frame = not found)."""
    return df.filter(F.col(key_col) == value).limit(1)


def serving_extract(results: DataFrame, limit: int, kind: str = "fraud") -> DataFrame:
    """A report of the top ``limit`` rows by score (the caller says how many)."""
    return sort_results(results, kind).limit(limit)


def fraud_reason_text(results: DataFrame) -> DataFrame:
    """X9 + X10: readable reason for each claim."""
    reason = reason_of("fraud")
    labels = F.array_join(factor_labels(F.col("contributing_factors")), "; ")
    text = F.when(reason == F.lit(FRAUD_REASONS[2]), F.concat(F.lit(FRAUD_FLAG_PREFIX), labels)).otherwise(reason)
    return results.withColumn("reason", text)


def percent0(rate: Column) -> Column:
    """Rate as a whole percent, half up."""
    return fixed(rate * 100.0, 0)


def quality_reason_text(quality: DataFrame, top_sku: DataFrame) -> DataFrame:
    """X11: reason text with repair percent and the top SKU by repairs.

    ``top_sku`` holds the rank-1 row per manufacturer (``top_skus(.., 1)``).
    """
    top = top_sku.select(
        "manufacturer_id", F.col("sku").alias("_top_sku"), F.col("repair_rate").alias("_top_rate")
    )
    joined = quality.join(top, "manufacturer_id", "left")
    detail = render(QUALITY_REASON_DETAIL, {"rate_pct": percent0(F.col("repair_claim_rate"))})
    with_top = F.concat(
        detail, render(QUALITY_REASON_TOP_SKU, {"sku": F.col("_top_sku"), "sku_rate_pct": percent0(F.col("_top_rate"))})
    )
    detail = F.when(F.col("_top_sku").isNotNull(), with_top).otherwise(detail)
    reason = reason_of("quality")
    text = F.when(reason == F.lit(QUALITY_REASONS[2]), F.concat(F.lit(QUALITY_FLAG_PREFIX), detail)).otherwise(reason)
    return joined.withColumn("reason", text).drop("_top_sku", "_top_rate")


def _na(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(MISSING_TEXT))


def fraud_prompts(results: DataFrame) -> DataFrame:
    """Review texts per flagged claim: the data (``prompt``) and the ``instruction`` for who
    reads it (no model call)."""
    flagged = results.filter(F.col("is_suspected_fraud"))
    values = {
        c: _na(F.col(c))
        for c in ("claim_id", "claim_type", "status", "description", "product_category", "contract_id", "sku",
                  "manufacturer_name")
    }
    values["claim_date"] = _na(F.date_format("claim_date", "yyyy-MM-dd"))
    values["claim_amount"] = _na(fixed(F.col("claim_amount"), 2))
    values["fraud_score"] = _na(fixed(F.col("fraud_score"), 4))
    values["contributing_factors"] = F.array_join(F.col("contributing_factors"), ", ")
    return flagged.select("claim_id", render(FRAUD_PROMPT, values).alias("prompt"), F.lit(FRAUD_INSTRUCTION).alias("instruction"))


def _lines_by(df: DataFrame, order: str, line: Column, name: str) -> DataFrame:
    """Per manufacturer, the rendered lines joined by newlines in ``order``
    (inputs are bounded: the category vocabulary or the top-k SKUs)."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(order), line.alias("line"))))
    return df.groupBy("manufacturer_id").agg(F.array_join(F.transform(entries, lambda e: e["line"]), "\n").alias(name))


def quality_prompts(quality: DataFrame, categories: DataFrame, top10: DataFrame) -> DataFrame:
    """Review texts per manufacturer of concern: the data (per-category lines and its
    top-10 SKUs by repairs, exact counts, D12) and the ``instruction``."""
    def line(template: str, key: str) -> Column:
        return render(template, {
            key: F.col(key),
            "claim_count": F.col("claim_count").cast("string"),
            "repair_count": F.col("repair_count").cast("string"),
            "rate_pct": fixed(F.col("repair_rate") * 100.0, 1),
        })

    cat_text = _lines_by(categories, "category", line(QUALITY_PROMPT_CATEGORY_LINE, "category"), "categories_text")
    sku_text = _lines_by(top10, "sku_rank", line(QUALITY_PROMPT_SKU_LINE, "sku"), "skus_text")
    flagged = quality.filter(F.col("is_quality_concern"))
    body = render(QUALITY_PROMPT, {
        "manufacturer_name": _na(F.col("manufacturer_name")),
        "manufacturer_id": _na(F.col("manufacturer_id")),
        "total_claims": F.col("total_claims").cast("string"),
        "repair_count": F.col("repair_count").cast("string"),
        "rate_pct": fixed(F.col("repair_claim_rate") * 100.0, 1),
        "non_repair_count": (F.col("total_claims") - F.col("repair_count")).cast("string"),
        "quality_score": fixed(F.col("quality_score"), 4),
        "categories_text": F.coalesce(F.col("categories_text"), F.lit(NO_CATEGORY_TEXT)),
        "skus_text": F.coalesce(F.col("skus_text"), F.lit(NO_SKU_TEXT)),
    })
    return (
        flagged.join(cat_text, "manufacturer_id", "left")
        .join(sku_text, "manufacturer_id", "left")
        .select("manufacturer_id", body.alias("prompt"), F.lit(QUALITY_INSTRUCTION).alias("instruction"))
    )


def export_rows(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Arrays, maps and structs as JSON text (CSV cannot hold them). All rows, unless
    the caller asks for a sample of ``limit``."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    cols = [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]
    out = df.select(*cols)
    return out if limit is None else out.limit(limit)
