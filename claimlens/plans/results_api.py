"""The result-query surface of the reference's service, as DataFrame functions.

Each function takes the stored results (a DataFrame over the results table)
and returns DataFrames; nothing is collected. Names follow the service's
operations so its users can map calls one to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE
from ..operators import audit as A
from ..operators import query as QY


def _page(df: DataFrame, kind: str, filters: QY.ResultFilters | None, sort_by: str | None, sort_desc: bool,
          page: int, page_size: int) -> tuple[DataFrame, DataFrame]:
    """Page ``page`` and its summary. The service's bound on a page's size holds here, not in
    the operators; deep pages are asked for by keyset (``next_page``)."""
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be in [1, {MAX_PAGE_SIZE}]")
    rows = QY.filter_results(df, filters or QY.ResultFilters(), kind)
    return QY.page_items(rows, page, page_size, kind, sort_by, sort_desc), QY.page_summary(rows, page, page_size)


def next_page(df: DataFrame, kind: str, last_value, last_key, filters: QY.ResultFilters | None = None,
              sort_by: str | None = None, sort_desc: bool = True, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """The page after the row with this sort value and key, at the cost of one page however deep it is."""
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be in [1, {MAX_PAGE_SIZE}]")
    rows = QY.filter_results(df, filters or QY.ResultFilters(), kind)
    return QY.page_after(rows, last_value, last_key, page_size, kind, sort_by, sort_desc)


def get_fraud_results(results: DataFrame, filters: QY.ResultFilters | None = None, sort_by: str = "fraud_score",
                      sort_desc: bool = True, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE):
    """(items, summary) of one page of claim results (no flag filter unless asked, D8)."""
    return _page(results, "fraud", filters, sort_by, sort_desc, page, page_size)


def get_fraud_detail(results: DataFrame, claim_id: str) -> DataFrame:
    return QY.lookup(results, "claim_id", claim_id)


def get_fraud_score_bounds(results: DataFrame) -> DataFrame:
    return QY.score_bounds(results, "fraud_score")


def get_quality_results(quality: DataFrame, filters: QY.ResultFilters | None = None, sort_by: str = "quality_score",
                        sort_desc: bool = True, page: int = 1, page_size: int = DEFAULT_PAGE_SIZE):
    """(items, summary) of one page of manufacturer results."""
    return _page(quality, "quality", filters, sort_by, sort_desc, page, page_size)


def get_quality_detail(quality: DataFrame, manufacturer_id: str) -> DataFrame:
    return QY.lookup(quality, "manufacturer_id", manufacturer_id)


def get_quality_score_bounds(quality: DataFrame) -> DataFrame:
    return QY.score_bounds(quality, "quality_score")


def get_audit_logs(log: DataFrame, entity_type: str | None = None, entity_id: str | None = None,
                   date_from=None, date_to=None) -> DataFrame:
    return A.filter_audit(log, entity_type, entity_id, date_from, date_to)


def export_fraud(results: DataFrame, filters: QY.ResultFilters | None = None, limit: int | None = None) -> DataFrame:
    """Rows for CSV export (nested columns as JSON text); write with ``sinks.writers.export_csv``."""
    return QY.export_rows(QY.filter_results(results, filters or QY.ResultFilters(), "fraud"), limit=limit)


def export_quality(quality: DataFrame, filters: QY.ResultFilters | None = None, limit: int | None = None) -> DataFrame:
    return QY.export_rows(QY.filter_results(quality, filters or QY.ResultFilters(), "quality"), limit=limit)
