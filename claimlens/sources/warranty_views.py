"""Warranty entities derived from the star-schema test tables.

The test tables are order/line-item shaped; these views map them onto the
warranty data model (catalog, contracts, claims). Each view has a Spark form
and a SQL twin with identical semantics, used as the correctness oracle.

Mapping rules (fixed so both engines agree):
- catalog: one row per part; parts of size 50 are missing from the catalog,
  so their claims have an unknown manufacturer.
- contracts: one per order; orders that are both pending ('P') and of the
  lowest priority have no contract, so their claims have no start date.
- claims: one per line item, with nulls planted in type (quantity 49) and
  amount (quantity 50).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# fixed values of the mapping
_CATEGORY_BY_TYPE_PREFIX = (
    ("ECONOMY", "electronics"),
    ("STANDARD", "appliances"),
    ("LARGE", "automotive"),
    ("MEDIUM", "furniture"),
    ("SMALL", "toys"),  # a category outside the known list
)  # PROMO -> null category
_MISSING_PART_SIZE = 50
_REPAIR_BRANDS = ("Brand#10", "Brand#20")


def _category(p_type: Column) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for prefix, category in _CATEGORY_BY_TYPE_PREFIX:
        expr = expr.when(p_type.startswith(prefix), F.lit(category))
    return expr


def _numbered(prefix: str, n: Column, digits: int) -> Column:
    """``prefix`` and the number, with zeros before it up to ``digits``: the text of ``format_string``, which is
    left only those that it writes otherwise (null, negative), as it parses its format for every row."""
    text = n.cast("string")
    padded = F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text)
    return F.when(n >= 0, F.concat(F.lit(prefix), padded)).otherwise(F.format_string(f"{prefix}%0{digits}d", n))


def sku_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    brand_no = F.substr(F.col("p_brand"), F.lit(7))
    return part.filter(F.col("p_size") != _MISSING_PART_SIZE).select(
        _numbered("SKU-", F.col("p_partkey"), 5).alias("sku"),
        F.concat(F.lit("MFR-"), F.lpad(brand_no, 5, "0")).alias("manufacturer_id"),
        F.concat(F.lit("Manufacturer_"), brand_no).alias("manufacturer_name"),
        _category(F.col("p_type")).alias("product_category"),
        F.col("p_name").alias("product_name"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    start = F.to_date(F.col("o_orderdate"))
    created = F.col("o_orderdate").cast("timestamp")
    return orders.filter(
        ~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"))
    ).select(
        _numbered("CONTRACT-", F.col("o_orderkey"), 9).alias("contract_id"),
        _numbered("CUST-", F.col("o_custkey"), 9).alias("customer_id"),
        F.lit(None).cast("string").alias("sku"),
        start.alias("start_date"),
        F.date_add(start, 730).alias("end_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "premium")
        .when(F.col("o_orderpriority") == "2-HIGH", "extended")
        .otherwise("standard")
        .alias("contract_type"),
        created.alias("created_at"),
        (created + F.expr("INTERVAL 30 DAYS")).alias("updated_at"),
    )


def claims(spark: SparkSession, sf_dir: str, by_sku: bool = False) -> DataFrame:
    """``by_sku`` joins parts by the text of their key, which stands for one key only: where that join exchanges
    the line items, claims are dealt by sku, and a join by sku that follows needs no exchange of whole claims."""
    line, part = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sku = _numbered("SKU-", F.col("l_partkey"), 5).alias("sku")
    if by_sku:
        line, sku = line.select("*", sku), F.col("sku")
        part = part.filter(F.col("p_partkey").isNotNull()).select(_numbered("SKU-", F.col("p_partkey"), 5).alias("part_sku"), "p_brand")
        joined = line.join(part, line["sku"] == part["part_sku"], "inner")
    else:
        joined = line.join(part, line["l_partkey"] == part["p_partkey"], "inner")
    rflag = F.col("l_returnflag")
    shipped = F.col("l_shipdate").cast("timestamp")
    return joined.select(
        F.concat_ws(
            "-",
            F.lit("CLAIM"),
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.date_format(F.col("l_shipdate"), "yyyyMMdd"),
        ).alias("claim_id"),
        _numbered("CONTRACT-", F.col("l_orderkey"), 9).alias("contract_id"),
        sku,
        F.to_date(F.col("l_shipdate")).alias("claim_date"),
        F.when(F.col("l_quantity") == 49, F.lit(None).cast("string"))
        .when(rflag == "R", "repair")
        .when((rflag == "A") & F.col("p_brand").isin(*_REPAIR_BRANDS), "repair")
        .when(rflag == "A", "replacement")
        .otherwise("refund")
        .alias("claim_type"),
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice"))
        .alias("claim_amount"),
        F.when(F.col("l_linestatus") == "O", "open")
        .when(F.col("l_linestatus") == "F", "closed")
        .otherwise("pending")
        .alias("status"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("description"),
        shipped.alias("created_at"),
        shipped.alias("updated_at"),
    )


def sql_views() -> str:
    """SQL twin of the three views, as CTE bodies (no leading WITH)."""
    cases = " ".join(
        f"WHEN p_type LIKE '{prefix}%' THEN '{cat}'" for prefix, cat in _CATEGORY_BY_TYPE_PREFIX
    )
    brands = ", ".join(f"'{b}'" for b in _REPAIR_BRANDS)
    return f"""
sku_catalog AS (
  SELECT printf('SKU-%05d', p_partkey) AS sku,
         'MFR-' || lpad(substr(p_brand, 7), 5, '0') AS manufacturer_id,
         'Manufacturer_' || substr(p_brand, 7) AS manufacturer_name,
         CASE {cases} END AS product_category,
         p_name AS product_name
  FROM part WHERE p_size <> {_MISSING_PART_SIZE}),
contracts AS (
  SELECT printf('CONTRACT-%09d', o_orderkey) AS contract_id,
         printf('CUST-%09d', o_custkey) AS customer_id,
         CAST(NULL AS VARCHAR) AS sku,
         CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + 730 AS end_date,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'premium'
              WHEN o_orderpriority = '2-HIGH' THEN 'extended' ELSE 'standard' END AS contract_type,
         CAST(o_orderdate AS TIMESTAMP) AS created_at,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 30 DAY AS updated_at
  FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')),
claims AS (
  SELECT concat_ws('-', 'CLAIM', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS claim_id,
         printf('CONTRACT-%09d', l_orderkey) AS contract_id,
         printf('SKU-%05d', l_partkey) AS sku,
         CAST(l_shipdate AS DATE) AS claim_date,
         CASE WHEN l_quantity = 49 THEN NULL
              WHEN l_returnflag = 'R' THEN 'repair'
              WHEN l_returnflag = 'A' AND p_brand IN ({brands}) THEN 'repair'
              WHEN l_returnflag = 'A' THEN 'replacement'
              ELSE 'refund' END AS claim_type,
         CASE WHEN l_quantity = 50 THEN NULL ELSE l_extendedprice END AS claim_amount,
         CASE WHEN l_linestatus = 'O' THEN 'open' WHEN l_linestatus = 'F' THEN 'closed' ELSE 'pending' END AS status,
         'line ' || CAST(l_linenumber AS VARCHAR) AS description,
         CAST(l_shipdate AS TIMESTAMP) AS created_at,
         CAST(l_shipdate AS TIMESTAMP) AS updated_at
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
