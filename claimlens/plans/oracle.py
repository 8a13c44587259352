"""SQL twins of the registered queries (run by DuckDB over the same tables).

Each string re-derives the warranty views and the operator chain in plain
SQL, independently of the Spark code, and selects the same column names.
"""

from __future__ import annotations

from ..config import (
    FACTOR_LABELS,
    FRAUD_INSTRUCTION,
    FRAUD_PROMPT,
    MISSING_TEXT,
    NO_CATEGORY_TEXT,
    NO_SKU_TEXT,
    QUALITY_INSTRUCTION,
    QUALITY_PROMPT,
    QUALITY_PROMPT_CATEGORY_LINE,
    QUALITY_PROMPT_SKU_LINE,
    QUALITY_REASON_DETAIL,
    QUALITY_REASON_TOP_SKU,
    feature_columns,
)
from ..functions.text import render_sql
from ..sources.warranty_views import sql_views
from . import catalogue as C

_NL = "chr(10)"


def _fixed(x: str, d: int) -> str:
    scale = 10**d
    t = f"CAST(round(({x}) * {scale}.0) AS BIGINT)"
    if d == 0:
        return f"CAST({t} AS VARCHAR)"
    return f"(CAST({t} // {scale} AS VARCHAR) || '.' || lpad(CAST({t} % {scale} AS VARCHAR), {d}, '0'))"


def _one_hot_sql() -> str:
    parts = []
    for name, values in (("claim_type", ("repair", "replacement", "refund")),
                         ("product_category", ("electronics", "appliances", "automotive", "furniture"))):
        for v in values:
            parts.append(f"CAST(coalesce({name} = '{v}', false) AS TINYINT) AS {name}_{v}")
        parts.append(f"CAST({name} IS NULL AS TINYINT) AS {name}_unknown")
    return ",\n    ".join(parts)


_CT = ("claim_amount", "days_between_contract_start_and_claim", "manufacturer_claim_frequency")


def _chain() -> str:
    """CTEs shared by most twins: enriched -> base -> imputed -> scaled -> scored -> results."""
    imp = ", ".join(f"coalesce(CAST(b.{c} AS DOUBLE), med.{c}, 0.0) AS {c}" for c in _CT)
    med = ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _CT)
    par = ", ".join(f"avg({c}) AS {c}__mean, stddev_samp({c}) AS {c}__std" for c in _CT)
    fix = ", ".join(
        f"coalesce({c}__mean, 0.0) AS {c}__mean, CASE WHEN {c}__std IS NULL OR {c}__std = 0 THEN 1.0 ELSE {c}__std END AS {c}__std"
        for c in _CT
    )
    scale = ", ".join(f"(i.{c} - p.{c}__mean) / p.{c}__std AS {c}" for c in _CT)
    dev = ", ".join(
        f"{{'neg': -abs(CAST({c} AS DOUBLE)), 'pos': {i}, 'name': '{c}'}}" for i, c in enumerate(feature_columns())
    )
    return f"""WITH {sql_views()},
enriched AS (
  SELECT c.*, k.manufacturer_id, k.manufacturer_name, k.product_category,
         k.manufacturer_id IS NULL AS manufacturer_unknown
  FROM claims c LEFT JOIN sku_catalog k ON c.sku = k.sku),
freq AS (
  SELECT manufacturer_id, count(*) AS manufacturer_claim_frequency
  FROM enriched WHERE manufacturer_id IS NOT NULL GROUP BY manufacturer_id),
base AS (
  SELECT e.*, e.claim_amount AS claim_amount_raw,
    CAST(f.manufacturer_claim_frequency AS DOUBLE) AS manufacturer_claim_frequency,
    k.start_date,
    CAST(date_diff('day', k.start_date, e.claim_date) AS DOUBLE) AS days_between_contract_start_and_claim,
    {_one_hot_sql()}
  FROM enriched e
  LEFT JOIN freq f ON e.manufacturer_id = f.manufacturer_id
  LEFT JOIN contracts k ON e.contract_id = k.contract_id),
med AS (SELECT {med} FROM base),
imputed AS (SELECT b.* REPLACE ({imp}) FROM base b, med),
params AS (SELECT {fix} FROM (SELECT {par} FROM imputed)),
scaled AS (SELECT i.* REPLACE ({scale}) FROM imputed i, params p),
dist AS (
  SELECT *, claim_amount * claim_amount
            + days_between_contract_start_and_claim * days_between_contract_start_and_claim
            + manufacturer_claim_frequency * manufacturer_claim_frequency AS raw_score
  FROM scaled),
bounds AS (SELECT min(raw_score) AS lo, max(raw_score) AS hi FROM dist),
scored AS (
  SELECT d.*, CASE WHEN b.hi = b.lo THEN 0.0 ELSE (d.raw_score - b.lo) / (b.hi - b.lo) END AS fraud_score
  FROM dist d, bounds b),
results AS (
  SELECT claim_id, coalesce(contract_id, '') AS contract_id, fraud_score, fraud_score > 0.7 AS is_suspected_fraud,
    list_transform(list_slice(list_sort([{dev}]), 1, 3), lambda x: x.name) AS contributing_factors,
    'distance-v1' AS model_version, sku, manufacturer_name, claim_amount_raw AS claim_amount, claim_type, claim_date,
    product_category, status, description, manufacturer_id
  FROM scored),
rollup AS (
  SELECT manufacturer_id, min(manufacturer_name) AS manufacturer_name, count(*) AS total_claims,
    count(*) FILTER (WHERE claim_type = 'repair') AS repair_count, avg(fraud_score) AS mean_anomaly_score,
    CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE claim_type = 'repair') / count(*) ELSE 0.0 END AS repair_claim_rate
  FROM results WHERE manufacturer_id IS NOT NULL AND manufacturer_id <> '' GROUP BY manufacturer_id),
peers AS (
  SELECT avg(repair_claim_rate) AS rm, stddev_pop(repair_claim_rate) AS rs,
         avg(mean_anomaly_score) AS sm, stddev_pop(mean_anomaly_score) AS ss FROM rollup),
quality AS (
  SELECT r.*,
    CASE WHEN p.rs > 1e-12 THEN (r.repair_claim_rate - p.rm) / p.rs ELSE 0.0 END AS quality_score,
    CASE WHEN p.ss > 1e-12 THEN (r.mean_anomaly_score - p.sm) / p.ss ELSE 0.0 END AS anomaly_score_z
  FROM rollup r, peers p),
cat_bd AS (
  SELECT manufacturer_id, CASE WHEN product_category IS NULL OR product_category = '' THEN 'unknown' ELSE product_category END AS category,
    count(*) AS claim_count, count(*) FILTER (WHERE claim_type = 'repair') AS repair_count
  FROM results WHERE manufacturer_id IS NOT NULL AND manufacturer_id <> '' GROUP BY ALL),
sku_bd AS (
  SELECT manufacturer_id, CASE WHEN sku IS NULL OR sku = '' THEN 'unknown' ELSE sku END AS sku,
    count(*) AS claim_count, count(*) FILTER (WHERE claim_type = 'repair') AS repair_count
  FROM results WHERE manufacturer_id IS NOT NULL AND manufacturer_id <> '' GROUP BY ALL),
sku_rank AS (
  SELECT *, repair_count / claim_count AS repair_rate,
    row_number() OVER (PARTITION BY manufacturer_id ORDER BY repair_count DESC, sku) AS sku_rank
  FROM sku_bd)"""


def _labels_sql(arr: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FACTOR_LABELS.items())
    return f"list_transform({arr}, lambda f: CASE f {cases} ELSE f END)"


def _flat_results(where: str = "") -> str:
    return f"""SELECT claim_id, contract_id, round(fraud_score, 6) AS fraud_score, is_suspected_fraud,
  array_to_string(contributing_factors, ',') AS contributing_factors, model_version, sku, manufacturer_name,
  claim_amount, claim_type, strftime(claim_date, '%Y-%m-%d') AS claim_date, product_category, status, description
FROM results {where}"""


def _audit() -> str:
    return """audit AS (
  SELECT 'fraud_flag' AS event_type, 'claim' AS entity_type, claim_id AS entity_id, model_version,
    round(fraud_score, 6) AS score, array_to_string(contributing_factors, ',') AS contributing_factors,
    CAST(0.7 AS DOUBLE) AS threshold, CAST(NULL AS VARCHAR) AS manufacturer_name, CAST(NULL AS DOUBLE) AS total_claims,
    CAST(NULL AS DOUBLE) AS repair_claim_rate, '2025-01-01 00:00:00' AS created_at
  FROM results WHERE is_suspected_fraud
  UNION ALL
  SELECT 'quality_flag', 'manufacturer', manufacturer_id, 'distance-v1', round(quality_score, 6), NULL,
    CAST(2.0 AS DOUBLE), manufacturer_name, CAST(total_claims AS DOUBLE), round(repair_claim_rate, 6), '2025-01-01 00:00:00'
  FROM quality WHERE quality_score > 2.0)"""


_CLAIM_ID = """concat_ws('-', 'CLAIM', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
    CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d'))"""


def _score_lines() -> str:
    num = "(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.' || lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0'))"
    return f"""lines AS (
  SELECT {_CLAIM_ID} AS claim_id,
    CASE l_linenumber WHEN 1 THEN {num}
      WHEN 2 THEN '{{"score": ' || {num} || '}}'
      WHEN 3 THEN '{{"anomaly_score": ' || {num} || '}}'
      WHEN 4 THEN '{{"x": 1}}'
      WHEN 5 THEN 'bad ' || {num}
      WHEN 6 THEN '{{"score": ' || {num}
      WHEN 7 THEN '{{"score": null}}'
      ELSE '  ' || {num} || ' ' END AS value
  FROM lineitem),
trimmed AS (SELECT claim_id, trim(value) AS v FROM lines WHERE trim(value) <> ''),
parsed AS (
  SELECT claim_id, v,
    CASE WHEN v LIKE '{{%' THEN
      CASE WHEN json_valid(v) THEN TRY_CAST(
        CASE WHEN json_exists(v, '$.score') THEN json_extract_string(v, '$.score')
             WHEN json_exists(v, '$.anomaly_score') THEN json_extract_string(v, '$.anomaly_score')
             ELSE '0' END AS DOUBLE) END
    ELSE TRY_CAST(v AS DOUBLE) END AS raw_score
  FROM trimmed),
parsed2 AS (
  SELECT claim_id, raw_score,
    CASE WHEN v LIKE '{{%' AND NOT json_valid(v) THEN 'invalid json'
         WHEN raw_score IS NULL THEN 'not a number' END AS parse_error
  FROM parsed)"""


def _fixed_forest() -> str:
    lists = lambda v: "[" + ", ".join(f"CAST({a} AS DOUBLE)" for a in v) + "]"
    return ", ".join(
        f"({t}, {n}, {dim}, CAST({cut} AS DOUBLE), {left}, {right}, {mass}, {lists(lo)}, {lists(hi)})"
        for t, n, dim, cut, left, right, mass, lo, hi in C.FIXED_FOREST
    )


def _extent() -> str:
    """How far a point lies outside a node's box, over all dimensions."""
    return "(" + " + ".join(f"greatest(n.lo[{i}] - w.x[{i}], 0) + greatest(w.x[{i}] - n.hi[{i}], 0)" for i in (1, 2, 3)) + ")"


def _span() -> str:
    return "(" + " + ".join(f"(n.hi[{i}] - n.lo[{i}])" for i in (1, 2, 3)) + ")"


def oracle_sql() -> dict[str, str]:
    chain = _chain()
    r6 = lambda c: f"round({c}, 6) AS {c}"
    cont = ", ".join(r6(c) for c in _CT)
    onehot = ", ".join(c for c in feature_columns()[3:])
    flt = f"product_category = 'electronics' AND fraud_score >= 0.05 AND fraud_score < 0.4"
    q: dict[str, str] = {}
    q["watermark_incremental"] = f"""WITH {sql_views()}
SELECT claim_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM claims
WHERE updated_at >= TIMESTAMP '2000-01-01 00:00:00'"""
    q["latest_contract_version"] = f"""WITH {sql_views()},
versions AS (
  SELECT * FROM contracts
  UNION ALL
  SELECT c.* REPLACE ('premium' AS contract_type, c.created_at + INTERVAL 60 DAY AS updated_at)
  FROM contracts c WHERE c.contract_id IN (SELECT printf('CONTRACT-%09d', o_orderkey) FROM orders WHERE o_orderstatus = 'O')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY updated_at DESC, contract_type DESC) AS rn FROM versions)
SELECT contract_id, contract_type, strftime(start_date, '%Y-%m-%d') AS start_date,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM ranked WHERE rn = 1"""
    q["enrich_claims"] = chain + "\nSELECT claim_id, sku, manufacturer_id, manufacturer_name, product_category, manufacturer_unknown FROM enriched"
    q["unknown_manufacturer_counts"] = chain + "\nSELECT count(*) AS claims, count(*) FILTER (WHERE manufacturer_unknown) AS unknown_manufacturer FROM enriched"
    q["distinct_skus"] = f"WITH {sql_views()}\nSELECT DISTINCT sku FROM claims"
    q["sku_batch_lookup"] = f"""WITH {sql_views()}
SELECT r.sku, k.manufacturer_id, k.manufacturer_name, k.product_category
FROM (SELECT DISTINCT sku FROM claims) r JOIN sku_catalog k ON r.sku = k.sku"""
    q["sku_not_found"] = f"""WITH {sql_views()}
SELECT c.sku FROM claims c WHERE NOT EXISTS (SELECT 1 FROM sku_catalog k WHERE k.sku = c.sku)"""
    q["retry_replay"] = chain + """,
queued AS (SELECT claim_id, sku, updated_at + INTERVAL 1 DAY AS updated_at FROM enriched WHERE manufacturer_unknown),
allv AS (SELECT claim_id, sku, updated_at FROM claims UNION ALL SELECT * FROM queued),
ranked AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY updated_at DESC) AS rn FROM allv)
SELECT claim_id, sku, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM ranked WHERE rn = 1"""
    q["manufacturer_frequency"] = chain + "\nSELECT manufacturer_id, count(*) AS manufacturer_claim_frequency FROM enriched GROUP BY manufacturer_id"
    q["days_feature"] = chain + "\nSELECT claim_id, days_between_contract_start_and_claim FROM base"
    q["one_hot"] = chain + f"\nSELECT claim_id, {onehot} FROM base"
    q["impute_median"] = chain + f"\nSELECT claim_id, {cont} FROM imputed"
    q["scaler_params"] = chain + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round({c}__mean, 6) AS mean, round({c}__std, 6) AS std FROM params" for c in _CT
    )
    q["standard_scale"] = chain + f"\nSELECT claim_id, {cont} FROM scaled"
    q["inverse_scale"] = chain + "\nSELECT s.claim_id, " + ", ".join(
        f"round(s.{c} * p.{c}__std + p.{c}__mean, 6) AS {c}" for c in _CT
    ) + " FROM scaled s, params p"
    q["feature_matrix"] = chain + f"\nSELECT claim_id, {cont}, {onehot} FROM scaled"
    q["minmax_scores"] = chain + "\nSELECT claim_id, round(raw_score, 6) AS raw_score, round(fraud_score, 6) AS fraud_score FROM scored"
    q["fraud_flags"] = chain + "\nSELECT claim_id, round(fraud_score, 6) AS fraud_score, fraud_score > 0.7 AS is_suspected_fraud FROM scored"
    q["contributing_factors"] = chain + "\nSELECT claim_id, array_to_string(contributing_factors, ',') AS contributing_factors FROM results"
    q["fraud_results"] = chain + "\n" + _flat_results()
    q["parse_score_lines"] = f"WITH {_score_lines()}\nSELECT claim_id, round(raw_score, 6) AS raw_score, parse_error FROM parsed2"
    q["score_alignment_errors"] = chain + f""",
{_score_lines()},
good AS (SELECT claim_id FROM parsed2 WHERE parse_error IS NULL),
known AS (SELECT claim_id FROM enriched WHERE NOT manufacturer_unknown)
SELECT coalesce(k.claim_id, g.claim_id) AS claim_id,
  CASE WHEN g.claim_id IS NULL THEN 'missing_score' ELSE 'missing_features' END AS error
FROM known k FULL OUTER JOIN good g ON k.claim_id = g.claim_id
WHERE k.claim_id IS NULL OR g.claim_id IS NULL"""
    q["manufacturer_quality"] = chain + """
SELECT manufacturer_id, manufacturer_name, total_claims, repair_count, round(repair_claim_rate, 6) AS repair_claim_rate,
  round(quality_score, 6) AS quality_score, quality_score > 2.0 AS is_quality_concern FROM quality"""
    q["manufacturer_anomaly"] = chain + """
SELECT manufacturer_id, round(mean_anomaly_score, 6) AS mean_anomaly_score, round(anomaly_score_z, 6) AS anomaly_score_z FROM quality"""
    q["category_breakdown"] = chain + """
SELECT manufacturer_id, category, claim_count, repair_count, round(repair_count / claim_count, 6) AS repair_rate FROM cat_bd"""
    q["category_map"] = chain + """
SELECT manufacturer_id, category AS key, claim_count, round(repair_count / claim_count, 6) AS repair_rate FROM cat_bd"""
    q["sku_breakdown"] = chain + """
SELECT manufacturer_id, sku, claim_count, repair_count, round(repair_count / claim_count, 6) AS repair_rate FROM sku_bd"""
    for k in (3, 10):
        q[f"top_skus_by_repairs_{k}"] = chain + f"\nSELECT manufacturer_id, sku, repair_count, sku_rank FROM sku_rank WHERE sku_rank <= {k}"
    q["audit_entries"] = chain + ",\n" + _audit() + "\nSELECT * FROM audit"
    q["audit_filter"] = chain + ",\n" + _audit() + """
SELECT * FROM audit WHERE entity_type = 'manufacturer'
  AND CAST(created_at AS TIMESTAMP) BETWEEN TIMESTAMP '2024-12-31 00:00:00' AND TIMESTAMP '2025-01-01 23:59:59.999999'"""
    q["results_filtered_page"] = chain + f"""
SELECT claim_id, round(fraud_score, 6) AS fraud_score, product_category FROM results WHERE {flt}
ORDER BY fraud_score DESC, claim_id LIMIT {C.PAGE_SIZE} OFFSET {(C.PAGE - 1) * C.PAGE_SIZE}"""
    q["page_summary"] = chain + f"""
SELECT count(*) AS total, {C.PAGE} AS page, {C.PAGE_SIZE} AS page_size,
  CAST(greatest(1, ceil(count(*) / {C.PAGE_SIZE}.0)) AS BIGINT) AS total_pages FROM results WHERE {flt}"""
    q["score_bounds"] = chain + """
SELECT 'fraud' AS kind, coalesce(round(min(fraud_score), 2), 0.0) AS min, coalesce(round(max(fraud_score), 2), 1.0) AS max FROM results
UNION ALL
SELECT 'quality', coalesce(round(min(quality_score), 2), 0.0), coalesce(round(max(quality_score), 2), 1.0) FROM quality"""
    q["claim_detail"] = chain + "\n" + _flat_results("WHERE claim_id = (SELECT min(claim_id) FROM results)")
    q["manufacturer_detail"] = chain + """
SELECT manufacturer_id, manufacturer_name, total_claims, round(quality_score, 6) AS quality_score FROM quality
WHERE manufacturer_id = (SELECT max(manufacturer_id) FROM quality)"""
    q["reason_text"] = chain + f"""
SELECT claim_id, CASE WHEN fraud_score < 0.4 THEN 'Within normal range'
  WHEN fraud_score < 0.7 THEN 'Slightly elevated — minor deviations'
  ELSE 'Suspected fraud — ' || array_to_string({_labels_sql('contributing_factors')}, '; ') END AS reason
FROM results"""
    detail = render_sql(QUALITY_REASON_DETAIL, {"rate_pct": _fixed("q.repair_claim_rate * 100.0", 0)})
    top = render_sql(QUALITY_REASON_TOP_SKU, {"sku": "t.sku", "sku_rate_pct": _fixed("t.repair_rate * 100.0", 0)})
    q["quality_reason_text"] = chain + f"""
SELECT q.manufacturer_id, CASE WHEN q.quality_score < 1.0 THEN 'Within normal range'
  WHEN q.quality_score < 2.0 THEN 'Slightly elevated repair rate'
  ELSE 'Quality concern — ' || {detail} || CASE WHEN t.sku IS NOT NULL THEN {top} ELSE '' END
  END AS reason
FROM quality q LEFT JOIN (SELECT * FROM sku_rank WHERE sku_rank = 1) t ON q.manufacturer_id = t.manufacturer_id"""
    na = lambda e: f"coalesce(CAST({e} AS VARCHAR), '{MISSING_TEXT}')"
    fraud_values = {c: na(c) for c in ("claim_id", "claim_type", "status", "description", "product_category",
                                        "contract_id", "sku", "manufacturer_name")}
    fraud_values["claim_date"] = na("strftime(claim_date, '%Y-%m-%d')")
    fraud_values["claim_amount"] = na(_fixed("claim_amount", 2))
    fraud_values["fraud_score"] = na(_fixed("fraud_score", 4))
    fraud_values["contributing_factors"] = "array_to_string(contributing_factors, ', ')"
    q["fraud_prompts"] = chain + f"""
SELECT claim_id, {render_sql(FRAUD_PROMPT, fraud_values)} AS prompt, {render_sql(FRAUD_INSTRUCTION, {})} AS instruction
FROM results WHERE is_suspected_fraud"""
    cat_line = render_sql(QUALITY_PROMPT_CATEGORY_LINE, {
        "category": "category", "claim_count": "CAST(claim_count AS VARCHAR)",
        "repair_count": "CAST(repair_count AS VARCHAR)", "rate_pct": _fixed("repair_count / claim_count * 100.0", 1)})
    sku_line = render_sql(QUALITY_PROMPT_SKU_LINE, {
        "sku": "sku", "claim_count": "CAST(claim_count AS VARCHAR)",
        "repair_count": "CAST(repair_count AS VARCHAR)", "rate_pct": _fixed("repair_rate * 100.0", 1)})
    body = render_sql(QUALITY_PROMPT, {
        "manufacturer_name": na("q.manufacturer_name"), "manufacturer_id": na("q.manufacturer_id"),
        "total_claims": "CAST(q.total_claims AS VARCHAR)", "repair_count": "CAST(q.repair_count AS VARCHAR)",
        "rate_pct": _fixed("q.repair_claim_rate * 100.0", 1),
        "non_repair_count": "CAST(q.total_claims - q.repair_count AS VARCHAR)",
        "quality_score": _fixed("q.quality_score", 4),
        "categories_text": f"coalesce(c.categories_text, '{NO_CATEGORY_TEXT}')",
        "skus_text": f"coalesce(s.skus_text, '{NO_SKU_TEXT}')",
    })
    q["quality_prompts"] = chain + f""",
cat_text AS (
  SELECT manufacturer_id, string_agg({cat_line}, {_NL} ORDER BY category) AS categories_text
  FROM cat_bd GROUP BY manufacturer_id),
sku_text AS (
  SELECT manufacturer_id, string_agg({sku_line}, {_NL} ORDER BY sku_rank) AS skus_text
  FROM sku_rank WHERE sku_rank <= 10 GROUP BY manufacturer_id)
SELECT q.manufacturer_id, {body} AS prompt, {render_sql(QUALITY_INSTRUCTION, {})} AS instruction
FROM quality q LEFT JOIN cat_text c ON q.manufacturer_id = c.manufacturer_id
LEFT JOIN sku_text s ON q.manufacturer_id = s.manufacturer_id
WHERE q.quality_score > 2.0"""
    compat = ", ".join(
        (f"{{'neg': -(CASE WHEN p.{c}__std > 0 THEN abs(s.{c} - p.{c}__mean) / p.{c}__std ELSE 0.0 END), 'pos': {i}, 'name': '{c}'}}"
         if c in _CT else f"{{'neg': -abs(CAST(s.{c} AS DOUBLE)), 'pos': {i}, 'name': '{c}'}}")
        for i, c in enumerate(feature_columns())
    )
    q["contributing_factors_compat"] = chain + f"""
SELECT s.claim_id, array_to_string(list_transform(list_slice(list_sort([{compat}]), 1, 3), lambda x: x.name), ',')
  AS contributing_factors
FROM scaled s, params p"""
    q["serving_extract"] = chain + """
SELECT claim_id, round(fraud_score, 6) AS fraud_score, is_suspected_fraud FROM results
ORDER BY fraud_score DESC, claim_id LIMIT 10000"""
    q["quality_results"] = chain + """,
rows AS (
  SELECT manufacturer_id, 'category' AS kind, category AS key, claim_count, CAST(repair_count AS DOUBLE) AS repair_count,
    repair_count / claim_count AS repair_rate FROM cat_bd
  UNION ALL SELECT manufacturer_id, 'nested_category', category, claim_count, NULL, repair_count / claim_count FROM cat_bd
  UNION ALL SELECT manufacturer_id, 'sku', sku, claim_count, repair_count, repair_count / claim_count FROM sku_bd
  UNION ALL SELECT manufacturer_id, 'top_sku', sku, claim_count, repair_count, repair_rate FROM sku_rank WHERE sku_rank <= 10)
SELECT q.manufacturer_id, q.manufacturer_name, q.total_claims, round(q.quality_score, 6) AS quality_score,
  q.quality_score > 2.0 AS is_quality_concern, round(q.mean_anomaly_score, 6) AS mean_anomaly_score,
  'distance-v1' AS model_version, '2025-01-01 00:00:00' AS scored_at, r.kind, r.key, r.claim_count, r.repair_count,
  round(r.repair_rate, 6) AS repair_rate
FROM quality q JOIN rows r ON q.manufacturer_id = r.manufacturer_id"""
    q["audit_trail"] = chain + ",\n" + _audit() + """
SELECT q.manufacturer_id, a.event_type, a.score AS audited_score
FROM quality q LEFT JOIN audit a ON a.entity_type = 'manufacturer' AND a.entity_id = q.manufacturer_id"""
    q["forest_scores_fixed"] = "WITH RECURSIVE" + chain.removeprefix("WITH") + f""",
nodes(tree_id, node_id, dim, cut, lft, rgt, mass, lo, hi) AS (VALUES {_fixed_forest()}),
walk AS (
  SELECT claim_id, [{", ".join(_CT)}] AS x, tree_id, 0 AS node_id, CAST(1 AS DOUBLE) AS pi, CAST(0 AS DOUBLE) AS r,
    CAST(0 AS DOUBLE) AS s, false AS done
  FROM scaled, (SELECT DISTINCT tree_id FROM nodes)
  UNION ALL
  SELECT claim_id, x, tree_id, next_id, pi * (1 - p), CASE WHEN leaf THEN r ELSE greatest(r, sib_mass / (next_mass + 1.0)) END,
    s + pi * p * greatest(r, mass) + CASE WHEN leaf THEN pi * (1 - p) * r ELSE 0 END, leaf
  FROM (
    SELECT w.*, n.mass, n.dim < 0 AS leaf, c.node_id AS next_id, c.mass AS next_mass, b.mass AS sib_mass,
      CASE WHEN {_extent()} = 0 THEN 0.0 ELSE {_extent()} / ({_extent()} + {_span()}) END AS p
    FROM walk w JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.node_id
    LEFT JOIN nodes c ON c.tree_id = n.tree_id AND c.node_id = CASE WHEN w.x[n.dim + 1] <= n.cut THEN n.lft ELSE n.rgt END
    LEFT JOIN nodes b ON b.tree_id = n.tree_id AND b.node_id = CASE WHEN w.x[n.dim + 1] <= n.cut THEN n.rgt ELSE n.lft END
    WHERE NOT w.done))
SELECT claim_id, round(avg(s), 6) AS raw_score FROM walk WHERE done GROUP BY claim_id"""
    exts = [f"(greatest(n.lo[{j}] - w.x[{j}], 0) + greatest(w.x[{j}] - n.hi[{j}], 0))" for j in range(1, len(_CT) + 1)]
    added = [f"g{j} + pi * greatest(r, mass) * e{j} + CASE WHEN leaf AND at_cut = {j - 1} THEN pi * (1 - p) * r ELSE 0 END" for j in range(1, len(_CT) + 1)]
    ranked = ", ".join(f"{{'neg': -round(avg(g{j}), 6), 'pos': {j}, 'name': '{c}'}}" for j, c in enumerate(_CT, 1))
    q["forest_factors_fixed"] = "WITH RECURSIVE" + chain.removeprefix("WITH") + f""",
nodes(tree_id, node_id, dim, cut, lft, rgt, mass, lo, hi) AS (VALUES {_fixed_forest()}),
walk AS (
  SELECT claim_id, [{", ".join(_CT)}] AS x, tree_id, 0 AS node_id, CAST(1 AS DOUBLE) AS pi, CAST(0 AS DOUBLE) AS r, 0 AS at_cut,
    {", ".join(f"CAST(0 AS DOUBLE) AS g{j}" for j in range(1, len(_CT) + 1))}, false AS done
  FROM scaled, (SELECT DISTINCT tree_id FROM nodes)
  UNION ALL
  SELECT claim_id, x, tree_id, next_id, pi * (1 - p), CASE WHEN leaf THEN r ELSE greatest(r, ratio) END,
    CASE WHEN NOT leaf AND ratio > r THEN dim ELSE at_cut END, {", ".join(added)}, leaf
  FROM (
    SELECT w.*, n.mass, n.dim, n.dim < 0 AS leaf, c.node_id AS next_id, b.mass / (c.mass + 1.0) AS ratio,
      CASE WHEN {_extent()} = 0 THEN 0.0 ELSE {_extent()} / ({_extent()} + {_span()}) END AS p,
      {", ".join(f"CASE WHEN {_extent()} = 0 THEN 0.0 ELSE {e} / ({_extent()} + {_span()}) END AS e{j}" for j, e in enumerate(exts, 1))}
    FROM walk w JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.node_id
    LEFT JOIN nodes c ON c.tree_id = n.tree_id AND c.node_id = CASE WHEN w.x[n.dim + 1] <= n.cut THEN n.lft ELSE n.rgt END
    LEFT JOIN nodes b ON b.tree_id = n.tree_id AND b.node_id = CASE WHEN w.x[n.dim + 1] <= n.cut THEN n.rgt ELSE n.lft END
    WHERE NOT w.done))
SELECT claim_id, round({" + ".join(f"avg(g{j})" for j in range(1, len(_CT) + 1))}, 6) AS raw_score,
  {", ".join(f"round(avg(g{j}), 6) AS {c}_share" for j, c in enumerate(_CT, 1))},
  array_to_string(list_transform(list_slice(list_sort([{ranked}]), 1, 3), lambda e: e.name), ',') AS contributing_factors
FROM walk WHERE done GROUP BY claim_id"""
    q["streaming_ingest"] = f"WITH {sql_views()}\nSELECT claim_id, true AS as_delivered FROM claims"
    q["claims_redelivered"] = chain + "\nSELECT manufacturer_id, total_claims, repair_count FROM rollup"
    q["ingest_two_runs_same_day"] = f"""WITH {sql_views()},
seen AS (SELECT *, coalesce(updated_at >= TIMESTAMP '2000-01-01 00:00:00', false) AS twice FROM claims)
SELECT claim_id, CASE WHEN twice THEN 'reviewed' ELSE status END AS status,
  strftime(CASE WHEN twice THEN updated_at + INTERVAL 1 DAY ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at FROM seen"""
    # the incremental core: every result is that of the plain computation over the final versions
    of = "CAST(split_part(claim_id, '-', 2) AS BIGINT) % 100"
    q["bucket_upsert"] = f"""WITH {sql_views()}
SELECT claim_id, CASE WHEN {of} = 7 THEN 'reviewed' ELSE status END AS status,
  strftime(CASE WHEN {of} = 7 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at FROM claims"""
    q["incremental_rollup"] = f"""WITH {sql_views()},
last AS (SELECT sku, CASE WHEN {of} = 7 THEN 'repair' ELSE claim_type END AS claim_type FROM claims)
SELECT manufacturer_id, coalesce(nullif(product_category, ''), 'unknown') AS product_category, count(*) AS total_claims,
  count(*) FILTER (WHERE claim_type = 'repair') AS repair_count,
  round(count(*) FILTER (WHERE claim_type = 'repair') / count(*), 6) AS repair_claim_rate
FROM last JOIN sku_catalog USING (sku) GROUP BY ALL"""
    q["streaming_current"] = f"""WITH {sql_views()},
halves AS (SELECT *, CAST(split_part(claim_id, '-', 3) AS INTEGER) % 2 = 0 AS updated FROM claims)
SELECT claim_id, CASE WHEN updated THEN 'reviewed' ELSE status END AS status,
  strftime(CASE WHEN updated THEN updated_at + INTERVAL 1 DAY ELSE updated_at - INTERVAL 400 DAY END, '%Y-%m-%d %H:%M:%S') AS updated_at,
  CAST(CASE WHEN updated THEN 1 ELSE 0 END AS BIGINT) AS late_rows FROM halves"""
    q["audit_log_by_bucket"] = f"SELECT * FROM ({q['audit_entries']})\nUNION ALL BY NAME\nSELECT * REPLACE (CAST(NULL AS VARCHAR) AS model_version) FROM ({q['audit_entries']})"
    box = ", ".join(f"round({end}(CAST({c} AS DOUBLE)), 6) AS {c}_{end}" for c in _CT for end in ("min", "max"))
    q["forest_update"] = chain + f""",
dealt AS (
  SELECT *, CAST('0x' || substr(md5(claim_id), 1, 8) AS BIGINT) % 20 AS tree_id, substr(md5(claim_id), 9, 24) AS h FROM scaled),
held AS (SELECT * FROM dealt QUALIFY row_number() OVER (PARTITION BY tree_id ORDER BY h, claim_id) <= 64)
SELECT tree_id, count(*) AS points, count(*) AS leaf_mass, min(claim_id) AS first_claim, max(claim_id) AS last_claim, {box}
FROM held GROUP BY tree_id"""
    q["cobucketed_days"] = q["days_feature"]
    q["page_directory"] = chain + """,
placed AS (SELECT claim_id, claim_amount, row_number() OVER (ORDER BY coalesce(claim_amount, 0) DESC, claim_id) - 1 AS pos, count(*) OVER () AS n FROM results)
SELECT CAST(pos // 70 + 1 AS BIGINT) AS page, claim_id, claim_amount FROM placed WHERE pos // 70 + 1 IN (1, 3, greatest(1, (n + 69) // 70))"""
    texts = ("claim_id", "contract_id", "sku", "claim_type", "status")
    counted = [f"SELECT '{c}' AS \"column\", 'string' AS stored_type, 'string' AS inferred_type, 2 * count({c}) AS v, 2 * count_if({c} IS NULL) AS e, 0 AS b FROM claims" for c in texts]
    counted += [
        f"SELECT 'claim_amount', 'double', 'string', count(claim_amount) + count_if(claim_amount IS NOT NULL OR {of} = 7), "
        f"count_if(claim_amount IS NULL) + count_if(claim_amount IS NULL AND {of} <> 7), count_if({of} = 7) FROM claims",
        f"SELECT 'claim_date', 'date', 'string', 2 * count(*), 0, count_if({of} = 8) FROM claims",
        *[f"SELECT '{c}', 'timestamp', 'timestamp', 2 * count(*), 0, 0 FROM claims" for c in ("created_at", "updated_at")],
        "SELECT 'line', NULL, 'int', count(*), 0, NULL FROM claims",
        "SELECT 'description', 'string', NULL, NULL, NULL, NULL",
    ]
    q["schema_drift"] = f"WITH {sql_views()}" + """
SELECT "column", stored_type, inferred_type, CAST(v AS DOUBLE) AS "values", CAST(e AS DOUBLE) AS nulls, CAST(b AS DOUBLE) AS bad_values,
  CASE WHEN v IS NULL THEN 'missing' WHEN stored_type IS NULL THEN 'new' WHEN b > 0 THEN 'drifted' ELSE 'ok' END AS status FROM (
""" + "\nUNION ALL ".join(counted) + ")"
    q["keyless_score_files"] = q["parse_score_lines"]
    q["medians_from_sketches"] = chain + "\n" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS name, round(CAST({c} AS DOUBLE), 6) AS median FROM med" for c in _CT
    )
    files = chain + f""",
{_score_lines()},
good AS (SELECT claim_id, max(raw_score) AS raw_score FROM parsed2 WHERE parse_error IS NULL GROUP BY claim_id)"""
    q["results_from_score_files"] = files + """,
paired AS (SELECT r.* EXCLUDE (fraud_score, is_suspected_fraud), g.raw_score FROM results r JOIN good g USING (claim_id)),
normed AS (SELECT *, CASE WHEN max(raw_score) OVER () = min(raw_score) OVER () THEN 0.0
  ELSE (raw_score - min(raw_score) OVER ()) / (max(raw_score) OVER () - min(raw_score) OVER ()) END AS fraud_score FROM paired)
SELECT claim_id, contract_id, round(fraud_score, 6) AS fraud_score, fraud_score > 0.7 AS is_suspected_fraud,
  array_to_string(contributing_factors, ',') AS contributing_factors, 'scores' AS model_version, sku, manufacturer_name,
  claim_amount, claim_type, strftime(claim_date, '%Y-%m-%d') AS claim_date, product_category, status, description FROM normed"""
    q["score_file_errors"] = files + """,
errors AS (
  SELECT 'missing_score' AS error FROM results r WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.claim_id = r.claim_id)
  UNION ALL SELECT 'missing_features' FROM good g WHERE NOT EXISTS (SELECT 1 FROM results r WHERE r.claim_id = g.claim_id)
  UNION ALL SELECT parse_error FROM parsed2 WHERE parse_error IS NOT NULL)
SELECT error, count(*) AS lines FROM errors GROUP BY error"""
    q["run_summary"] = chain + ",\n" + _audit() + """,
counted AS (
  SELECT unnest([
    {'counter': 'enriched_rows', 'value': (SELECT count(*) FROM enriched)},
    {'counter': 'unknown_manufacturer', 'value': (SELECT count(*) FROM enriched WHERE manufacturer_unknown)},
    {'counter': 'fraud_results_rows', 'value': (SELECT count(*) FROM results)},
    {'counter': 'published_results', 'value': (SELECT count(*) FROM results)},
    {'counter': 'flagged', 'value': (SELECT count(*) FROM results WHERE is_suspected_fraud)},
    {'counter': 'quality_results_rows', 'value': (SELECT count(*) FROM quality)},
    {'counter': 'published_quality', 'value': (SELECT count(*) FROM quality)},
    {'counter': 'concerns', 'value': (SELECT count(*) FROM quality WHERE quality_score > 2.0)},
    {'counter': 'quality_breakdown_rows', 'value': (SELECT count(*) FROM cat_bd) + (SELECT count(*) FROM sku_bd)},
    {'counter': 'audit_appended', 'value': (SELECT count(*) FROM audit)}]) AS c)
SELECT c.counter AS counter, c.value AS value, 'success' AS status, 'distance-v1' AS model_version FROM counted"""
    q["results_sorted_by_manufacturer"] = chain + f"""
SELECT claim_id, manufacturer_name FROM results ORDER BY manufacturer_name ASC NULLS LAST, claim_id LIMIT {2 * C.PAGE_SIZE}"""
    q["results_by_date_and_manufacturer"] = chain + """
SELECT claim_id, manufacturer_name, strftime(claim_date, '%Y-%m-%d') AS claim_date FROM results
WHERE manufacturer_name = (SELECT min(manufacturer_name) FROM results)"""
    q["quality_by_category"] = chain + """
SELECT manufacturer_id, round(quality_score, 6) AS quality_score FROM quality q
WHERE quality_score >= 0.0 AND EXISTS (SELECT 1 FROM cat_bd c WHERE c.manufacturer_id = q.manufacturer_id AND c.category = 'unknown')"""
    q["sku_ranking"] = chain + "\nSELECT manufacturer_id, sku, claim_count, repair_count FROM sku_bd"
    q["export_rows"] = chain + "\nSELECT claim_id, round(fraud_score, 6) AS fraud_score, CAST(to_json(contributing_factors) AS VARCHAR) AS contributing_factors FROM results"
    return q
