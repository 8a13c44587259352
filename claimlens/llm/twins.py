"""SQL twins of the manifest and the conversation trie, for DuckDB."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit (DuckDB has no function for it)."""
    points = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    byte = "list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {points}), lambda c, b: {byte}))"


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"


def _row_digest(text: str) -> str:
    return "sha256(" + " || ".join([*[_field(c) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)]) + ")"


MERKLE = f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS part, {_row_digest("text")} AS leaf,
               CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
                    THEN {_row_digest("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
        FROM documents
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs
    ), tree(part, level, idx, digest) AS (
        SELECT part, 0, idx, leaf FROM leaves
        UNION ALL
        SELECT part, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx))
        FROM (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM tree) WHERE n > 1 GROUP BY part, level, idx // 16
    ), tops AS (
        SELECT part, max(level) AS height, arg_max(digest, level) AS subroot FROM tree GROUP BY part
    ), upper(level, idx, digest) AS (
        SELECT 0, row_number() OVER (ORDER BY part) - 1, subroot FROM tops
        UNION ALL
        SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx))
        FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1 GROUP BY level, idx // 16
    ), sizes AS (
        SELECT max(level) AS height, arg_max(digest, level) AS root FROM upper
    ), siblings AS (
        SELECT a.part, a.level, a.idx,
               coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
               coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
        FROM tree a JOIN tree b ON a.part = b.part AND a.level = b.level AND a.idx // 16 = b.idx // 16 GROUP BY ALL
    ), above AS (
        SELECT a.level, a.idx,
               coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
               coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
        FROM upper a JOIN upper b ON a.level = b.level AND a.idx // 16 = b.idx // 16 GROUP BY ALL
    ), ranked AS (
        SELECT part, height, subroot, row_number() OVER (ORDER BY part) - 1 AS place FROM tops
    ), steps AS (
        SELECT l.part, l.idx AS leaf_idx, s.level AS step, s.before, s.after
        FROM leaves l JOIN ranked t USING (part)
        JOIN siblings s ON s.part = l.part AND s.level < t.height AND s.idx = l.idx // CAST(power(16, s.level) AS BIGINT)
        UNION ALL
        SELECT l.part, l.idx, t.height + u.level, u.before, u.after
        FROM leaves l JOIN ranked t USING (part), sizes
        JOIN above u ON u.level < sizes.height AND u.idx = t.place // CAST(power(16, u.level) AS BIGINT)
    ), proofs AS (
        SELECT part, leaf_idx, string_agg(before || after, '' ORDER BY step) AS proof, max(step) + 1 AS steps FROM steps GROUP BY ALL
    ), fold(part, leaf_idx, step, digest) AS (
        SELECT part, idx, 0, coalesce(tampered, leaf) FROM leaves
        UNION ALL
        SELECT f.part, f.leaf_idx, f.step + 1, sha256(s.before || f.digest || s.after)
        FROM fold f JOIN steps s ON s.part = f.part AND s.leaf_idx = f.leaf_idx AND s.step = f.step
    )
    SELECT l.doc_id, l.leaf, t.subroot, sizes.root, sha256(coalesce(p.proof, '')) AS proof_sha256,
           f.digest AS folded_root, f.digest = sizes.root AS verified
    FROM leaves l JOIN ranked t USING (part), sizes
    LEFT JOIN proofs p ON p.part = l.part AND p.leaf_idx = l.idx
    JOIN fold f ON f.part = l.part AND f.leaf_idx = l.idx AND f.step = coalesce(p.steps, 0)
"""


PREFIX_TRIE = f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS seq
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h
        FROM turns GROUP BY conv_id
    ), kept AS (
        SELECT c.*, least(c.h, coalesce(b.n, 0)) AS kept FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
    ), rebuilt AS (
        SELECT k.conv_id, t.seq AS pos, t.role, t.text FROM kept k JOIN turns t ON t.conv_id = k.base AND t.seq < k.kept
        UNION ALL
        SELECT k.conv_id, t.seq - k.h + k.kept, t.role, t.text FROM kept k JOIN turns t ON t.conv_id = k.conv_id AND t.seq >= k.h
    ), hashed AS (
        SELECT *, sha256(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS own,
               len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM rebuilt
    ), prefixes AS (
        SELECT conv_id, pos + 1 AS depth, words,
               string_agg(own, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
        FROM hashed
        UNION ALL
        SELECT conv_id, 0, 0, '' FROM kept
    ), nodes AS (
        SELECT path, any_value(depth) AS depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
               (count(*) - 1) * any_value(words) AS saved FROM prefixes GROUP BY path
    ), ends AS (
        SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
        FROM (SELECT conv_id, arg_max(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path
    ), children AS (
        SELECT left(path, strlen(path) - 64) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
    ), subtrees AS (
        -- a node lies below those that its least member passes through
        SELECT p.path, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum(y.saved) AS saved_tokens
        FROM nodes y JOIN prefixes p ON p.conv_id = y.conv_id AND p.depth <= y.depth
        LEFT JOIN children c ON c.path = y.path GROUP BY p.path
    )
    SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children,
           CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM nodes x JOIN subtrees s USING (path) LEFT JOIN children c USING (path) LEFT JOIN ends e USING (path)
    LEFT JOIN nodes u ON x.depth > 0 AND u.path = left(x.path, strlen(x.path) - 64)
"""
