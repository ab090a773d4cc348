"""DuckDB SQL for the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

WORD_SPACE = r"[\x20\x09-\x0D]"

ORACLES = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.text) AS text_sha256 FROM d JOIN g USING (text)
    """,
    "op3_url_filter": r"""
        WITH u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN NULL ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        h AS (SELECT page_id, coalesce(regexp_extract(rest, '^([^/?#]*)', 1), '') AS raw_host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
        l AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM h),
        r(rule_host, rule_path, says) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        m AS (SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(says, length(rule_host || rule_path)) AS says
              FROM l JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
        SELECT l.page_id, host, path, rule, CASE WHEN m.says IS NOT NULL THEN m.says WHEN host = '' THEN 'block'
            WHEN regexp_matches(path, '(?i)(^|/)(login|cart)([/.]|$)') OR regexp_matches(host, '(^|\.)ads\.|(^|[.-])(spam|casino)[.-]') THEN 'block' ELSE 'allow' END AS verdict
        FROM l LEFT JOIN m USING (page_id)
    """,
    "op10_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        x AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS nth FROM d),
        k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
        h AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        f AS (SELECT k.doc_id, k.line, k.nth, h.key IS NOT NULL AND h.last <> k.doc_id AS gone FROM k LEFT JOIN h USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS kept_sha256
        FROM f GROUP BY doc_id
    """,
}
