"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op1_url_filters": r"""
        WITH parts AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), rules(rule_host, rule_path, rule_verdict) AS (VALUES
            ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), fitting AS (
            SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.rule_verdict,
                row_number() OVER (PARTITION BY p.page_id
                    ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS place
            FROM parts p LEFT JOIN rules r
                ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
                AND starts_with(p.path, r.rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM fitting WHERE place = 1
    """,
}

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '')"

ORACLES["op9_decontamination"] = rf"""
    WITH texts AS (SELECT item_id, w, least(len(w), 5) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)
        WHERE len(w) > 0
    ), items AS (
        SELECT item_id, unnest(list_distinct(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS shingle
        FROM texts
    ), sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
    docs AS (
        SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS shingle
        FROM (SELECT doc_id, {_WORDS} AS w FROM documents), (SELECT DISTINCT k FROM texts)
    )
    SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS n_shingles, CAST(count(*) AS INTEGER) AS n_shared,
        count(*) / any_value(n) AS containment
    FROM docs JOIN items USING (shingle) JOIN sizes USING (item_id)
    GROUP BY doc_id, item_id HAVING count(*) * 5 >= any_value(n) * 4
"""

ORACLES["op10_line_dedup"] = r"""
    WITH lines AS (
        SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
    ), hashed AS (
        SELECT *, list_transform(lines, lambda l: CAST('0x' || left(md5(l), 8) AS BIGINT)) AS h FROM lines
    ), ended AS (
        SELECT *, list_filter(range(1, len(h) + 1), lambda i: i = len(h) OR
            ((CASE WHEN i > 1 THEN h[i - 1] ELSE 0 END % 2147483648) * 31 + h[i]) % 2147483648 % 4 = 0) AS ends
        FROM hashed
    ), spans AS (
        SELECT doc_id, lines, ends, unnest(range(1, len(ends) + 1)) AS j FROM ended
    ), chunks AS (
        SELECT doc_id, j, CASE WHEN j > 1 THEN ends[j - 1] + 1 ELSE 1 END AS first, ends[j] AS last,
            lines[(CASE WHEN j > 1 THEN ends[j - 1] + 1 ELSE 1 END):ends[j]] AS part
        FROM spans
    ), judged AS (
        SELECT *, last > first AND regexp_matches(array_to_string(part, chr(10)), '\S')
            AND row_number() OVER (PARTITION BY array_to_string(part, chr(10)), last > first
                ORDER BY doc_id, first) > 1 AS gone
        FROM chunks
    )
    SELECT doc_id, CAST(sum(len(part)) AS INTEGER) AS n_lines,
        CAST(coalesce(sum(len(part)) FILTER (gone), 0) AS INTEGER) AS n_removed,
        sha256(coalesce(string_agg(array_to_string(part, chr(10)), chr(10) ORDER BY j) FILTER (NOT gone), ''))
            AS kept_sha256
    FROM judged GROUP BY doc_id
"""

ORACLES["op2_preference"] = r"""
    WITH turns AS (
        SELECT conv_id, role, text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), middles AS (
        SELECT conv_id, place AS middle FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place) - 1 AS nth,
                count(*) OVER (PARTITION BY conv_id) AS n
            FROM turns WHERE role = 'assistant'
        ) WHERE nth = n // 2
    ), pairs AS (
        SELECT *, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS other FROM middles
    ), chosen AS (
        SELECT p.conv_id AS pair_id, t.place, t.role, t.text FROM pairs p JOIN turns t USING (conv_id)
    ), rejected AS (
        SELECT p.conv_id AS pair_id, t.place, t.role, t.text
        FROM pairs p JOIN turns t USING (conv_id) WHERE t.place < p.middle
        UNION ALL
        SELECT p.conv_id, t.place - m.middle + p.middle, t.role, t.text
        FROM pairs p JOIN middles m ON m.conv_id = p.other JOIN turns t ON t.conv_id = p.other WHERE t.place >= m.middle
    ), sizes AS (
        SELECT pair_id, max(place) FILTER (side = 0) AS n_a, max(place) FILTER (side = 1) AS n_b
        FROM (SELECT 0 AS side, * FROM chosen UNION ALL SELECT 1, * FROM rejected) GROUP BY pair_id
    ), agreeing AS (
        SELECT s.pair_id, coalesce(min(c.place) FILTER (
                c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text) - 1, least(any_value(n_a), any_value(n_b))) AS n
        FROM sizes s JOIN chosen c USING (pair_id) JOIN rejected r USING (pair_id, place) GROUP BY s.pair_id
    ), shown AS (
        SELECT pair_id, side, place, place <= n AS shared, role IS NOT DISTINCT FROM 'assistant' AS answer,
            '<|' || coalesce(role, '') || '|>' || chr(10) AS head,
            coalesce(text, '') || chr(10) || '<|end|>' || chr(10) AS said
        FROM (SELECT 0 AS side, * FROM chosen UNION ALL SELECT 1, * FROM rejected) JOIN agreeing USING (pair_id)
    ), placed AS (
        SELECT *, sum(length(head) + length(said)) OVER (PARTITION BY pair_id, side, shared ORDER BY place) - length(said) AS begun
        FROM shown
    )
    SELECT pair_id, CAST(count(*) FILTER (shared AND side = 0) AS INTEGER) AS prompt_turns,
        coalesce(string_agg(head || said, '' ORDER BY place) FILTER (shared AND side = 0), '') AS prompt,
        coalesce(string_agg(head || said, '' ORDER BY place) FILTER (NOT shared AND side = 0), '') AS chosen,
        coalesce(string_agg(head || said, '' ORDER BY place) FILTER (NOT shared AND side = 1), '') AS rejected,
        coalesce(string_agg(CAST(begun AS VARCHAR) || ':' || CAST(length(said) AS VARCHAR), ' ' ORDER BY place)
            FILTER (NOT shared AND side = 0 AND answer), '') AS chosen_spans,
        coalesce(string_agg(CAST(begun AS VARCHAR) || ':' || CAST(length(said) AS VARCHAR), ' ' ORDER BY place)
            FILTER (NOT shared AND side = 1 AND answer), '') AS rejected_spans
    FROM placed GROUP BY pair_id
"""
