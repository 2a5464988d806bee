"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
    SELECT doc_id, sha256(body) AS text_sha256,
           max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
    WINDOW same AS (PARTITION BY body)
)
"""


NEAR_GROUPS = """
SELECT * FROM (
WITH RECURSIVE
words AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 2], ' ')
                                    FOR i IN range(1, greatest(len(w) - 2, 1) + 1)]) AS s
    FROM words WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
    WHERE 100 * shared >= 85 * (sa.n + sb.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM words
    UNION
    SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, r.component_id, w.doc_id = r.component_id AS kept
FROM words w LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
) found
"""


PHRASES = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM pieces),
grams AS (
    SELECT lang, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
    FROM words, (VALUES (1), (2), (3), (4)) sizes(m) WHERE len(w) >= m
),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang),
candidates AS (
    SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= 30
),
inner_parts AS (
    SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM candidates, (VALUES (2), (3)) sizes(size), (VALUES (1), (2), (3)) starts(i)
    WHERE size < m AND i + size - 1 <= m
),
left_over AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM inner_parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 80 * c.a)
),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, 2000000::HUGEINT * c.a // (l.f + r.f) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM left_over) c
    JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.m], ' ')
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


REPEATS = """
WITH words AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
    FROM documents
),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20),
windows AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS h FROM starts),
copies AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS places
         FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM copies) covered GROUP BY doc_id),
kept AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
           CASE WHEN places IS NULL THEN w
                ELSE list_where(w, [NOT list_contains(places, i) FOR i IN range(1, len(w) + 1)]) END AS k
    FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_hyperminhash": NEAR_GROUPS, "op10_exact_dedup": EXACT_DEDUP,
            "op12_relative_parse": f"SELECT * FROM ({REPEATS})", "op13_phrases": f"SELECT * FROM ({PHRASES})"}
